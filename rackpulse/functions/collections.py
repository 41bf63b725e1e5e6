"""Array and map helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_range(start: Column, stop: Column, step: Column) -> Column:
    """F8: start, start+step, ... while < stop (stop excluded; empty when none)."""
    n = F.ceil((stop - start) / step)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")),
                                     lambda i: start + i * step)).otherwise(F.array())


def permute(arr: Column, idx: Column) -> Column:
    """elements of ``arr`` at the 0-based positions in ``idx``."""
    return F.transform(idx, lambda i: F.element_at(arr, (i + 1).cast("int")))


def zip_shortest(a: Column, b: Column) -> Column:
    """Pairs up to the shorter array (``arrays_zip`` alone pads with null)."""
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n).alias("a"), F.slice(b, 1, n).alias("b"))


def merge_arrays(*arrays: Column) -> Column:
    """Concatenate arrays in order."""
    return F.flatten(F.array(*arrays))
