"""Keyed snapshot difference (J11): enter, update and exit rows.

Rows are matched by key as a keyed data join does: the first old row of a key
is updated by the first new row of that key; later old rows of a repeated key
exit; later new rows of a repeated key are dropped. The first row per key is a
``min`` aggregate (partial, skew-safe), not a window over the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Returns (key, status, old_id, new_id); ``order`` identifies and orders rows."""
    of = old.groupBy(key).agg(F.min(order).alias("_first"))
    nf = new.groupBy(key).agg(F.min(order).alias("new_id"))
    nf = nf.withColumnRenamed(key, "_key")
    matched = of.join(nf, of[key].eqNullSafe(nf["_key"]), "full_outer")  # a null key is a key like any other
    firsts = matched.select(
        F.coalesce(key, "_key").alias(key),
        F.when(F.col("_first").isNull(), "enter").when(F.col("new_id").isNull(), "exit")
        .otherwise("update").alias("status"),
        F.col("_first").alias("old_id"), "new_id")
    of = of.withColumnRenamed(key, "_key")
    repeats = (old.select(key, order).join(of, F.col(key).eqNullSafe(F.col("_key")))
               .where(F.col(order) != F.col("_first"))
               .select(key, F.lit("exit").alias("status"), F.col(order).alias("old_id"),
                       F.lit(None).cast(new.schema[order].dataType).alias("new_id")))
    return firsts.unionByName(repeats)
