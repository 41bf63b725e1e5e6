"""Places of rows in order, and joins on hot keys, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: A key of more than this share of all rows is split; so at most 1 / HOT keys are.
HOT = 0.001


def in_order(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """``df`` dealt out by ranges of (key, order) and sorted, with ``part`` and
    ``at``: the partition and the row's place in it. The ranges cut through
    keys, so a key of any size is spread over many tasks. The result must be
    written before anything else is done with it (see ``placed``)."""
    dealt = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    return dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))


def spans(written: DataFrame, key: str, *more: Column) -> DataFrame:
    """(key, part, first, count, ...): one row for each key in each partition of
    rows in order."""
    return written.groupBy(key, "part").agg(F.min("at").alias("first"), F.count("*").alias("count"), *more)


def placed(written: DataFrame, key: str) -> DataFrame:
    """Rows in order (written) with ``pos``, their place from 0 among the rows
    of their key, and ``n``, how many these are. Only one row per key and
    partition is summed up."""
    same = Window.partitionBy(key).orderBy("part")
    before = spans(written, key).select(
        F.col(key).alias("of"), F.col("part").alias("in"),
        (F.sum("count").over(same.rowsBetween(Window.unboundedPreceding, 0)) - F.col("count") - F.col("first")).alias("shift"),
        F.sum("count").over(Window.partitionBy(key)).alias("n"))
    joined = written.join(before, (F.col(key) == F.col("of")) & (F.col("part") == F.col("in")))
    return joined.withColumn("pos", F.col("at") + F.col("shift")).drop("of", "in", "shift", "part", "at")


def join_hot(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key`` (in both; one row a key in
    ``right``), also where one key holds most rows of ``left``.

    Keys of over a thousandth of the rows of ``left`` (a thousand at most, so
    these are broadcast) are cut into pieces of that size by ``spread``, a hash
    of the row, and their row of ``right`` goes to each piece. ``left`` is read
    twice: give a written table. ``how``: inner or left."""
    counts = left.groupBy(key).count()
    total = left.count()
    most = max(1, int(total * HOT))
    hot = counts.where(F.col("count") > most).select(F.col(key).alias("_hot"), F.ceil(F.col("count") / most).alias("_pieces"))
    hot = F.broadcast(stage(hot, "hot-keys"))
    piece = F.pmod(spread, F.coalesce("_pieces", F.lit(1)))
    dealt = left.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_piece", piece).drop("_hot", "_pieces")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1))
    given = right.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_piece", copies).drop("_hot", "_pieces")
    return dealt.join(given, [key, "_piece"], how).drop("_piece")
