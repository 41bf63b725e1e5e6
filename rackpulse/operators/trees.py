"""Trees of any depth as tables of (id, parent) rows.

Ways to the root are walked by pointer doubling: after k rounds every node knows
its ancestor 2^k steps up, the sum over its descendants less than 2^k steps
down and the sum over its own first 2^k steps up. A tree of height h takes
log2(h) + 1 rounds, whatever its shape; each round is a partial aggregate and
an equi-join, written to the shared folder. Nodes that have reached the root
take no part in the next join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

ROUNDS = 30  # heights to 2 ** 30; beyond that lies a cycle


def _doubled(nodes: DataFrame, down: list[str], up: list[str]) -> DataFrame:
    """``nodes`` (id, jump, ...): the columns ``down`` summed over each node and
    its descendants, the columns ``up`` over each node and its ancestors."""
    state = stage(nodes, "tree-jumps")
    for _ in range(ROUNDS):
        moving = state.where("jump IS NOT NULL")
        if moving.isEmpty():
            return state
        lifted = moving.groupBy(F.col("jump").alias("at")).agg(*[F.sum(c).alias("l_" + c) for c in [*down, "_one"]])
        over = state.select(F.col("id").alias("over"), F.col("jump").alias("next"), *[F.col(c).alias("o_" + c) for c in up])
        # a lost parent (not a row) ends the way, as a root does
        state = stage(state.join(lifted, F.col("id") == F.col("at"), "left").join(over, F.col("jump") == F.col("over"), "left").select(
            "id", "parent", F.col("next").alias("jump"), "_one",
            *[(F.col(c) + F.coalesce("l_" + c, F.lit(0))).alias(c) for c in down],
            *[(F.col(c) + F.coalesce("o_" + c, F.lit(0))).alias(c) for c in up]), "tree-jumps")
    raise ValueError("the parents form a cycle")


def tree_rollup(nodes: DataFrame, node: str, parent: str, value: str | Column) -> DataFrame:
    """(id, parent, depth, n_leaves, total) of each node: steps to its root,
    leaves below it (itself, if it is one) and the sum of their values; inner
    nodes' own values do not count. A parent that is not a row counts as none; a
    null value is 0. Raises where the parents form a cycle."""
    rows = nodes.select(F.col(node).alias("id"), F.col(parent).alias("parent"), F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0.0)).cast("double").alias("v"))
    inner = rows.where("parent IS NOT NULL").select(F.col("parent").alias("p")).distinct()
    known = rows.select(F.col("id").alias("k"))
    own = rows.join(inner, F.col("id") == F.col("p"), "left").join(known, F.col("parent") == F.col("k"), "left")
    leaf = F.col("p").isNull()
    own = own.select("id", F.col("k").alias("parent"), F.col("k").alias("jump"), F.lit(1).alias("_one"), leaf.cast("long").alias("n_leaves"),
                     F.when(leaf, F.col("v")).otherwise(0.0).alias("total"), F.col("k").isNotNull().cast("int").alias("depth"))
    return _doubled(own, ["n_leaves", "total"], ["depth"]).select("id", "parent", "depth", "n_leaves", "total")


def tree_partition(rolled: DataFrame) -> DataFrame:
    """(id, parent, depth, x, dx) of ``tree_rollup``'s rows: every node's share of
    its root's unit interval, children side by side from the parent's left edge,
    greatest total first (ties: smaller id). Several roots share the interval in
    the same way; a forest of total 0 has empty intervals."""
    beside = Window.partitionBy("parent").orderBy(F.col("total").desc(), "id").rowsBetween(Window.unboundedPreceding, -1)
    whole = rolled.where("parent IS NULL").agg(F.sum("total").alias("t")).scalar()
    put = rolled.select("id", "parent", F.col("parent").alias("jump"), F.lit(1).alias("_one"), F.coalesce(F.sum("total").over(beside), F.lit(0.0)).alias("left"))
    placed = _doubled(put, [], ["left"]).select("id", "left")
    share = lambda c: F.coalesce(F.try_divide(F.col(c), whole), F.lit(0.0))
    return rolled.join(placed, "id").select("id", "parent", "depth", share("left").alias("x"), share("total").alias("dx"))
