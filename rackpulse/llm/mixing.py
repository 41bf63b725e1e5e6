"""Mixing sources to target weights by entropy balancing.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and
share 1.5 times the size of the whole; a target stops at twice its source's
size, and what it cannot hold is shared out again by weight until none is
above.

Rates: among all expected numbers of copies r between 0 and ``most`` (2), the
ones nearest to one copy each in (Fermi-Dirac) entropy whose words add up to
each source's target. The convex dual has one multiplier per source, and the
answer is an exponential tilt of the documents' odds by their size,
r / (most - r) = exp(multiplier * size). Newton steps on the dual, kept
inside a shrinking bracket, run as aggregates over the distinct sizes of each
source; all sources step together, and each round's multipliers are written to
the shared folder.

Copies: every document gets floor(r). Further copies go to documents in the
order of u / fraction (u: a hash of the row's values, so reruns agree) as long
as the target holds them: running sums over 1,024 strips of each source find the strip where it
is reached, and only that strip is put in order. What is left of a target then
goes to the largest documents that still fit, ``fill`` times.

Everything is DataFrame operations; per-source tables are joined, never
collected, so the number of sources is not bounded by the driver.

Defined results:

* a null or empty text has size 0, rate 1 and one copy, and takes no words;
* a null source is a source of its own, after all others; sources whose
  documents are all empty have target 0;
* rows are dealt with one by one, so repeated rows may get different copies;
  null doc_ids take part;
* an empty table gives no rows. Extra columns are ignored (``mixed`` passes
  them through).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stage

WORD = r"[^\x20\x09-\x0D]+"
STRIPS = 1024


def sized(docs: DataFrame, doc_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(row, doc, source, size, u) of documents, written down; ``row`` numbers the rows."""
    own = pick(docs, doc=doc_col, source=source_col, text=text_col)
    return stage(own.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc").cast("long").alias("doc"), "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ((F.expr("xxhash64(doc, source, text)").bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)).alias("u")), "mix-sizes")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``number``: 0, 1, ... in code point order, null last.

    The rows are dealt out by ranges and numbered within each; only the ranges'
    counts, as many as partitions, are summed up in one place.
    """
    dealt = stage(sources.withColumn("missing", F.col("source").isNull())
                  .repartitionByRange("missing", "source").withColumn("part", F.spark_partition_id()), "mix-ranges")
    before = dealt.groupBy("part").count().select(
        F.col("part").alias("of"),
        (F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("missing", "source")) - 1
    return (dealt.withColumn("within", within).join(before, F.col("part") == F.col("of"))
            .select("source", "source_size", "docs", (F.col("before") + F.col("within")).alias("number")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """(number, source, source_size, docs, target) of each source, written down."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.expr("int(size > 0)")).cast("long").alias("docs"))
    cycle = ", ".join(map(str, weights))
    own = stage(numbered(sums).withColumn("weight", F.expr(f"element_at(array({cycle}), int(number % {len(weights)}) + 1)")), "mix-sources")
    total = share * (own.agg(F.sum("source_size")).first()[0] or 0)
    level, held = 0.0, None  # a target is level * weight where its source can hold that
    while True:
        above = F.col("source_size") * most < F.lit(level) * F.col("weight")
        row = own.agg(F.sum(F.when(above, F.col("source_size") * most)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("free")).first()
        if (row.full, row.free) == held or not row.free:
            break
        held = (row.full, row.free)
        level = (total - (row.full or 0)) / row.free
    reached = F.col("source_size") * most < F.lit(level) * F.col("weight")
    target = F.when(reached, (F.col("source_size") * most).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return stage(own.select("number", "source", "source_size", "docs", target.alias("target")), "mix-targets")


def multipliers(histogram: DataFrame, sources: DataFrame, most: int = 2, rounds: int = 80) -> DataFrame:
    """(number, target, scale, m) by Newton on the dual: sizes of source ``number`` (a
    histogram number, size, n) times most / (1 + exp(-m * size / scale)) add up to its target.

    A source whose target is all it can hold, ``most`` times its size, has no finite multiplier: null.
    """
    full = F.col("target") >= F.col("source_size") * most - 0.5
    state = sources.where("source_size > 0").select(
        "number", "target", (F.col("source_size") / F.col("docs")).alias("scale"),
        F.when(~full, F.lit(0.0)).alias("m"))
    state = stage(state.withColumns({"lo": -40.0 * F.col("scale"), "hi": 40.0 * F.col("scale"), "open": F.col("m").isNotNull()}), "mix-newton")
    rate = F.lit(float(most)) / (1 + F.exp(-F.col("m") * F.col("size") / F.col("scale")))
    for _ in range(rounds):
        if state.where("open").isEmpty():
            break
        sums = (histogram.select(F.col("number").alias("of"), "size", "n").join(state.where("open"), F.col("of") == F.col("number"))
                .groupBy("of").agg(F.sum(F.col("n") * F.col("size") * rate).alias("words"),
                                   F.sum(F.col("n") * F.col("size") * F.col("size") / F.col("scale") * rate * (1 - rate / most)).alias("slope")))
        gap = F.col("words") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("m")).otherwise(F.col("lo")), F.when(gap > 0, F.col("m")).otherwise(F.col("hi"))
        step = F.col("m") - F.try_divide(gap, F.col("slope"))
        step = F.when((step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
        met = F.abs(gap) <= F.greatest(F.lit(0.5), F.col("target") * 1e-9)
        state = stage(state.join(sums, F.col("of") == F.col("number"), "left").select(
            "number", "target", "scale", F.when(F.col("open") & ~met, step).otherwise(F.col("m")).alias("m"),
            F.when(F.col("open"), lo).otherwise(F.col("lo")).alias("lo"), F.when(F.col("open"), hi).otherwise(F.col("hi")).alias("hi"),
            (F.col("open") & ~met).alias("open")), "mix-newton")
    return state.select("number", "target", "scale", "m")


def copies(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, fill: int = 4) -> DataFrame:
    """(row, doc, source, size, source_size, target, rate, copies) of ``sized`` documents."""
    sources = targets(sizes, weights, share, most)
    named = sizes.join(sources.withColumnRenamed("source", "name"), F.expr("source <=> name")).drop("name", "docs")
    histogram = stage(named.where("size > 0").groupBy("number", "size").agg(F.count("*").alias("n")), "mix-histogram")
    found = multipliers(histogram, sources, most).select(F.col("number").alias("of"), "scale", "m")
    rate = (F.when(F.col("size") == 0, 1.0).when(F.col("m").isNull(), float(most))
            .otherwise(F.lit(float(most)) / (1 + F.exp(-F.col("m") * F.col("size") / F.col("scale")))))
    rated = stage(named.join(found, F.col("of") == F.col("number"), "left").withColumn("rate", rate).drop("of", "scale", "m")
                  .withColumn("whole", F.floor("rate"))
                  .withColumn("turn", F.try_divide(F.col("u"), F.col("rate") - F.col("whole")))  # null: a whole rate
                  .withColumn("strip", F.floor(STRIPS * F.col("turn") / (1 + F.col("turn")))), "mix-rates")

    left = rated.groupBy("number").agg((F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("left"))
    running = F.sum("words").over(Window.partitionBy("number").orderBy("strip").rowsBetween(Window.unboundedPreceding, 0))
    strips = (rated.where("strip is not null").groupBy("number", "strip").agg(F.sum("size").alias("words"))  # up to STRIPS rows a source
              .withColumn("upto", running).join(left, "number"))
    last = stage(strips.where("upto > left").groupBy("number").agg(F.min("strip").alias("last"), F.min(F.struct("strip", F.col("left") - F.col("upto") + F.col("words"))).getField("col2").alias("room")), "mix-strips")
    edge = last.select(F.col("number").alias("of"), "last", "room")
    joined = rated.join(edge, F.col("of") == F.col("number"), "left")
    order = Window.partitionBy("number").orderBy("turn", "doc", "row").rowsBetween(Window.unboundedPreceding, 0)
    inside = (joined.where("strip = last").withColumn("sum", F.sum("size").over(order)).where("sum <= room")
              .select(F.col("row").alias("taken_row")))
    up = F.expr("strip is not null and (last is null or strip < last)") | F.col("taken_row").isNotNull()
    dealt = stage(joined.join(inside, F.col("row") == F.col("taken_row"), "left")
                  .withColumn("copies", F.col("whole") + F.when(up, 1).otherwise(0)).drop("of", "last", "room", "taken_row", "strip", "turn", "whole"), "mix-copies")

    rest = dealt.groupBy("number").agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("rest"))
    rest = stage(rest, "mix-rest")
    extra = None
    for _ in range(fill):
        want = rest if extra is None else rest.join(extra.groupBy(F.col("at").alias("of")).agg(F.sum("given").alias("given")), F.col("of") == F.col("number"), "left").select("number", (F.col("rest") - F.coalesce("given", F.lit(0))).alias("rest"))
        want = want.where("rest >= 1").select(F.col("number").alias("to"), "rest")
        able = dealt.where(f"size > 0 and copies < {most}").select("number", "size", "u", "doc", "row")
        if extra is not None:
            able = able.join(extra.select(F.col("row").alias("gone")), F.col("row") == F.col("gone"), "left_anti")
        best = (able.join(want, (F.col("to") == F.col("number")) & (F.col("size") <= F.col("rest")))
                .groupBy("number").agg(F.max(F.struct("size", "u", "doc", "row")).alias("b"))  # rows that tie in all but the number are alike
                .select(F.col("number").alias("at"), F.col("b.row").alias("row"), F.col("b.size").alias("given")))
        extra = stage(best if extra is None else extra.unionByName(best), "mix-fill")
    if extra is None:
        return dealt.drop("u")
    more = extra.select(F.col("row").alias("more_row"))
    return (dealt.join(more, F.col("row") == F.col("more_row"), "left")
            .withColumn("copies", (F.col("copies") + F.when(F.col("more_row").isNotNull(), 1).otherwise(0)).cast("long")).drop("more_row", "u"))


def mixed(docs: DataFrame, doc_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies."""
    names = docs.columns
    held = stage(docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id()), "mix-docs")
    at = {n: f"c{names.index(c)}" for n, c in (("doc", doc_col), ("source", source_col), ("text", text_col))}
    sizes = stage(held.select("row", F.col(at["doc"]).cast("long").alias("doc"), F.col(at["source"]).alias("source"),
                              F.coalesce(F.regexp_count(at["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.col(at["text"]).alias("text"))
                  .withColumn("u", (F.expr("xxhash64(doc, source, text)").bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)).drop("text"), "mix-sizes")
    taken = copies(sizes, **options).where("copies > 0").select(F.col("row").alias("of"), F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    return held.join(taken, F.col("row") == F.col("of")).drop("row", "of", "copy").toDF(*names)
