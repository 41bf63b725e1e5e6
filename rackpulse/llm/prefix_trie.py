"""Conversation prefix trie as a z-fast trie, built in batches.

A conversation is a path of turns. The trie of all paths is kept compacted: a
*node* is a depth at which some conversation ends or two part (and the root),
with the edge of single-child prefixes above it: the depths above its parent's
depth ``p``, up to its own ``e``. Prefixes are named by a polynomial hash of their
turns (128 bits) that can be put together from pieces, so a conversation of any
length is hashed in many tasks. Each node is hashed at its *handle*, the prefix
whose depth is the two-fattest number of (p, e]: the one divisible by the
highest power of two.

Insertion goes by batches, a small one first (later ones then walk what many
conversations share by a few look-ups):

* *locate*: fat binary search over the depths (a, b] of each conversation:
  look the prefix of two-fattest depth up among the handles; if it is there go
  on below that node, else above that depth. The number of rounds is the logarithm
  of the greatest length. The exit node is then the one found or its child on the
  next turn, and the depth of exit that to which its edge agrees;
* *insert*: edges are split at the depths of exit; beyond them, prefixes new
  to the trie are counted, and those of one smallest member and one count,
  neighbours on one way down, are compacted to an edge.

At the end each node's members are counted once per explicit node, and
*edges are expanded* to all depths: along an edge members, leaves and ends are
those of its node, and the saved tokens differ by running sums of words.

With c's own part being the edges where it is the smallest member (all below
some depth), the sum over a subtree of (members - 1) * words is the sum, over its
members, of the words that are not their own part: no sum walks the tree.

Hot prefixes (shared by over a thousandth of all rows, so a thousand at most)
are joined by broadcast, the others by shuffles; ids ending at one node are
joined to pieces of 256 before they meet, and hashed as a stream.

Defined results (``rebuilt`` and ``prefix_trie``):

* rows with a null conversation id belong to no conversation; null roles and
  texts are empty; null turns come first; rows of one turn number are ordered by
  a digest of role and text, and repeated rows count as turns of their own;
* a conversation without turns ends at the root; an empty table has no nodes;
* extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rackpulse.operators.series import previous_row

from .common import pick, stage
from .ordering import HOT, in_order, join_hot, placed

WORD = r"[^\x20\x09-\x0D]+"
PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D1F3C9A7B46E8D2F19C3A571
ROOT = "X'" + "00" * 16 + "'"
SEG = 256
IDS = 256
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, n, sym, words): the turns of each conversation in order from 0, written."""
    own = pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = stage(own.where("conv IS NOT NULL").select(
        F.col("conv").cast("long").alias("conv"), "turn", F.unhex(F.substring(said, 1, 30)).alias("sym"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")), "trie-turns")
    return stage(placed(stage(in_order(rows, "conv", ["turn", "sym"]), "trie-order"), "conv").drop("turn"), "trie-placed")


def rebuilt(own: DataFrame, borrow: Column, lender: Column) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows): each conversation's first ``borrow`` turns (an
    expression over ``conv``) are those of the conversation ``lender``, its own
    following turns stay. Rows: (conv, late, pos, sym, words), ordered by late, pos."""
    convs = own.where("pos = 0").select("conv")
    own = own.withColumn("borrow", borrow).withColumn("lender", lender)
    kept = own.where("conv = lender OR pos >= borrow").select("conv", F.lit(1).alias("late"), "pos", "sym", "words")
    asked = own.where("pos = 0 AND conv <> lender AND borrow > 0").select(F.col("conv").alias("to"), "borrow", F.col("lender").alias("conv"))
    most = asked.agg(F.max("borrow")).first()[0] or 0
    heads = own.where(F.col("pos") < most).select("conv", "pos", "sym", "words")
    lent = asked.join(heads, "conv").where("pos < borrow").select(F.col("to").alias("conv"), F.lit(0).alias("late"), "pos", "sym", "words")
    return convs, kept.unionByName(lent)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running hash, depth and words of each conversation within the partition."""
    conv, value, depth, words = None, 0, 0, 0
    for batch in batches:
        hashes, depths, sums = [], [], []
        for c, sym, w in zip(*(batch.column(x).to_pylist() for x in ("conv", "sym", "words")), strict=True):
            if c != conv:
                conv, value, depth, words = c, 0, 0, 0
            value = (value * BASE + int.from_bytes(sym, "big") + 1) % PRIME
            depth, words = depth + 1, words + w
            hashes.append(value.to_bytes(16, "big"))
            depths.append(depth)
            sums.append(words)
        yield pa.RecordBatch.from_pydict({"conv": batch.column("conv"), "part": batch.column("part"), "at": batch.column("at"),
                                          "hash": pa.array(hashes, pa.binary()), "depth": pa.array(depths, pa.int64()), "sum": pa.array(sums, pa.int64())})


def _carried(rows: pd.DataFrame) -> pd.DataFrame:
    """What lies before each partition's part of one conversation."""
    rows = rows.sort_values("part")
    out, value, depth, words = [], 0, 0, 0
    for r in rows.itertuples():
        out.append((r.conv, r.part, value.to_bytes(16, "big"), depth, words))
        value = (value * pow(BASE, r.depth, PRIME) + int.from_bytes(r.hash, "big")) % PRIME
        depth, words = depth + r.depth, words + r.sum
    return pd.DataFrame(out, columns=["of", "in", "head", "above", "before"])


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = {x: batch.column(x).to_pylist() for x in ("hash", "depth", "sum", "head", "above", "before")}
        for i, head in enumerate(got["head"]):
            if head is not None:
                value = int.from_bytes(head, "big") * pow(BASE, got["depth"][i], PRIME) + int.from_bytes(got["hash"][i], "big")
                got["hash"][i] = (value % PRIME).to_bytes(16, "big")
                got["depth"][i] += got["above"][i]
                got["sum"][i] += got["before"][i]
        yield pa.RecordBatch.from_pydict({"conv": batch.column("conv"), "hash": pa.array(got["hash"], pa.binary()),
                                          "depth": pa.array(got["depth"], pa.int64()), "sum": pa.array(got["sum"], pa.int64())})


def paths(rows: DataFrame, order: list[str]) -> DataFrame:
    """(conv, seg, way): the prefixes of each conversation, 256 depths a row
    and the one before them: way[i] = (hash, sum) at depth 256 * seg + i. Written."""
    local = "conv long, part int, at long, hash binary, depth long, sum long"
    written = stage(in_order(rows, "conv", order).select("conv", "part", "at", "sym", "words").mapInArrow(_chained, local), "trie-chain")
    pieces = written.groupBy("conv", "part").agg(F.max("depth").alias("depth"), F.max_by("hash", "depth").alias("hash"), F.max("sum").alias("sum"))
    cut = pieces.groupBy("conv").agg(F.count("*").alias("pieces")).where("pieces > 1").select("conv")
    carried = (pieces.join(cut, "conv").groupBy("conv")
               .applyInPandas(_carried, "of long, in int, head binary, above long, before long"))
    full = (written.join(carried, (F.col("conv") == F.col("of")) & (F.col("part") == F.col("in")), "left")
            .select("conv", "hash", "depth", "sum", "head", "above", "before")
            .mapInArrow(_put_together, "conv long, hash binary, depth long, sum long"))
    # a depth divisible by 256 ends one segment and stands before the next
    segs = F.when(F.col("depth") % SEG == 0, F.array(F.expr(f"depth div {SEG} - 1"), F.expr(f"depth div {SEG}"))).otherwise(F.array(F.expr(f"depth div {SEG}")))
    entry = F.struct("depth", "hash", "sum")
    grouped = full.withColumn("seg", F.explode(segs)).groupBy("conv", "seg").agg(F.sort_array(F.collect_list(entry)).alias("way"))
    head = F.expr(f"array(named_struct('depth', 0L, 'hash', {ROOT}, 'sum', 0L))")
    whole = F.when(F.col("seg") == 0, F.concat(head, "way")).otherwise(F.col("way"))
    return stage(grouped.withColumn("way", F.transform(whole, lambda x: F.struct(x.hash.alias("hash"), x["sum"].alias("sum"))))
                 .where("size(way) > 1"), "trie-paths")


def seg_of(depth: str) -> Column:
    """The segment that has ``depth`` among its 256 (0 for depth 0)."""
    return F.expr(f"greatest({depth} - 1, 0) div {SEG}")


def at_depth(depth: str, field: str = "hash") -> Column:
    """The entry of ``way`` in segment ``seg`` at ``depth``; null where there is none."""
    return F.expr(f"get(way, cast({depth} - seg * {SEG} as int)).{field}")


def two_fattest(a: Column, b: Column) -> Column:
    """The number of (a, b] divisible by the highest power of two (a < b)."""
    low = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return b.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), low))


def indexed(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """The trie's nodes (node, e, p, parent, rep, seen) with the hashes of
    their handles and of their names (the first prefix of the edge); written."""
    own = nodes.where("e > 0").withColumn("f", two_fattest(F.col("p"), F.col("e"))).withColumn("top", F.col("p") + 1)
    for depth, out in (("f", "handle"), ("top", "name")):
        own = (own.withColumn("seg", seg_of(depth)).join(ways.withColumnRenamed("conv", "rep"), ["rep", "seg"])
               .withColumn(out, at_depth(depth)).drop("seg", "way"))
    return stage(own.drop("f", "top"), "trie-nodes")


def _looked_up(state: DataFrame, index: DataFrame, hot: DataFrame, by: str) -> DataFrame:
    """``state`` with the node (found: struct) whose ``by`` is its ``hash``."""
    found = F.struct("node", "e", "p", "rep").alias("found")
    often = state.join(F.broadcast(hot.select(F.col(by).alias("hash"), found)), "hash", "left")
    seen = often.where("found IS NOT NULL")
    rest = often.where("found IS NULL").drop("found").join(index.select(F.col(by).alias("hash"), found), "hash", "left")
    return seen.unionByName(rest).drop("hash")


def locate(convs: DataFrame, ways: DataFrame, index: DataFrame, longest: int) -> DataFrame:
    """(conv, len, x, node, e): the exit node of each conversation and the depth
    to which its path lies in the trie; written."""
    total = index.agg(F.sum("seen")).first()[0] or 0
    hot = stage(index.where(F.col("seen") > max(1, total * HOT)), "trie-hot")
    state = convs.select("conv", "len", F.lit(0).cast("long").alias("a"), F.col("len").alias("b"),
                         F.expr(f"named_struct('node', {ROOT}, 'e', 0L, 'p', -1L, 'rep', cast(null as long))").alias("last"))
    for _ in range(longest.bit_length()):
        done = state.where("a >= b")
        probe = state.where("a < b").withColumn("f", two_fattest(F.col("a"), F.col("b"))).withColumn("seg", seg_of("f"))
        probe = probe.join(ways, ["conv", "seg"]).withColumn("hash", at_depth("f")).drop("seg", "way")
        found = _looked_up(probe, index, hot, "handle")
        there = F.col("found").isNotNull()
        state = stage(done.unionByName(found.select(
            "conv", "len", F.when(there, F.col("found.e")).otherwise(F.col("a")).alias("a"),
            F.when(there, F.col("b")).otherwise(F.col("f") - 1).alias("b"), F.coalesce("found", "last").alias("last"))), "trie-search")
    # the child on the next turn, if the whole edge of the last node agrees
    reach = state.withColumn("d", F.least("len", F.col("last.e") + 1)).withColumn("seg", seg_of("d"))
    reach = reach.join(ways, ["conv", "seg"], "left").withColumn("seg", seg_of("d"))
    agrees = (F.col("last.e") == 0) | (F.col("last.e") <= F.col("len")) & F.coalesce(at_depth("last.e") == F.col("last.node"), F.lit(False))
    reach = reach.withColumn("agrees", agrees).withColumn("hash", F.when(F.col("agrees") & (F.col("last.e") < F.col("len")), at_depth("last.e + 1"))).drop("seg", "way")
    met = _looked_up(reach, index, hot, "name")
    into = F.col("found").isNotNull()
    exits = stage(met.select(
        "conv", "len", F.coalesce("found", "last").alias("exit"),
        F.when(into, F.col("found.p") + 1).when(F.col("agrees"), F.col("last.e")).otherwise(F.col("last.p") + 1).alias("lo"),
        F.when(into, F.least("len", "found.e")).when(F.col("agrees"), F.col("last.e")).otherwise(F.least("len", "last.e")).alias("hi")), "trie-exits")
    # how far the edge agrees: compared segment by segment with a conversation on it
    open_ = exits.where("lo < hi").withColumn("seg", F.explode(F.expr(f"sequence(lo div {SEG}, (hi - 1) div {SEG})")))
    open_ = open_.withColumn("edge", F.struct(F.col("exit.rep").alias("rep"), F.col("seg")))
    mine = stage(open_.select("conv", "seg", "lo", "hi", "edge").join(ways, ["conv", "seg"]).withColumnRenamed("way", "own"), "trie-edges")
    theirs = mine.select("edge").distinct().join(ways.select(F.struct(F.col("conv").alias("rep"), "seg").alias("edge"), "way"), "edge")
    both = join_hot(mine, theirs, "edge", F.xxhash64("conv"))
    same = F.size(F.filter(F.zip_with(F.col("own.hash"), F.col("way.hash"), lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    deep = both.withColumn("same", same).where("same > 0").groupBy("conv").agg(F.max(F.col("seg") * SEG + F.col("same") - 1).alias("depth"))
    return stage(exits.join(deep, "conv", "left").select(
        "conv", "len", F.least("hi", F.greatest("lo", F.coalesce("depth", "lo"))).alias("x"), F.col("exit.node").alias("node"), F.col("exit.e").alias("e")), "trie-located")


def exploded(ways: DataFrame, above: Column) -> DataFrame:
    """(conv, depth, hash, sum, prev): the prefixes deeper than ``above``; prev: the hash of the one before."""
    entries = F.transform("way", lambda x, i: F.struct((F.col("seg") * SEG + i).alias("depth"), x.hash.alias("hash"), x["sum"].alias("sum"),
                                                       F.get(F.col("way"), F.greatest(i - 1, F.lit(0))).hash.alias("prev")))
    return ways.select("conv", above.alias("above"), F.inline(F.slice(entries, 2, SEG))).where("depth > above").drop("above")


def insert(nodes: DataFrame, located: DataFrame, ways: DataFrame) -> DataFrame:
    """The nodes with those of the located conversations; written."""
    cuts = located.where("x < e").withColumn("seg", seg_of("x")).join(ways, ["conv", "seg"], "left")
    cuts = stage(cuts.withColumn("hash", F.when(F.col("x") > 0, at_depth("x")).otherwise(F.expr(ROOT)))
                 .groupBy("node", "x").agg(F.first("hash").alias("hash"), F.count("*").alias("seen")), "trie-cuts")
    last = cuts.groupBy("node").agg(F.max(F.struct("x", "hash")).alias("cut"))
    old = stage(nodes.join(last, "node", "left"), "trie-old")
    stay = old.select("node", "e", F.coalesce("cut.x", "p").alias("p"), F.coalesce("cut.hash", "parent").alias("parent"), "rep", "seen")
    split = previous_row(cuts, ["node"], "x", [], ["x", "hash"], prefix="prev_", chunk_seconds=SEG)
    split = split.join(old.where("cut IS NOT NULL").select("node", "p", "parent", "rep", F.col("seen").alias("all")), "node").select(
        F.col("hash").alias("node"), F.col("x").alias("e"), F.coalesce("prev_x", "p").alias("p"),
        F.coalesce("prev_hash", "parent").alias("parent"), "rep", F.greatest("all", "seen").alias("seen"))
    beyond = located.where("len > x").select("conv", "x")
    new = exploded(ways.join(beyond, "conv"), F.col("x"))
    counted = new.groupBy("hash").agg(F.count("*").alias("seen"), F.min("conv").alias("rep"), F.min("depth").alias("depth"), F.first("prev").alias("prev"))
    edges = counted.groupBy("rep", "seen").agg(F.max("depth").alias("e"), F.max_by("hash", "depth").alias("node"),
                                               (F.min("depth") - 1).alias("p"), F.min_by("prev", "depth").alias("parent"))
    return stage(reduce(DataFrame.unionByName, [stay, split, edges.select("node", "e", "p", "parent", "rep", "seen")]), "trie-compact")


def compact_trie(convs: DataFrame, ways: DataFrame, first: int = 16) -> DataFrame:
    """The compacted trie's nodes (node, e, p, parent, rep, seen) of the
    conversations (conv, len), inserted in two batches: one in ``first``, then
    the others."""
    spark = convs.sparkSession
    longest = convs.agg(F.max("len")).first()[0] or 0
    nodes = stage(spark.range(1).select(F.expr(ROOT).alias("node"), F.lit(0).cast("long").alias("e"), F.lit(-1).cast("long").alias("p"),
                                        F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("rep"), F.lit(0).cast("long").alias("seen")), "trie-root")
    early = F.pmod(F.xxhash64("conv"), F.lit(first)) == 0
    start = convs.where(early).select("conv", "len", F.lit(0).cast("long").alias("x"), F.expr(ROOT).alias("node"), F.lit(0).cast("long").alias("e"))
    nodes = insert(nodes, start, ways)
    located = locate(convs.where(~early), ways, indexed(nodes, ways), longest)
    return insert(nodes, located, ways)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node in order, joined by up to 256."""
    node, ids = None, []
    for batch in batches:
        out = []
        for n, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (n != node or len(ids) == IDS):
                out.append((node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = n
            ids.append(conv)
        yield _piece_batch(out)
    yield _piece_batch([(node, ids[0], ",".join(map(str, ids)))] if ids else [])


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"node": pa.array([r[0] for r in rows], pa.binary()), "least": pa.array([r[1] for r in rows], pa.int64()),
                                       "ids": pa.array([r[2] for r in rows], pa.string())})


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces in order."""
    node, state = None, None
    made = lambda rows: pa.RecordBatch.from_pydict({"node": pa.array([r[0] for r in rows], pa.binary()), "ends": pa.array([r[1] for r in rows], pa.string())})
    for batch in batches:
        out = []
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if state is not None and n == node:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((node, state.hexdigest()))
            node, state = n, hashlib.sha256(ids.encode())
        yield made(out)
    yield made([(node, state.hexdigest())] if state is not None else [])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 of the ids (conv) of each node, ascending, comma-joined."""
    pieces = (ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
              .mapInArrow(_pieces, "node binary, least long, ids string"))
    return pieces.repartition("node").sortWithinPartitions("node", "least").select("node", "ids").mapInArrow(_streamed, "node binary, ends string")


def prefix_trie(convs: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256) for every prefix of the conversations ``convs`` (conv), whose turns
    are ``rows`` (conv, *order, sym, words)."""
    ways = paths(rows, order)
    lens = ways.groupBy("conv").agg(F.max(F.col("seg") * SEG + F.size("way") - 1).alias("len"))
    convs = stage(convs.join(lens, "conv", "left").select("conv", F.coalesce("len", F.lit(0)).cast("long").alias("len")), "trie-convs")
    nodes = compact_trie(convs, ways)

    # members at the nodes
    every = exploded(ways, F.lit(0)).select("conv", "depth", "hash", "sum").unionByName(
        convs.select("conv", F.lit(0).cast("long").alias("depth"), F.expr(ROOT).alias("hash"), F.lit(0).cast("long").alias("sum")))
    members = every.groupBy("hash").agg(F.count("*").alias("n"), F.min("conv").alias("first"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = stage(nodes.select("node", "e", "p").join(members.withColumnRenamed("hash", "node"), "node").join(children, "node", "left")
                    .select("node", "e", "p", "n", "first", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")), "trie-counted")
    total = convs.agg(F.sum(F.col("len") + 1)).first()[0] or 0
    given = counted.select(F.col("node").alias("hash"), "n", "first", "n_children")
    hot = F.broadcast(given.where(F.col("n") > max(1, total * HOT)))
    cold = given.where(F.col("n") <= max(1, total * HOT))
    mine = stage(every.join(hot, "hash").unionByName(every.join(cold, "hash")), "trie-members")

    # each conversation: its end, and the deepest node where it is not the smallest member
    each = stage(mine.groupBy("conv").agg(
        F.max_by(F.struct("hash", "first", "n_children"), "depth").alias("end"),
        F.max(F.when(F.col("first") < F.col("conv"), F.struct("depth", "sum", "first"))).alias("low")), "trie-each")
    leaf = ((F.col("end.n_children") == 0) & (F.col("end.first") == F.col("conv"))).cast("long")
    sums = (mine.select("conv", "hash", "first").join(each, "conv").groupBy(F.col("hash").alias("node"))
            .agg(F.sum(leaf).alias("n_leaves"), F.sum(F.when(F.col("first") < F.col("conv"), F.col("low.sum")).otherwise(0)).alias("shared")))
    ends = ends_digest(each.select(F.col("end.hash").alias("node"), "conv"))
    known = stage(counted.join(sums, "node").join(ends, "node", "left")
                  .join(each.select(F.col("conv").alias("first"), "low"), "first"), "trie-known")

    # expand the edges
    cut = known.where("e > 0").withColumn("seg", F.explode(F.expr(f"sequence(p div {SEG}, (e - 1) div {SEG})")))
    on = cut.join(ways.withColumnRenamed("conv", "first"), ["first", "seg"])
    from_, to = F.greatest(F.col("p") - F.col("seg") * SEG, F.lit(0)), F.least(F.col("e") - F.col("seg") * SEG, F.lit(SEG))
    steps = F.transform(F.sequence(from_ + 1, to), lambda i: F.struct((F.col("seg") * SEG + i).alias("depth"), F.get("way", (i - 1).cast("int"))["sum"].alias("before")))
    deep = on.select("first", "node", "e", "p", "n", "n_children", "n_leaves", "shared", "ends", "low", F.inline(steps))
    at_end, at_top = F.col("depth") == F.col("e"), F.col("depth") == F.col("p") + 1
    lent = at_top & F.coalesce(F.col("low.depth") >= F.col("p"), F.lit(False))
    below = deep.select(
        F.col("first").alias("conv_id"), "depth", F.when(lent, F.col("low.first")).otherwise(F.col("first")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(at_end, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("shared") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"))
    root = known.where("e = 0").select(
        F.col("first").alias("conv_id"), F.col("e").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", F.col("shared").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
    return below.unionByName(root)
