"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Fingerprints that differ in ``max_bits`` bits
share ``8 - max_bits`` positional bytes at least (bits can spoil no more bytes
than there are bits): the guaranteed minimum of matches. The inverted index
posts each distinct fingerprint under its positional bytes, *that many at a
time*: one posting for every choice of ``8 - max_bits`` positions (28 for two
bits). Two fingerprints then meet in a posting list exactly when their tally
of shared positional bytes reaches the minimum, so the count filter is settled
where they meet, and no list holds pairs that merely share a byte or two.
A list is bounded: only ``max_bits`` bytes are left open, so it holds 65,536
distinct fingerprints at most. Within a list the bit distance is verified:
small lists compare all their members, large ones look up, for every member,
the few values that lie within ``max_bits`` bits of it.

Only distinct fingerprints are indexed, so copies never form pairs; links are
emitted as a forest per list (no link is lost, a linked pair is connected in
it); components are found by star contraction, in rounds written to the shared
folder, and fingerprints are tied back to documents at the end.

Defined results:

* a null or empty text, or one of white space only, has fingerprint zero and
  is linked like any other;
* rows sharing a doc_id stay separate rows, each with its own fingerprint;
* rows with a null doc_id get their fingerprint and component; the component's
  id is the smallest doc_id that is not null (null if it has none);
* an empty table gives no rows. Extra columns are ignored or passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, slices, stage, text_bytes

SEED = 42
BYTES = 8


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of the text's word shingles, repeats included."""
    own = text.lower().split()
    if not own:
        return np.empty(0, np.uint64)
    if len(own) < words:
        own, words = [b" ".join(own)], 1
    digest = xxhash.xxh64_intdigest
    if words == 1:
        made = (digest(w, SEED) for w in own)
    else:
        made = (digest(b" ".join(w), SEED) for w in zip(*(own[i:] for i in range(words)), strict=False))
    return np.fromiter(made, np.uint64)


def fingerprint(hashes: np.ndarray, at_once: int = 1 << 16) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), at_once):
        part = hashes[i: i + at_once].astype("<u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc long, print long) of documents (doc, text); the fingerprint's 64 bits as a long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                made = [fingerprint(shingle_hashes(t, words)) for t in text_bytes(part.column(1))]
                yield pa.RecordBatch.from_pydict({"doc": part.column(0), "print": pa.array(np.array(made, np.uint64).view(np.int64))})

    return docs.mapInArrow(scan, "doc long, print long")


def _near(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (positions) of distinct sorted values within ``max_bits`` bits: all
    of a short list; of a long one the pairs found by looking up each value with
    up to ``max_bits`` of the differing bits flipped."""
    n = len(values)
    if n <= 512:
        a, b = np.triu_indices(n, 1)
        near = np.bitwise_count(values[a] ^ values[b]) <= max_bits
        return a[near], b[near]
    spread = np.bitwise_or.reduce(values ^ values[0])
    bits = [np.uint64(1 << i) for i in range(64) if int(spread) >> i & 1]
    left, right = [], []
    for count in range(1, max_bits + 1):
        for flips in combinations(bits, count):
            other = values ^ np.bitwise_xor.reduce(np.array(flips, np.uint64))
            at = np.minimum(np.searchsorted(values, other), n - 1)
            hit = np.nonzero((values[at] == other) & (other > values))[0]
            left.append(hit)
            right.append(at[hit])
    return np.concatenate(left), np.concatenate(right)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member each of ``n`` members is connected with."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b), a > b, between distinct fingerprints (column ``print``)
    within ``max_bits`` bits: a forest for each posting list, together
    connecting exactly what the distance connects."""
    open_bytes = [sum(0xFF << 8 * i for i in gone) for gone in combinations(range(BYTES), max_bits)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = ", ".join(f"{signed(~m & (1 << 64) - 1)}L".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)") for m in open_bytes)
    posted = prints.select("print", F.posexplode(F.expr(f"array({masks})")).alias("choice", "mask"))
    lists = (posted.groupBy("choice", F.expr("print & mask").alias("bytes"))
             .agg(F.collect_list("print").alias("prints")).where("size(prints) > 1").select("prints"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values, ends = np.asarray(column.flatten()).view(np.uint64), np.cumsum(np.asarray(pc.list_value_length(column)))
            out = []
            for start, end in zip(np.r_[0, ends[:-1]], ends, strict=True):
                own = np.sort(values[start:end])
                root = _forest(len(own), *_near(own, max_bits))
                moved = np.nonzero(root != np.arange(len(own)))[0]
                out.append(np.stack([own[moved], own[root[moved]]]))
            found = np.concatenate(out, axis=1).view(np.int64) if out else np.empty((2, 0), np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(found[0]), "b": pa.array(found[1])})

    return lists.mapInArrow(verify, "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node each linked node is connected with.

    Star contraction: every node passes its smallest neighbour on to its larger
    neighbours, then to its smaller ones, until only stars are left. Edges
    never grow in number; minima are summed up before shuffles, and a hub's
    edges are split by the skew join.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star-edges")
    was = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = stage(small, "star-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == was:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        was = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    own = pick(docs, doc=doc_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    marked = stage(fingerprints(own, words), "simhash")
    prints = marked.groupBy("print").agg(F.min("doc").alias("first"))
    linked = stage(components(links(prints.select("print"), max_bits)), "simhash-components")
    each = prints.join(linked, F.col("print") == F.col("node"), "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    each = stage(each, "simhash-classes")
    ids = each.groupBy("root").agg(F.min("first").alias("component_id"))
    named = each.join(ids, "root").select(F.col("print").alias("of"), "component_id")
    return (marked.join(named, F.col("print") == F.col("of"), "left")
            .select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one of smallest doc_id (null
    last), then of least hash of its values. Rows are told apart by number, so of
    repeated rows one stays, and rows sharing a doc_id are dealt with one by one."""
    names = docs.columns
    columns = [f"c{i}" for i in range(len(names))]
    held = stage(docs.toDF(*columns).withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    groups = near_duplicates(held.select("row", F.col(f"c{names.index(text_col)}").alias("text")), words, max_bits, "row", "text")
    doc = F.col(f"c{names.index(doc_col)}").cast("long")
    order = F.struct(doc.isNull().alias("missing"), doc.alias("doc"), F.xxhash64(*columns).alias("hash"), F.col("row").alias("row"))
    ranked = held.select(F.col("row").alias("of"), order.alias("order")).join(groups.select(F.col("doc_id").alias("named"), "component_id"), F.col("of") == F.col("named"))
    first = ranked.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.row").alias("kept"))
    return held.join(first, F.col("row") == F.col("kept"), "left_semi").select(*columns).toDF(*names)
