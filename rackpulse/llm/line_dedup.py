"""Line dedup on an index that can be undone: cuckoo filters over exact counts.

The index holds, all hashed into shards by line key,

* ``postings``: one row per (key, document), the exact table everything else
  is derived from;
* ``counts``: per key the number of documents holding it and the largest
  doc_id among them (the document that keeps the line);
* ``filters``: per shard one cuckoo filter of the *frequent* keys (held by at
  least ``min_docs`` documents). A lookup first asks the small filter; only
  hits go on to the exact table, which clears false positives.

``insert`` and ``delete`` take whole documents. They change the postings,
recount only the keys touched, and move keys that cross ``min_docs`` into or
out of the filters, so deleting a batch gives back the index from before it. A
filter whose keys would fill over ``FULL`` of its places is built anew from the counts.

A line's key is the line without white space (space, tab, LF, VT, FF, CR) at
either end, A-Z lower-cased, if it has ``min_chars`` code points at least;
shorter lines are never dropped.

Defined results:

* a null or empty text is one empty line and stays empty;
* rows sharing a doc_id are one document: they count once and keep or lose the
  same keys; a line repeated within a document counts once, and each of its
  copies goes or stays alike;
* rows with a null doc_id have no place in the index: nothing of theirs is
  counted or dropped;
* all other columns pass through unchanged, whatever their names; columns
  named ``n_lines`` or ``n_dropped`` are replaced by the operator's;
* an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from .common import pick, stage, text_bytes

SPACE = b" \t\n\x0b\x0c\r"
SLOTS = 4  # places in a bucket
FULL = 0.9  # share of its places beyond which a filter is built anew, larger
SHARD_BYTES, MOST_SHARDS = 1 << 27, 1 << 20  # text a shard is meant for; 2 ** 20 rows tell all shards' pieces
KICKS = 200  # moves before a key goes to the stash


class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit fingerprints, two buckets of four.

    Keys that find no place after ``KICKS`` moves lie in an exact stash, so an
    insertion never fails and a lookup never misses a member.
    """

    def __init__(self, buckets: int) -> None:
        self.slots = np.zeros((1 << max(1, int(buckets - 1).bit_length()), SLOTS), np.uint16)
        self.stash: list[int] = []

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(max(2, keys // 2))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        n, = np.frombuffer(data[:8], np.int64)
        made = cls(2)
        made.slots = np.frombuffer(data[8: 8 + n * SLOTS * 2], np.uint16).reshape(n, SLOTS).copy()
        made.stash = np.frombuffer(data[8 + n * SLOTS * 2:], np.uint64).tolist()
        return made

    def dump(self) -> bytes:
        return (np.int64(len(self.slots)).tobytes() + self.slots.tobytes()
                + np.array(self.stash, np.uint64).tobytes())

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        print_ = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (keys & np.uint64(len(self.slots) - 1)).astype(np.int64)
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_: np.ndarray) -> np.ndarray:
        mixed = (print_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return (mixed & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, a, b = self._places(keys)
        found = (self.slots[a] == print_[:, None]).any(1) | (self.slots[b] == print_[:, None]).any(1)
        return found | np.isin(keys, np.array(self.stash, np.uint64)) if self.stash else found

    def insert(self, keys: np.ndarray) -> None:
        for key, print_, a, b in zip(keys.tolist(), *(x.tolist() for x in self._places(keys)), strict=True):
            at = next((x for x in (a, b) if not self.slots[x].all()), None)
            if at is None:
                self._push(key, print_, a)
            else:
                self.slots[at, int(np.argmin(self.slots[at]))] = print_

    def _push(self, key: int, print_: int, at: int) -> None:
        moves = []
        for kick in range(KICKS):
            slot = kick % SLOTS
            moves.append((at, slot, int(self.slots[at, slot])))
            self.slots[at, slot], print_ = print_, moves[-1][2]
            at ^= int(self._jump(np.array([print_], np.uint16))[0])
            if not self.slots[at].all():
                self.slots[at, int(np.argmin(self.slots[at]))] = print_
                return
        for place, slot, before in reversed(moves):  # no room: undo
            self.slots[place, slot] = before
        self.stash.append(key)

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted before."""
        for key, print_, a, b in zip(keys.tolist(), *(x.tolist() for x in self._places(keys)), strict=True):
            if key in self.stash:
                self.stash.remove(key)
                continue
            for at in (a, b):
                hit = np.nonzero(self.slots[at] == print_)[0]
                if len(hit):
                    self.slots[at, hit[0]] = 0
                    break


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """16-byte hash of the key of a line, None if the key is too short."""
    key = line.strip(SPACE)
    if len(key) < min_chars:  # bytes are no fewer than code points
        return None
    key = key.lower()
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


@dataclass
class LineIndex:
    """See the module; ``postings`` (shard, key, doc), ``counts`` (shard, key,
    refs, last), ``filters`` (shard, filter)."""

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int


def postings(docs: DataFrame, shards: int, min_chars: int) -> DataFrame:
    """Distinct (shard, key, doc) of the long lines of documents (doc, text)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [({k for x in text.split(b"\n") if (k := line_key(x, min_chars))} if doc is not None else (), doc)
                    for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([k for ks, _ in made for k in ks], pa.binary()),
                "doc": pa.array([doc for ks, doc in made for _ in ks], pa.int64())})

    rows = docs.mapInArrow(keys, "key binary, doc long").distinct()
    return rows.select(F.expr(f"pmod(xxhash64(key), {shards})").cast("int").alias("shard"), "key", "doc")


def _counted(rows: DataFrame) -> DataFrame:
    """Partial sums before the shuffle: a line found in a third of all documents is one row a task."""
    return rows.groupBy("shard", "key").agg(F.count("*").alias("refs"), F.max("doc").alias("last"))


def _numbers(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(k)[:8] for k in keys), np.uint64)


def _changed_filters(filters: DataFrame, moves: DataFrame) -> DataFrame:
    """Filters after ``moves`` (shard, key, up boolean) of frequent keys."""

    def change(key: tuple, old: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
        up, down = moved[moved.up], moved[~moved.up]
        held = CuckooFilter.load(bytes(old["filter"].iloc[0])) if len(old) else CuckooFilter.sized(len(up))
        held.delete(_numbers(down.key))
        held.insert(_numbers(up.key))
        return pd.DataFrame({"shard": [key[0]], "filter": [held.dump()]})

    moves = moves.select(F.col("shard").alias("of"), "key", "up")
    return filters.groupBy("shard").cogroup(moves.groupBy("of")).applyInPandas(change, "shard int, filter binary")


def _grown(filters: DataFrame, moves: DataFrame, frequent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Filters without those that ``frequent`` would overfill, and moves that build these anew."""
    count = [F.hex(F.substr("filter", F.lit(i), F.lit(1))) for i in range(8, 0, -1)]  # of buckets, least byte first
    places = SLOTS * F.conv(F.concat(*count), 16, 10).cast("double")
    full = (frequent.groupBy("shard").agg(F.count("*").alias("keys")).join(filters.select("shard", places.alias("places")), "shard")
            .where(F.col("keys") > FULL * F.col("places")).select("shard"))
    full = stage(full, "line-full-filters")
    whole = frequent.join(full, "shard", "left_semi").select("shard", "key", F.lit(True).alias("up"))
    return filters.join(full, "shard", "left_anti"), moves.select("shard", "key", "up").join(full, "shard", "left_anti").unionByName(whole)


def empty_index(docs: DataFrame, shards: int, min_docs: int, min_chars: int) -> LineIndex:
    make = lambda schema: docs.sparkSession.createDataFrame([], schema)
    return LineIndex(make("shard int, key binary, doc long"), make("shard int, key binary, refs long, last long"),
                     make("shard int, filter binary"), shards, min_docs, min_chars)


def _moved(index: LineIndex, counts: DataFrame, changed: DataFrame) -> LineIndex:
    """The index with new counts of the keys in ``changed`` (shard, key, refs, last; refs 0: gone)."""
    before = index.counts.select("shard", "key", F.col("refs").alias("was"))
    moves = (changed.join(before, ["shard", "key"], "left")
             .select("shard", "key", (F.col("refs") >= index.min_docs).alias("up"),
                     (F.coalesce("was", F.lit(0)) >= index.min_docs).alias("had"))
             .where("up <> had").drop("had"))
    filters = index.filters
    if not filters.isEmpty():
        filters, moves = _grown(filters, moves, counts.where(F.col("refs") >= index.min_docs))
    filters = stage(_changed_filters(filters, moves), "line-filters")
    return LineIndex(index.postings, counts, filters, index.shards, index.min_docs, index.min_chars)


def insert(index: LineIndex, docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    """The index with ``docs`` added; a document already there gets its new lines added to the old ones."""
    own = pick(docs, doc=doc_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    rows = postings(own, index.shards, index.min_chars)
    first = index.postings.isEmpty()
    if not first:
        rows = rows.join(index.postings, ["shard", "key", "doc"], "left_anti")
    rows = stage(rows, "line-postings")
    new = _counted(rows)
    if first:
        changed = counts = stage(new, "line-counts")
    else:
        old = index.counts.join(new.select("shard", "key"), ["shard", "key"], "left_semi")
        changed = stage(old.unionByName(new).groupBy("shard", "key").agg(F.sum("refs").alias("refs"), F.max("last").alias("last")), "line-changes")
        counts = stage(index.counts.join(changed, ["shard", "key"], "left_anti").unionByName(changed), "line-counts")
    moved = _moved(index, counts, changed)
    moved.postings = rows if first else stage(index.postings.unionByName(rows), "line-postings")
    return moved


def delete(index: LineIndex, doc_ids: DataFrame, doc_col: str = "doc_id") -> LineIndex:
    """The index without the documents whose ids are given."""
    gone = pick(doc_ids, doc=doc_col).select(F.col("doc").cast("long")).dropna().distinct()
    lost = index.postings.join(gone, "doc", "left_semi").select("shard", "key").distinct()
    left = stage(index.postings.join(gone, "doc", "left_anti").select("shard", "key", "doc"), "line-postings")
    still = _counted(left.join(lost, ["shard", "key"], "left_semi"))
    changed = stage(lost.join(still, ["shard", "key"], "left")
                    .select("shard", "key", F.coalesce("refs", F.lit(0).cast("long")).alias("refs"), "last"), "line-changes")
    counts = stage(index.counts.join(changed, ["shard", "key"], "left_anti").unionByName(changed.where("refs > 0")), "line-counts")
    moved = _moved(index, counts, changed)
    moved.postings = left
    return moved


def dropped_keys(index: LineIndex, least_rows: int = 1000, most_rows: int = 500_000) -> DataFrame:
    """(doc, keys): the keys whose lines a document loses.

    Each shard's postings meet the shard's filter in pieces of about the mean
    shard's size (``least_rows`` at least, ``most_rows`` at most): a shard with a very common line has
    as many more pieces, spread by document. Only hits go on to the exact counts.
    """
    sizes = index.postings.groupBy("shard").agg(F.count("*").alias("n"))
    mean = sizes.agg(F.avg("n").alias("mean")).select("mean").scalar()
    pieces = (sizes.select("shard", F.ceil(F.col("n") / F.least(F.greatest(mean, F.lit(float(least_rows))), F.lit(float(most_rows)))).alias("pieces"))
              .join(index.filters, "shard"))
    filters = pieces.select(F.col("shard").alias("of"), F.explode(F.expr("sequence(0L, pieces - 1)")).alias("part"), "filter")
    counted = F.broadcast(pieces.select("shard", "pieces"))  # a short row a shard, MOST_SHARDS at most
    rows = (index.postings.join(counted, "shard")
            .select("shard", F.expr("pmod(xxhash64(doc), pieces)").alias("piece"), "key", "doc"))

    def ask(key: tuple, own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if len(own) and len(held):
            own = own[CuckooFilter.load(bytes(held["filter"].iloc[0])).contains(_numbers(own.key))]
        return own[["shard", "key", "doc"]]

    hits = (rows.groupBy("shard", "piece").cogroup(filters.groupBy("of", "part"))
            .applyInPandas(ask, "shard int, key binary, doc long"))
    frequent = index.counts.where(F.col("refs") >= index.min_docs)
    return (hits.join(frequent, ["shard", "key"]).where("doc < last")
            .groupBy("doc").agg(F.collect_list("key").alias("keys")))


def drop_lines(docs: DataFrame, index: LineIndex, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines the index drops, and n_lines, n_dropped (long)."""
    names = docs.columns
    doc_at, text_at = names.index(doc_col), names.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    joined = plain.join(dropped_keys(index), F.col(f"c{doc_at}").cast("long") == F.col("doc"), "left").drop("doc")
    min_chars = index.min_chars

    def kept(text: bytes | None, keys: set | None) -> tuple[bytes | None, int, int]:
        lines = (text or b"").split(b"\n")
        if not keys:
            return text, len(lines), 0
        left = [x for x in lines if line_key(x, min_chars) not in keys]
        return b"\n".join(left), len(lines), len(lines) - len(left)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            keys = [None if x is None else set(x) for x in batch.column(len(names)).to_pylist()]
            made = [kept(*x) for x in zip(texts, keys, strict=True)]
            columns = batch.columns[:-1]
            columns[text_at] = pa.array([x[0] for x in made], pa.binary()).cast(pa.string())
            columns += [pa.array([x[i] for x in made], pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])

    schema = S.StructType([S.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
                          + [S.StructField(x, S.LongType()) for x in ("n_lines", "n_dropped")])
    out = joined.mapInArrow(cut, schema)
    old = [i for i, n in enumerate(names) if n not in ("n_lines", "n_dropped")]
    return out.select(*[f"c{i}" for i in old], "n_lines", "n_dropped").toDF(*[names[i] for i in old], "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, shards: int | None = None,
                doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index all documents and drop their repeated lines. Unless told, the number of shards grows with the text."""
    if shards is None:
        size = pick(docs, text=text_col).agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first().size or 0
        shards = min(MOST_SHARDS, max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES))
    index = insert(empty_index(docs, shards, min_docs, min_chars), docs, doc_col, text_col)
    return drop_lines(docs, index, doc_col, text_col)
