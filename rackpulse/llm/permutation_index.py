"""Approximate nearest neighbours by a permutation index (largest inner product).

Each vector is represented by the order of its ``prefix`` nearest pivots and
posted, with its place in that order, in the inverted file of each of them.
A query walks the inverted files of its own nearest pivots, adding up what
every posted vector's footrule distance to it is less than the largest
possible one (a pivot missing from an order counts as standing behind its
end), reranks the vectors of smallest footrule distance by the exact inner
product, and the per-shard lists are merged in a tree.

* Pivots are a bounded sample (``pivots`` vectors, fixed by a hash of their
  content); every vector is indexed.
* Largest inner product is turned into nearness by one more coordinate,
  sqrt(M^2 - |x|^2) for indexed vectors (M: the largest norm) and 0 for
  queries, so vectors of unequal norms are ordered rightly too.
* Equal vectors are indexed once, with their smallest ids (one more than
  ``k``, all any answer can use), so a vector shared by a third of all rows
  neither fills an inverted file nor crowds others out of the rerank.
* Each shard reranks the ``rerank`` share of its vectors, whatever its size, but
  as many as are needed to hold k ids beside the query's (an id may have several vectors).

Defined results:

* null vectors, zero vectors (and empty ones), vectors holding null or
  non-finite components and rows with a null id take no part;
* only vectors of the same length are compared;
* scores are computed on the original vectors in double precision, alike for
  equal vectors; ties go to the smaller id; a query's own id is no candidate;
  an id that several rows repeat acts as one row with several vectors;
* an empty table, or one without queries, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tiles as T
from .common import pick, stage, task_number

DISTINCT = "hash binary, salt int, dim int, vec binary, ids array<long>"
INDEX = "tile long, dim int, n int, ids binary, vecs binary, ends binary, starts binary, posted binary, places binary"


def distinct_vectors(vectors: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """(hash, dim, vec, ids): each usable vector once with its ``k`` smallest ids.

    Ids are cut to ``k`` in each batch, then per (vector, salt), then per
    vector, so a common vector never gathers in one task.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            held: dict[bytes, list[int]] = {}
            for ids, vecs in T.matrices(batch.column(0), batch.column(1)):
                vecs = vecs + 0.0  # -0.0 and 0.0 are equal
                for i in np.nonzero(vecs.any(axis=1))[0]:
                    held.setdefault(vecs[i].tobytes(), []).append(int(ids[i]))
            yield pa.RecordBatch.from_pydict({
                "hash": pa.array([xxhash.xxh3_128_digest(v) for v in held], pa.binary()),
                "salt": pa.array([(task_number() + number) % salts] * len(held), pa.int32()),
                "dim": pa.array([len(v) // 8 for v in held], pa.int32()), "vec": pa.array(list(held), pa.binary()),
                "ids": pa.array([sorted(set(x))[:k] for x in held.values()], pa.list_(pa.int64()))})

    rows = vectors.mapInArrow(local, DISTINCT)
    for key in (["hash", "salt"], ["hash"]):
        rows = rows.groupBy(*key).agg(
            F.first("dim").alias("dim"), F.first("vec").alias("vec"),
            F.expr(f"slice(array_sort(array_distinct(flatten(collect_list(ids)))), 1, {k})").alias("ids"))
    return rows


def orders(points: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of each point's nearest pivots, nearest first (ties to the smaller number)."""
    away = (pivots * pivots).sum(1)[None, :] - 2.0 * points @ pivots.T
    return np.argsort(away, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def inverted(order: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverted files (starts, posted vector, place in its order) of all pivots, one after another."""
    n, prefix = order.shape
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[by], np.arange(pivots + 1)).astype(np.int64)
    return starts, (by // prefix).astype(np.int32), (by % prefix).astype(np.int16)


def raised(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the coordinate that makes all norms equal to ``top``."""
    return np.c_[vectors, np.sqrt(np.maximum(0.0, top * top - (vectors * vectors).sum(1)))]


def built(distinct: DataFrame, pivots: dict[int, np.ndarray], tops: dict[int, float], prefix: int, rows: int) -> DataFrame:
    """The index (schema ``INDEX``): per tile of vectors the inverted files of all pivots."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = 0
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                for at in range(0, len(own), rows):
                    part = own.iloc[at: at + rows]
                    vecs = np.frombuffer(b"".join(bytes(x) for x in part.vec), np.float64).reshape(len(part), dim)
                    order = orders(raised(vecs, tops[dim]), pivots[dim], prefix)
                    starts, posted, places = inverted(order, len(pivots[dim]))
                    made += 1
                    yield pd.DataFrame([(
                        task_number() << 32 | made, dim, len(part),
                        np.concatenate([np.asarray(x, np.int64) for x in part.ids]).tobytes(), vecs.tobytes(),
                        np.cumsum([len(x) for x in part.ids]).astype(np.int64).tobytes(),
                        starts.tobytes(), posted.tobytes(), places.tobytes())],
                        columns=INDEX.replace(" binary", "").replace(" long", "").replace(" int", "").split(", "))

    return distinct.select("dim", "vec", "ids").mapInPandas(index, INDEX)


def footrule_gains(order: np.ndarray, starts: np.ndarray, posted: np.ndarray, places: np.ndarray, n: int, prefix: int) -> np.ndarray:
    """Half of what each vector's footrule distance to the query falls short of
    the largest possible one: sum over shared pivots of prefix - max(places)."""
    gains = np.zeros(n, np.int32)
    for place, pivot in enumerate(order):
        a, b = starts[pivot], starts[pivot + 1]
        gains[posted[a:b]] += np.minimum(prefix - place, prefix - places[a:b])  # a vector is posted once in a file
    return gains


def nearest(vectors: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
            pivots: int = 256, prefix: int = 64, rerank: float = 0.15,
            tile_rows: int = 16384, block_rows: int = 512, shard_bytes: int = 32 << 20) -> DataFrame:
    """Each query's ``k`` nearest found: (query_id long, rank int from 1, vec_id long, score double).

    ``is_query`` is an expression over the column ``id``.
    """
    own = pick(vectors, id=id_col, vec=vec_col).withColumn("id", F.col("id").cast("long"))
    distinct = stage(distinct_vectors(own, k + 1), "ann-vectors")
    dims = [r.dim for r in distinct.select("dim").distinct().collect()]  # vector lengths: a handful

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"dim": b.column(0), "norm": pa.array(
                [float(np.sqrt((np.frombuffer(v, np.float64) ** 2).sum())) for v in b.column(1).to_pylist()])})

    tops = {r.dim: r.top for r in distinct.select("dim", "vec").mapInArrow(norms, "dim int, norm double")
            .groupBy("dim").agg(F.max("norm").alias("top")).collect()}
    sample = {}
    for dim in dims:  # a sample of ``pivots`` vectors, bounded whatever the table's size
        rows = distinct.where(F.col("dim") == dim).orderBy(F.xxhash64("hash"), "hash").limit(pivots).collect()
        sample[dim] = raised(np.stack([np.frombuffer(r.vec, np.float64) for r in rows]), tops[dim])

    tiles = stage(built(distinct, sample, tops, prefix, tile_rows), "ann-index")
    queries = stage(T.packed(own.where(is_query), block_rows), "ann-queries")

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in right.itertuples(index=False):
            if block.dim not in sample:
                continue
            qids, q = T.ids_of(block), T.vecs_of(block)
            used = q.any(axis=1)
            qids, q = qids[used], q[used]
            names, at = np.unique(qids, return_inverse=True)
            order = orders(np.c_[q, np.zeros(len(q))], sample[block.dim], prefix)
            found = []
            for tile in left[left.dim == block.dim].itertuples(index=False):
                vecs, ids, ends = T.vecs_of(tile), T.ids_of(tile), np.frombuffer(tile.ends, np.int64)
                files = (np.frombuffer(tile.starts, np.int64), np.frombuffer(tile.posted, np.int32), np.frombuffer(tile.places, np.int16))
                sizes = np.diff(ends, prepend=0)
                spare = int(np.unique(ids, return_counts=True)[1].max())  # vectors that one id has here
                cut = (k + 1) * spare  # hold k + 1 ids at least
                most = max(cut, int(np.ceil(rerank * tile.n)))
                for i in range(len(q)):
                    gains = footrule_gains(order[i], *files, tile.n, prefix)
                    if tile.n > most:
                        chosen = np.nonzero(gains >= np.partition(gains, tile.n - most)[tile.n - most])[0]
                    else:
                        chosen = np.arange(tile.n)
                    scores = (vecs[chosen] * q[i]).sum(axis=1)
                    _, top = T.at_least(scores[None, :], cut)
                    chosen, scores = chosen[top], scores[top]
                    own_ids = np.concatenate([ids[ends[c] - sizes[c]: ends[c]] for c in chosen]) if len(chosen) else ids[:0]
                    scores = np.repeat(scores, sizes[chosen])
                    keep = own_ids != qids[i]
                    found.append(T.best(np.full(keep.sum(), at[i]), own_ids[keep], scores[keep], k))
            if found:
                rows, ids, scores = T.best(*(np.concatenate(x) for x in zip(*found, strict=True)), k)
                out.append(T.list_row(key[1], key[0], block.dim, names, rows, ids, scores))
        return pd.DataFrame(out, columns=["grp", "shard", "dim", "qids", "counts", "vids", "scores"])

    lists, shards = T.cells(tiles, queries, search, shard_bytes)
    return T.unpacked(T.merged(lists, shards, k, np.float64), np.float64, "double")
