"""Vectors packed into tiles, and top lists merged in a tree.

A tile is one row: up to ``rows`` vectors of one length as a matrix of doubles
beside their ids. A search meets a block of queries with a tile of vectors in
one task; the work is laid out on a grid of (shard of vectors, group of
queries), both of bounded size, so no task holds all of either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import task_number

TILE = "tile long, dim int, n int, ids binary, vecs binary"
LISTS = "grp long, shard long, dim int, qids binary, counts binary, vids binary, scores binary"


def matrices(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) per vector length of the usable rows of a batch.

    Unusable: a null id, a null vector, a vector holding a null or non-finite
    component.
    """
    vectors = vectors.cast(pa.list_(pa.float64()))
    starts = np.asarray(vectors.offsets, dtype=np.int64)
    flat = vectors.values
    bad = np.asarray(flat.is_null()) if flat.null_count else np.zeros(len(flat), bool)
    values = np.asarray(flat.fill_null(0.0), dtype=np.float64)
    bad = np.concatenate([[0], np.cumsum(bad | ~np.isfinite(values))])
    good = (bad[starts[1:]] == bad[starts[:-1]]) & ~np.asarray(vectors.is_null()) & ~np.asarray(ids.is_null())
    numbers = np.asarray(ids.fill_null(0), dtype=np.int64)
    dims = np.diff(starts)
    for dim in np.unique(dims[good]):
        rows = np.nonzero(good & (dims == dim))[0]
        yield numbers[rows], values[starts[rows][:, None] + np.arange(dim)]


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Tiles (schema ``TILE``) of a DataFrame (id long, vec array)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = 0, {}

        def tile(dim: int, n: int) -> pa.RecordBatch:
            nonlocal made
            ids = np.concatenate([x[0] for x in held[dim]])
            vecs = np.concatenate([x[1] for x in held[dim]])
            held[dim] = [(ids[n:], vecs[n:])] if len(ids) > n else []
            made += 1
            return pa.RecordBatch.from_pydict({
                "tile": pa.array([task_number() << 32 | made], pa.int64()), "dim": pa.array([dim], pa.int32()),
                "n": pa.array([min(n, len(ids))], pa.int32()), "ids": [ids[:n].tobytes()], "vecs": [vecs[:n].tobytes()]})

        for batch in batches:
            for ids, vecs in matrices(batch.column(0), batch.column(1)):
                dim = vecs.shape[1]
                held.setdefault(dim, []).append((ids, vecs))
                while sum(len(x[0]) for x in held[dim]) >= rows:
                    yield tile(dim, rows)
        for dim in [d for d, x in held.items() if x]:
            yield tile(dim, rows)

    return vectors.mapInArrow(pack, TILE)


def ids_of(row) -> np.ndarray:
    return np.frombuffer(row.ids, dtype=np.int64)


def vecs_of(row) -> np.ndarray:
    return np.frombuffer(row.vecs, dtype=np.float64).reshape(row.n, row.dim)


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best distinct ids of each row number: largest score first,
    ties to the smaller id; an id that comes twice counts with its best score."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    if len(rows):
        again = np.lexsort((np.arange(len(rows)), ids, rows))
        first = np.ones(len(rows), bool)
        first[again[1:]] = (rows[again[1:]] != rows[again[:-1]]) | (ids[again[1:]] != ids[again[:-1]])
        rows, ids, scores = rows[first], ids[first], scores[first]
        begin = np.r_[0, np.nonzero(np.diff(rows))[0] + 1]
        rank = np.arange(len(rows)) - np.repeat(begin, np.diff(np.r_[begin, len(rows)]))
        rows, ids, scores = rows[rank < k], ids[rank < k], scores[rank < k]
    return rows, ids, scores


def at_least(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of each row's ``k`` largest scores, with all
    that tie with the last of them."""
    if scores.shape[1] <= k:
        return np.nonzero(np.ones(scores.shape, bool))
    cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return np.nonzero(scores >= cut[:, None])


def list_row(grp: int, shard: int, dim: int, qids: np.ndarray, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple:
    """One row of top lists for the queries ``qids``; ``rows`` are positions in it, ascending."""
    counts = np.bincount(rows, minlength=len(qids)).astype(np.int32)
    return (grp, shard, dim, qids.tobytes(), counts.tobytes(), ids.tobytes(), scores.tobytes())


def grid(tiles: DataFrame, queries: DataFrame, shards: int, groups: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt out to the cells (shard, grp) of the grid: each tile
    goes to its shard's cells, each block of queries to its group's."""
    left = (tiles.withColumn("shard", F.expr(f"pmod(xxhash64(tile), {shards}L)"))
            .withColumn("grp", F.explode(F.expr(f"sequence(0L, {groups - 1}L)"))))
    right = (queries.withColumn("grp", F.expr(f"pmod(xxhash64(tile), {groups}L)"))
             .withColumn("shard", F.explode(F.expr(f"sequence(0L, {shards - 1}L)"))))
    return left, right


def merged(lists: DataFrame, shards: int, k: int, kind: type, fan_in: int = 8) -> DataFrame:
    """Tree merge: in each round up to ``fan_in`` neighbouring shards' lists of
    a group of queries become one, until one is left."""
    columns = LISTS.replace(" binary", "").replace(" long", "").replace(" int", "").split(", ")

    def join(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, own in parts.groupby("dim"):
            qids, at, ids, scores = [], [], [], []
            for r in own.itertuples(index=False):
                q = np.frombuffer(r.qids, np.int64)
                at.append(np.repeat(q, np.frombuffer(r.counts, np.int32)))
                qids.append(q)
                ids.append(np.frombuffer(r.vids, np.int64))
                scores.append(np.frombuffer(r.scores, kind))
            every, at = np.unique(np.concatenate(qids)), np.concatenate(at)
            rows, ids, scores = best(np.searchsorted(every, at), np.concatenate(ids), np.concatenate(scores), k)
            out.append(list_row(key[0], key[1], dim, every, rows, ids, scores))
        return pd.DataFrame(out, columns=columns)

    while shards > 1:
        shards = -(-shards // fan_in)
        lists = (lists.withColumn("shard", F.expr(f"shard div {fan_in}"))
                 .groupBy("grp", "shard").applyInPandas(join, LISTS))
    return lists


def unpacked(lists: DataFrame, kind: type, score: str) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of merged lists."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                counts = np.frombuffer(r.counts, np.int32)
                ends = np.cumsum(counts)
                yield pd.DataFrame({
                    "query_id": np.repeat(np.frombuffer(r.qids, np.int64), counts),
                    "rank": (np.arange(counts.sum()) - np.repeat(ends - counts, counts) + 1).astype(np.int32),
                    "vec_id": np.frombuffer(r.vids, np.int64), "score": np.frombuffer(r.scores, kind)})

    return lists.mapInPandas(rows, f"query_id long, rank int, vec_id long, score {score}")


def cells(tiles: DataFrame, queries: DataFrame, search: Callable, most: int) -> tuple[DataFrame, int]:
    """``search(key, tiles, queries)`` over the grid; returns lists and the number of shards.

    A shard or group of queries holds about ``most`` bytes of vectors; there
    are at least as many cells as the cluster runs tasks.
    """
    spark = tiles.sparkSession
    size = F.sum(F.col("n").cast("long") * (F.col("dim") + 1) * 8)
    n_bytes, q_bytes = (df.agg(F.coalesce(size, F.lit(0)).alias("b")).first().b for df in (tiles, queries))
    groups = max(1, -(-q_bytes // most))
    n_tiles = tiles.count()
    shards = max(1, -(-n_bytes // most), min(n_tiles, spark.sparkContext.defaultParallelism))
    left, right = grid(tiles, queries, shards, groups)
    key = ["shard", "grp"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, LISTS), shards
