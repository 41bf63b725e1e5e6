"""Exact top-k search by tiled matrix products.

Queries and vectors are packed into tiles; each cell of a (shard of vectors,
group of queries) grid multiplies its query blocks with its vector tiles,
selects each query's best of every tile partially, and the per-query lists of
the shards are merged in a tree.

Defined results:

* null vectors, vectors with null or non-finite components and rows with a
  null id take no part, neither as queries nor as candidates;
* only vectors of the same length are compared; other lengths are no candidates;
* rows repeating an id act as one row with several vectors: a pair's score is
  the largest, and a query's own id is never its candidate;
* ties go to the smaller id; fewer candidates than ``k`` give a shorter list;
* inner products beyond the range of a long are cut to that range;
* an empty table, or one without queries, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tiles as T
from .common import pick, stage

LONG = (1 << 63) - 1


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products: doubles while every sum stays below 2^53,
    longs below 2^63, whole numbers of any size beyond."""
    most = max(1.0, np.abs(queries).max(initial=0.0)) * max(1.0, np.abs(vectors).max(initial=0.0)) * max(1, vectors.shape[1])
    if most < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    if most < 2.0**62:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    return np.clip(whole(queries) @ whole(vectors).T, -LONG, LONG).astype(np.int64)


def exact_topk(vectors: DataFrame, k: int, is_query: Column, scale: int = 1024, id_col: str = "vec_id",
               vec_col: str = "embedding", tile_rows: int = 4096, block_rows: int = 512, shard_bytes: int = 32 << 20) -> DataFrame:
    """Each query's ``k`` largest integer inner products of ``floor(scale * x)``.

    ``is_query`` is an expression over the column ``id``. Returns (query_id
    long, rank int from 1, vec_id long, score long).
    """
    own = pick(vectors, id=id_col, vec=vec_col).withColumn("id", F.col("id").cast("long"))

    def scaled(row) -> np.ndarray:
        return np.floor(T.vecs_of(row) * scale)

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in right.itertuples(index=False):
            qids, q, found = T.ids_of(block), scaled(block), []
            names, at = np.unique(qids, return_inverse=True)
            for tile in left[left.dim == block.dim].itertuples(index=False):
                ids = T.ids_of(tile)
                order = np.argsort(ids, kind="stable")
                ids, scores = ids[order], _products(q, scaled(tile)[order])
                spare = np.unique(ids, return_counts=True)[1].max()  # repeated ids share their places
                own_id = qids[:, None] == ids[None, :]
                rows, cols = T.at_least(np.where(own_id, -LONG - 1, scores), (k + 1) * spare)
                keep = ~own_id[rows, cols]
                rows, cols = rows[keep], cols[keep]
                found.append(T.best(at[rows], ids[cols], scores[rows, cols], k))
            if found:
                rows, ids, scores = T.best(*(np.concatenate(x) for x in zip(*found, strict=True)), k)
                out.append(T.list_row(key[1], key[0], block.dim, names, rows, ids, scores))
        return pd.DataFrame(out, columns=["grp", "shard", "dim", "qids", "counts", "vids", "scores"])

    tiles = stage(T.packed(own, tile_rows), "topk-tiles")
    queries = stage(T.packed(own.where(is_query), block_rows), "topk-queries")
    lists, shards = T.cells(tiles, queries, search, shard_bytes)
    return T.unpacked(T.merged(lists, shards, k, np.int64), np.int64, "long")
