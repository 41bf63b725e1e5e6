import numpy as np
import pytest
from pyspark.sql import functions as F

from rackpulse.llm import permutation_index as P
from rackpulse.llm import tiles as T
from rackpulse.llm.exact_topk import _products, exact_topk

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as vec", "'x' as Embedding")


def brute(rows, k, every, score):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = {}
        for i, v in ok:
            for j, w in ok:
                if i == q and j != q and len(v) == len(w):
                    best[j] = max(best.get(j, -INF), score(v, w))
        order = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, j, s) for n, (j, s) in enumerate(order)]
    return out


def whole(v, w):
    return sum(int(np.floor(1024 * a)) * int(np.floor(1024 * b)) for a, b in zip(v, w, strict=True))


AWKWARD = [(0, [1.0, 2.0]), (0, [3.0, -1.0]), (1, None), (2, []), (4, []), (3, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]),
           (7, [0.0, 0.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0, 3.0]), (10, [-0.0004, 5.5]), (12, [1.0, 2.0]), (14, [2.0, 1.0])]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_exact_topk_awkward_rows(spark, k):
    got = exact_topk(table(spark, AWKWARD), k, F.expr("id % 2 = 0")).collect()
    assert sorted(map(tuple, got)) == brute(AWKWARD, k, 2, whole)


def test_exact_topk_over_many_tiles_with_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), rng.integers(-2, 3, 8).astype(float).tolist()) for i in rng.permutation(600)] + [(int(i), [1.0] * 8) for i in range(600, 900)]
    df = table(spark, rows).repartition(7)
    got = exact_topk(df, 10, F.expr("id % 50 = 0"), tile_rows=32, block_rows=5, shard_bytes=4000).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 50, whole)


def test_products_stay_exact():
    big = np.array([[3e8, 1.0], [-3e8, 2.0]])
    assert _products(big, big).tolist() == [[9 * 10**16 + 1, -9 * 10**16 + 2], [-9 * 10**16 + 2, 9 * 10**16 + 4]]
    huge = np.array([[1e15, 1.0]])
    assert _products(huge, huge).tolist() == [[(1 << 63) - 1]]


def test_empty_tables(spark):
    assert exact_topk(table(spark, []), 5, F.expr("id % 2 = 0")).count() == 0
    assert P.nearest(table(spark, []), 5, F.expr("id % 2 = 0")).count() == 0
    assert P.nearest(table(spark, [(1, [1.0])]), 5, F.expr("id % 2 = 0")).count() == 0


def test_permutation_index_awkward_rows(spark):
    got = P.nearest(table(spark, AWKWARD), 3, F.expr("id % 2 = 0")).collect()
    usable = [(i, v) for i, v in AWKWARD if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    assert sorted(map(tuple, got)) == brute(usable, 3, 2, lambda v, w: float((np.array(v) * np.array(w)).sum()))


@pytest.mark.parametrize("norms", [False, True])
def test_permutation_index_recall(spark, norms):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms:
        x *= rng.uniform(0.2, 1.0, 6000)[:, None]
    x[2000:4000] = x[7]  # a third of all rows are one vector
    got = P.nearest(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), 20, F.expr("id % 100 = 0")).collect()
    hits, found = 0, {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    for q in range(0, 6000, 100):
        s = (x * x[q]).sum(1)
        s[q] = -INF
        want = np.lexsort((np.arange(6000), -s))[:20]
        own = sorted(found[q], key=lambda r: r.rank)
        assert [r.score for r in own] == [s[r.vec_id] for r in own] and [r.rank for r in own] == list(range(1, 21))
        assert all((a.score, -a.vec_id) > (b.score, -b.vec_id) for a, b in zip(own, own[1:], strict=False))
        hits += len({r.vec_id for r in own} & set(want.tolist()))
    assert hits / (60 * 20) >= 0.9


def test_footrule_gains():
    rng = np.random.default_rng(3)
    order = np.stack([rng.permutation(12)[:5] for _ in range(30)]).astype(np.int32)
    files = P.inverted(order, 12)
    place = np.full((30, 12), 5)
    np.put_along_axis(place, order, np.arange(5)[None, :], 1)
    for q in range(30):
        gains = P.footrule_gains(order[q], *files, 30, 5)
        assert (30 - 2 * gains == np.abs(place - place[q]).sum(1)).all()


def test_best_breaks_ties_by_id():
    rows, ids, scores = T.best(np.array([0, 0, 0, 0, 1]), np.array([9, 3, 3, 5, 1]), np.array([2, 2, 7, 2, 1]), 3)
    assert list(zip(rows.tolist(), ids.tolist(), scores.tolist(), strict=True)) == [(0, 3, 7), (0, 5, 2), (0, 9, 2), (1, 1, 1)]


def test_an_id_on_many_vectors_leaves_room_for_others(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=8)
    rows = [(0, base.tolist())] + [(1, (base + 0.01 * rng.normal(size=8)).tolist()) for _ in range(60)]
    rows += [(2 + i, rng.normal(size=8).tolist()) for i in range(98)]
    got = sorted(P.nearest(table(spark, rows), 20, F.expr("id = 0")).collect(), key=lambda r: r.rank)
    assert [r.rank for r in got] == list(range(1, 21)) and got[0].vec_id == 1 and len({r.vec_id for r in got}) == 20
