import random

import numpy as np
from helpers import AWKWARD, awkward, words
from pyspark.sql import functions as F

from rackpulse.llm import setsketch as X

SCHEMA = "doc_id long, text string"


def shingle_set(text, size=5):
    own = words(text)
    return {tuple(own[i: i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def brute(rows, share=85):
    """Smallest id reachable, by comparing all pairs of rows."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for j in {j for x in s for j in by.get(x, ())}:
            if find(i) != find(j) and 100 * len(s & sets[j]) >= share * len(s | sets[j]):
                parent[find(i)] = find(j)
        for x in s:
            by.setdefault(x, []).append(i)
    group = {}
    for i, (d, _) in enumerate(rows):
        group.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min((x for x in group[find(i)] if x is not None), default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def operator(df, **kw):
    return sorted((tuple(r) for r in X.near_duplicates(df, **kw).collect()), key=str)


def near_copies(seed, groups, copies, length, edits):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10 ** 6)}"
            if rng.random() < 0.1:
                own = own + own[:rng.randrange(40)]
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_awkward_rows(spark):
    assert operator(awkward(spark)) == brute(AWKWARD)
    assert operator(spark.createDataFrame([], SCHEMA)) == []


def test_near_copies_about_the_threshold(spark):
    """Pairs on both sides of 0.85; groups that hang together only through others."""
    rows = near_copies(1, 40, 12, 150, 4) + [(10000 + i, t) for i, t in near_copies(2, 30, 5, 12, 1)] + [(20000 + i, f"copy of {i % 3} words in one text here") for i in range(60)]
    assert operator(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_a_large_group_in_small_blocks(spark, monkeypatch):
    """One group of most rows, pivots in pieces, buckets in blocks of a few."""
    monkeypatch.setattr(X, "BLOCK", 40)
    rows = near_copies(3, 1, 500, 100, 5)
    assert operator(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_registers_are_mergeable_and_tell_the_similarity():
    rng = np.random.default_rng(5)
    for size, share in ((30, 0.8), (300, 0.5), (5000, 0.9)):
        pool = rng.integers(0, 1 << 63, 3 * size).astype(np.uint64)
        both = int(share * size)
        estimates = []
        for i in range(40):
            a = np.unique(X.mixed(pool[:size] + np.uint64(i)))
            b = np.unique(X.mixed(pool[size - both: 2 * size - both] + np.uint64(i)))
            ka, kb, kc = X.sketches([a, b, np.union1d(a, b)])
            assert (np.maximum(ka, kb) == kc).all()
            estimates.append(X.estimate(ka[None], kb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0])
        true = both / (2 * size - both)
        assert abs(np.mean(estimates) - true) < 0.02 and np.std(estimates) < 0.06


def test_the_slope_tells_what_the_estimate_tells():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 40, (300, X.REGISTERS)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < rng.random((300, 1)), a, rng.integers(0, 40, a.shape)).astype(np.uint16)
    na = rng.integers(850, 1000, 300).astype(float)
    nb = np.full(300, 1000.0)
    want = (X.estimate(a, b, na, nb) >= X.least_estimate(85)) & (2 * (a == b).sum(axis=1) >= X.REGISTERS)
    assert (X.likely(a, b, na, nb, 85) == want).all() and 50 < want.sum() < 250


def test_rows_without_ids(spark):
    rows = [(None, "one two three four five six")] * 5 + [(None, "quite another text of seven words here"), (3, "One two three four five six")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("node"), F.lit("x").alias("Text"))
    assert operator(df) == sorted([(None, 2, 3, False)] * 5 + [(None, 3, None, True), (3, 2, 3, True)], key=str)
