import random

import pytest
from helpers import awkward, words

from rackpulse.llm import mixing as M


def expected(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing out again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= full
    return target


def corpus(spark, n=900, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "B", "é", "zz", None, "\U0001F600", "｡"])
        rows.append((i, source, " ".join(["w"] * int(rng.paretovariate(1.1) * 5 % 4000))))
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_rates_and_copies(spark, seed):
    rows, df = corpus(spark, seed=seed)
    got = M.copies(M.sized(df.repartition(5))).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = expected(sizes)
    assert {r.doc: r.size for r in got} == {d: len(words(t)) for d, _, t in rows}
    by = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6) and 0 <= r.copies <= 2 and abs(r.copies - r.rate) < 2
        by.setdefault(r.source, []).append(r)
    for s, own in by.items():
        assert sum(r.size * r.rate for r in own) == pytest.approx(want[s], abs=1.5, rel=1e-6)  # the dual is solved
        taken = sum(r.size * r.copies for r in own)
        assert want[s] - 0.02 * want[s] - 1 <= taken <= want[s] + 1
        odds = sorted((r.size, r.rate / (2 - r.rate)) for r in own if 0 < r.rate < 2 and r.size)
        import math
        tilts = [math.log(o) / size for size, o in odds if 1e-6 < o < 1e6]
        assert not tilts or max(tilts) - min(tilts) < 1e-6  # one exponential tilt a source
    again = {(r.doc, r.copies) for r in M.copies(M.sized(df)).collect()}
    assert again == {(r.doc, r.copies) for r in got}


def test_mixed_repeats_rows_and_keeps_columns(spark):
    _, df = corpus(spark, 200)
    df = df.selectExpr("*", "1 as row", "2 as size", "'x' as Source")
    dealt = {r.doc: r.copies for r in M.copies(M.sized(df)).collect()}
    out = M.mixed(df)
    assert out.columns == df.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: c for d, c in dealt.items() if c}


def test_awkward_rows(spark):
    df = awkward(spark, extra=False).selectExpr("*", "if(doc_id < 6, 'empty-ish', null) as source", "0 as Text", "1 as number")
    got = M.copies(M.sized(df)).collect()
    assert len(got) == df.count()
    assert all(r.copies == 1 and r.size == 0 for r in got if r.size == 0)
    only_empty = spark.createDataFrame([(1, "s", None), (2, None, "")], "doc_id long, source string, text string")
    assert [(r.target, r.copies) for r in M.copies(M.sized(only_empty)).collect()] == [(0.0, 1)] * 2
    assert M.copies(M.sized(only_empty.limit(0))).count() == 0
    assert M.mixed(only_empty.limit(0)).count() == 0


def test_numbers_follow_code_points(spark):
    names = ["b", "a", None, "é", "Z", "\U0001F600", "｡", ""]
    df = spark.createDataFrame([(n, 1, 1) for n in names], "source string, source_size long, docs long")
    got = {r.source: r.number for r in M.numbered(df).collect()}
    assert got == {n: i for i, n in enumerate([*sorted(n for n in names if n is not None), None])}


def test_the_layout_of_the_rows_does_not_matter(spark):
    _, df = corpus(spark, 400)
    one, many = ({(r.doc, r.copies) for r in M.copies(M.sized(df.repartition(n))).collect()} for n in (1, 7))
    assert one == many
