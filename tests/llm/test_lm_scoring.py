import math
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, awkward, fold, words

from rackpulse.llm import lm_scoring as L

TEXTS = ["the cat sat on the mat", "the dog sat on the cat", "a dog and a cat", "The  mat\tis on THE dog", "cat cat cat", "unseen words here"]


def brute(rows, weights):
    """Scores from plain counts and the weights that were learned."""
    tokens = [[*words(t), None] for _, t in rows]
    folds = [0 if d is None else fold(d, 10) for d, _ in rows]
    uni, pairs, texts = Counter(), Counter(), 0
    for own, f in zip(tokens, folds, strict=True):
        if f:
            texts += 1
            uni.update(own)
            pairs.update(zip([0, *own], own, strict=False))
    n, v = sum(uni.values()), len(uni)
    out = []
    for (d, _), own, f in zip(rows, tokens, folds, strict=True):
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        total = 0.0
        for h, w in zip([0, *own], own, strict=False):
            c = texts if h == 0 else uni[h]
            a, b, e = weights[c.bit_length()]
            total += math.log10(a * (pairs[h, w] / c if c else 0) + b * uni[w] / n + e / (v + 1))
        out.append((d, f == 0, len(own), sum(uni[w] > 0 for w in own), n, base, total))
    return sorted(out, key=lambda r: str(r[:4]))


@pytest.fixture()
def learned(monkeypatch):
    seen, plain = [], L.learned_weights
    monkeypatch.setattr(L, "learned_weights", lambda *a, **k: seen.append(plain(*a, **k)) or seen[-1])
    return seen


@pytest.mark.parametrize(("chunk", "tokens"), [(1 << 20, 1 << 20), (300, 40)])
def test_matches_brute_force(spark, learned, chunk, tokens):
    rows = [(i, TEXTS[i % len(TEXTS)] + f" w{i % 7}") for i in range(120)] + AWKWARD
    df = spark.createDataFrame(rows[:120], "doc_id long, text string").unionByName(awkward(spark, extra=False))
    got = sorted(map(tuple, L.score(df, chunk_bytes=chunk, range_tokens=tokens).collect()), key=lambda r: str(r[:4]))
    want = brute(rows, learned[0])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
    assert np.allclose(learned[0].sum(1), 1)


def test_weights_maximise_held_out_likelihood(spark):
    rows = [(3, 4, 8, 20, 50), (3, 0, 8, 20, 30), (3, 1, 10, 2, 20), (0, 0, 0, 5, 10)]
    held = spark.createDataFrame(rows, "bucket long, pair long, context long, word long, n long")
    weights = L.learned_weights(held, 1000, 99, rounds=200)

    def likelihood(w):
        own = [(p / c, u / 1000, 1 / 100, n) for b, p, c, u, n in rows if b == 3]
        return sum(n * math.log(w[0] * x + w[1] * y + w[2] * z) for x, y, z, n in own)

    best = max((likelihood((a / 50, b / 50, 1 - a / 50 - b / 50)) for a in range(1, 50) for b in range(1, 50 - a)), default=0)
    assert likelihood(weights[3]) > best - 1.5  # the shared prior pulls a little
    assert weights[0][0] == 0


def test_held_out_text_scores_better_than_the_base(spark):
    rows = [(i, TEXTS[i % 5]) for i in range(300)]
    got = L.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert got and all(r.score > r.base_score for r in got)


def test_nothing_to_learn_and_empty(spark, learned):
    assert L.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = L.score(spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string").selectExpr("*", "1 as fold", "2 as Text")).collect()
    assert sorted((r.n_tokens, r.n_known, r.score) for r in got) == [(1, 0, 0.0), (3, 0, 0.0)]


def test_squeezed_round_trip():
    for kind in (np.uint32, np.uint64):
        values = np.array([0, 1, 5, 1 << 31, 7], kind)
        assert (L.released(L.squeezed(values), kind) == values).all()
    assert len(L.released(L.squeezed(np.empty(0, np.uint32)), np.uint32)) == 0
