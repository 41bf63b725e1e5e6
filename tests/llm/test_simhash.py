import random

import numpy as np
import xxhash
from helpers import AWKWARD, awkward, words

from rackpulse.llm import simhash as X


def fingerprint(text, n=3):
    own = words(text)
    shingles = [" ".join(own[i: i + n]) for i in range(max(1, len(own) - n + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, bits=2):
    """Smallest id reachable, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    group = {}
    for i, (d, _) in enumerate(prints):
        group.setdefault(find(i), []).append(d)
    return [min((x for x in group[find(i)] if x is not None), default=None) for i in range(len(prints))]


def test_fingerprints_and_components(spark):
    prints = [(d, fingerprint(t)) for d, t in AWKWARD]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute(prints), strict=True)), key=str)
    assert sorted(map(tuple, X.near_duplicates(awkward(spark)).collect()), key=str) == want
    assert X.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_links_connect_what_the_distance_connects(spark):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = {0, (1 << 64) - 1, 1 << 63}
    for c in centres:
        for _ in range(12):
            x = c
            for b in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    linked = X.components(X.links(spark.createDataFrame(signed, "print long"), 2)).collect()
    root = {r.node: r.root for r in linked}
    got = [root.get(s, s) for s, in signed]
    want = brute([(s, p) for (s,), p in zip(signed, prints, strict=True)])
    assert got == want


def test_a_dense_family_is_linked_by_lookups():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 16, 3000).astype(np.uint64))  # as in one posting list
    a, b = X._near(values, 2)
    i, j = np.triu_indices(len(values), 1)
    near = np.bitwise_count(values[i] ^ values[j]) <= 2
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(i[near].tolist(), j[near].tolist(), strict=True))


def test_chain_component(spark):
    edges = [(i + 1, i) for i in range(200)] + [(500, 400), (500, 500)]
    got = {r.node: r.root for r in X.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 500: 400}


def test_keep_one(spark):
    def kept(rows):
        return sorted(map(tuple, X.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)

    same, other = "a b c d e", "quite other words here now"
    assert kept([(5, same), (2, same.upper()), (9, other), (None, same)]) == sorted([(2, same.upper()), (9, other)], key=str)
    assert kept([(1, same), (1, same), (2, same), (2, other)]) == [(1, same), (2, other)]  # rows, not ids
    assert kept([(None, same), (None, same), (None, other)]) == sorted([(None, same), (None, other)], key=str)


def test_keep_one_against_brute_force(spark):
    df = awkward(spark)
    roots = brute_rows([fingerprint(t) for _, t in AWKWARD])
    got = sorted((tuple(r) for r in X.keep_one(df).select(*df.columns[:1]).collect()), key=str)
    best = {}
    for (d, _), root in zip(AWKWARD, roots, strict=True):
        best[root] = min(best.get(root, (True, 0)), (d is None, d or 0))
    assert got == sorted(((None if missing else d,) for missing, d in best.values()), key=str)
    assert X.keep_one(df).columns == df.columns and X.keep_one(df.limit(0)).count() == 0


def brute_rows(prints, bits=2):
    return brute([(i, p) for i, p in enumerate(prints)], bits)
