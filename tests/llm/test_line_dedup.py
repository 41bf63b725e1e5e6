import random

import numpy as np
import pytest
from helpers import SPACE, awkward, lower_az

from rackpulse.llm import line_dedup as L


def brute(rows, min_docs=5, min_chars=40):
    keys = {}
    for doc, text in rows:
        if doc is None:
            continue
        for line in (text or "").split("\n"):
            k = lower_az(line.strip(SPACE))
            if len(k) >= min_chars:
                keys.setdefault(k, set()).add(doc)
    gone = {k: max(d) for k, d in keys.items() if len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if doc is None or gone.get(lower_az(x.strip(SPACE)), doc) == doc]
        out.append((doc, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def corpus(seed=1, docs=60):
    rng = random.Random(seed)
    pool = [f"Shared LINE number {i} with enough characters in it é" for i in range(8)] + ["exactly forty characters long, to be so.", "short shared line"]
    rows = []
    for d in range(docs):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"line of its own {d} {j} that nobody else has got" for j in range(rng.randrange(6))]
        rows.append((d, "\n".join((rng.choice(["", "  ", "\t"]) + x + rng.choice(["", " \r"])) for x in lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(L.dedup_lines(df)) == brute(rows)


def test_awkward_rows_and_clashing_columns(spark):
    df = awkward(spark)
    out = L.dedup_lines(df)
    assert out.columns.count("n_lines") == 1 and "Text" in out.columns
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in out.collect()), key=str)
    assert got == sorted(((d, n, k) for d, _, n, k in brute([(r.doc_id, r["text"]) for r in awkward(spark, extra=False).collect()])), key=str)


def test_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_count_once_and_ties_go_to_the_largest_id(spark):
    line = "the very same line, shared by rows of few documents"
    rows = [(1, line)] * 4 + [(2, line), (3, line), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(r.n_dropped for r in L.dedup_lines(df).collect()) == 0  # three documents only
    rows += [(4, line), (5, line), (5, line)]
    got = result(L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert [g for g in got if g[0] == 5] == [(5, line, 1, 0)] * 2 and (None, line, 1, 0) in got


def test_insert_then_delete_gives_back_the_index(spark):
    rows = corpus(3, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old, new = df.where("doc_id < 25"), df.where("doc_id >= 25")
    start = L.insert(L.empty_index(df, 4, 3, 40), old)
    grown = L.insert(start, new)
    back = L.delete(grown, new.select("doc_id"))
    flat = lambda d: sorted(tuple(map(bytes_of, r)) for r in d.collect())
    bytes_of = lambda x: bytes(x) if isinstance(x, bytearray) else x
    assert flat(back.counts) == flat(start.counts) and flat(back.postings) == flat(start.postings)
    assert result(L.drop_lines(df.where("doc_id < 25"), back)) == brute(rows[:25], 3)
    assert result(L.drop_lines(df, grown)) == brute(rows, 3)


def test_cuckoo_filter_never_loses_a_member():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.int64).astype(np.uint64)
    tight = L.CuckooFilter(1100)  # fuller than it can hold: some keys go to the stash
    tight.insert(keys)
    assert tight.contains(keys).all()
    assert L.CuckooFilter.load(tight.dump()).contains(keys).all()
    tight.delete(keys[:2500])
    assert tight.contains(keys[2500:]).all()
    assert tight.contains(keys[:2500]).mean() < 0.05
    tight.delete(keys[2500:])
    assert not tight.slots.any() and not tight.stash


def test_filters_grow_with_the_index(spark):
    """A first insertion of one frequent line, later ones of thousands: little is left to the stash."""
    def batch(docs, lines):
        return spark.createDataFrame([(d, "\n".join(f"line number {i}, long enough to count as one" for i in lines)) for d in docs],
                                     "doc_id long, text string")

    index = L.insert(L.empty_index(batch([1], [0]), 2, 2, 40), batch([1, 2], [0]))
    places = lambda x: {r.shard: L.CuckooFilter.load(bytes(r["filter"])) for r in x.filters.collect()}
    small = sum(f.slots.size for f in places(index).values())
    for start in (1, 300):
        index = L.insert(index, batch([10 * start, 10 * start + 1], range(start, 10 * start)))
        index = L.insert(index, batch([10 * start + 2], range(start)))
    held = places(index)
    assert sum(f.slots.size for f in held.values()) > 100 * small
    assert all((f.slots > 0).mean() <= L.FULL and len(f.stash) < 5 for f in held.values())
    frequent = {s: L._numbers([r.key for r in rs]) for s in held
                if (rs := index.counts.where(f"refs >= 2 and shard = {s}").collect())}
    assert sum(map(len, frequent.values())) >= 2700 and all(held[s].contains(k).all() for s, k in frequent.items())
    assert result(L.drop_lines(batch([1, 2], [0]), index)) == [(1, "", 1, 1), (2, "", 1, 1)]


def test_pieces_are_bounded(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = L.insert(L.empty_index(df, 2, 5, 40), df)
    flat = lambda d: sorted((r.doc, sorted(map(bytes, r["keys"]))) for r in d.collect())
    assert flat(L.dropped_keys(index, most_rows=7)) == flat(L.dropped_keys(index))
