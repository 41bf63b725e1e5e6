import hashlib
from collections import defaultdict

from helpers import AWKWARD, fold, lower_az
from pyspark.sql import functions as F

from rackpulse.llm import merkle as M
from rackpulse.llm.queries import _LOWER, _UPPER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(levels[-1][i: i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 16 * 16
        run = nodes[first: first + 16]
        out.append((run[:i - first], run[i - first + 1:]))
        i //= 16
    return out


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = [tree([leaf(r, r[1]) for r in groups[s]]) for s in sources]
    over = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            ways = way(trees[k], i) + way(over, k)
            text = r[1]
            if text is not None and r[0] is not None and fold(r[0], 5) == 0:
                text = lower_az(text)
            node = leaf(r, text)
            for b, a in ways:
                node = sha([*b, node, *a])
            root = over[-1][0]
            out.append((r[0], trees[k][0][i], trees[k][-1][0], root, sha(d for b, a in ways for d in b + a), node, node == root))
    return sorted(out, key=str)


def manifest(df, **kw):
    change = lambda doc, text: F.when(F.crc32(doc.cast("string").cast("binary")) % 5 == 0, F.translate(text, _UPPER, _LOWER))
    return M.manifest(df, tampered={"text": change}, **kw)


def rows(n_hot=700):
    sources = [None, "", "a", "é", "z", "Z"]
    out = [(d, t, [None, "en"][i % 2], sources[i % 6], [None, len(t or "")][i % 3 > 0]) for i, (d, t) in enumerate(AWKWARD)]
    out += [(100 + i, f"Text {i % 50} of the HOT source", "en", "hot", i) for i in range(n_hot)]
    out += [(5000 + i, "X", None, f"s{i}", 1) for i in range(40)]
    return out + [(7, "Same Row", "en", "a", 8)] * 20


def test_against_brute_force(spark):
    own = rows()
    df = spark.createDataFrame(own, SCHEMA).select("*", F.lit("decoy").alias("Text"), F.lit(1).alias("tree"), F.lit(None).alias("digest"))
    got = [tuple(r) for r in manifest(df.repartition(5)).collect()]
    assert sorted(got, key=str) == brute(own)
    assert {v for *_, v in got} == {True, False}


def test_small_and_empty_tables(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(5, "Only One", "en", None, 8)]
    assert [tuple(r) for r in manifest(spark.createDataFrame(one, SCHEMA)).collect()] == brute(one)
    two = [(5, "A", "en", "x", 1), (0, "B", "en", "y", 1)]
    assert sorted((tuple(r) for r in manifest(spark.createDataFrame(two, SCHEMA)).collect()), key=str) == brute(two)


def test_delivered_proofs_fold_to_the_root(spark):
    got = manifest(spark.createDataFrame(rows(300), SCHEMA), proofs=True).collect()
    assert {r.root for r in got} == {got[0].root}
    for r in got:
        assert M.folded(r.leaf, r.before, r.after) == r.root
        assert M.digest(*[x for pair in zip(r.before, r.after, strict=True) for x in pair]) == r.proof_sha256
