import hashlib
import random
from collections import defaultdict

from helpers import fold, words
from pyspark.sql import functions as F

from rackpulse.llm import prefix_trie as X

SCHEMA = "conv_id long, turn long, role string, text string"


def symbol(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:30]


def trie(convs):
    """Nodes of {conv: [(role, text)]}, by counting all prefixes."""
    members, children = defaultdict(list), defaultdict(set)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
            if d:
                children[tuple(own[:d - 1])].add(tuple(own[:d]))
    out, leaves, saved = [], {}, {}
    for key in sorted(members, key=len, reverse=True):
        here = (len(members[key]) - 1) * (len(words(key[-1][1])) if key else 0)
        leaves[key] = sum(leaves[k] for k in children[key]) or 1
        saved[key] = here + sum(saved[k] for k in children[key])
        ends = ",".join(map(str, sorted(c for c in members[key] if len(convs[c]) == len(key))))
        out.append((min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(children[key]),
                    leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, symbol(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = fold(c, 4)
        made[c] = own.get(c - c % 20, [])[:h] + v[h:]
    return trie(made)


def operator(df):
    own = X.turns(df)
    convs, rows = X.rebuilt(own, F.crc32(F.col("conv").cast("string").cast("binary")) % 4, F.expr("conv - conv % 20"))
    return sorted((tuple(r) for r in X.prefix_trie(convs, rows, ["late", "pos"]).collect()), key=str)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40, 3) for b in range(a + 1, 70, 5)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", X.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_against_brute_force(spark, monkeypatch):
    """Few different turns, so paths share, part, end inside edges and repeat; segments of 4 depths."""
    monkeypatch.setattr(X, "SEG", 4)
    rng = random.Random(3)
    rows = []
    stems = [[rng.choice("ab") + " w" * rng.randrange(4) for _ in range(rng.randrange(30))] for _ in range(12)]
    for c in range(160):
        own = rng.choice(stems)[:rng.randrange(30)] + [rng.choice("abc") for _ in range(rng.choice([0, 0, 1, 5]))]
        rows += [(c, i, "user" if i % 2 else None, t) for i, t in enumerate(own)]
    rows += [(1000 + c, i, "user", f"the same {i}") for c in range(60) for i in range(5)]  # copies
    rows += [(2000, None, None, None), (2000, None, "user", "x"), (2000, 1, "user", "x"), (2000, 1, "user", "x"), (2000, 1, "user", "")]
    rows += [(None, 1, "user", "no conversation"), (2003, 5, "system", "w " * 2000), (2005, 1, "", "ÄÖ \U0001F600\x0bb")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit("decoy").alias("Text"), F.lit(1).alias("conv"), F.lit(2).alias("depth"))
    assert operator(df.repartition(6)) == sorted(brute(rows), key=str)


def test_a_long_conversation_is_hashed_in_pieces(spark):
    """Two conversations that hold nearly all rows and part late."""
    rows = [(c, i, "user", f"turn {i}" if i < 1500 else f"turn {i} of {c}") for c in (20, 40) for i in range(1600)]
    rows += [(60, i, "user", f"turn {i}") for i in range(700)] + [(61, 0, "user", "short")]
    assert operator(spark.createDataFrame(rows, SCHEMA).repartition(4)) == sorted(brute(rows), key=str)


def test_tiny_tables(spark):
    assert operator(spark.createDataFrame([], SCHEMA)) == []
    one = [(7, 0, "user", "hello there")]  # its first turns are borrowed from a conversation that is not there
    assert operator(spark.createDataFrame(one, SCHEMA)) == brute(one)


def test_many_ends_are_streamed(spark):
    ids = [(b"x" * 16, c) for c in range(0, 5000, 3)] + [(b"y" * 16, -5), (b"y" * 16, 4)]
    got = {bytes(r.node)[:1]: r.ends for r in X.ends_digest(spark.createDataFrame(ids, "node binary, conv long").repartition(7)).collect()}
    assert got == {b"x": hashlib.sha256(",".join(str(c) for c in range(0, 5000, 3)).encode()).hexdigest(), b"y": hashlib.sha256(b"-5,4").hexdigest()}
