import random

from helpers import awkward, fold

from rackpulse.llm import toxicity as X

BAD = ["grumblefool", "stinkwort", "vilecreep"]


def corpus(spark, n=700, seed=3):
    rng = random.Random(seed)
    part = ["ta", "lo", "mi", "re", "su", "na", "ko", "pe", "di", "vu"]
    vocabulary = ["".join(rng.choice(part) for _ in range(rng.randrange(1, 5))) for _ in range(400)]
    rows, marks = [], []
    for i in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(10, 120))]
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randrange(1, 5) * toxic):
            own.insert(rng.randrange(len(own)), rng.choice(BAD) + rng.choice(["", ".", ","]))
        rows.append((i, " ".join(own)))
        marks.append((i, toxic))
    return rows, marks, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int").selectExpr("*", "1 as id", "'a' as Toxic")


def test_held_out_accuracy(spark):
    rows, marks, docs, labels = corpus(spark)
    model = X.fit(docs, labels)
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    held = [(d, t) for d, t in marks if fold(d, 3) == 1]
    hit = [got[d].predicted for d, t in held if t]
    false = [got[d].predicted for d, t in held if not t]
    assert sum(hit) / len(hit) >= 0.9 and sum(false) / len(false) <= 0.02
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    kept = {r.doc_id for r in X.reject(docs.selectExpr("*", "1 as total"), model).collect()}
    assert kept == {d for d, r in got.items() if not r.predicted}


def test_labels_of_the_held_out_third_are_not_learned(spark):
    rows, marks, docs, labels = corpus(spark, 300)
    flipped = spark.createDataFrame([(d, 1 - t if fold(d, 3) == 1 else t) for d, t in marks], "doc_id long, toxic int")
    assert X.fit(docs, labels) == X.fit(docs, flipped)


def test_awkward_rows(spark):
    _, marks, docs, _ = corpus(spark, 300)
    more = spark.createDataFrame([*marks, (None, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    model = X.fit(docs, more)
    got = X.score(awkward(spark), model).collect()
    assert len(got) == awkward(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 6}) == 1
    assert X.score(docs.limit(0), model).count() == 0 and X.reject(docs.limit(0), model).count() == 0


def test_one_class_or_nothing_to_learn_from(spark):
    _, _, docs, labels = corpus(spark, 60)
    for some in (labels.limit(0), spark.createDataFrame([(i, 0) for i in range(60)], "doc_id long, toxic int")):
        model = X.fit(docs, some)
        assert {(r.score, r.predicted) for r in X.score(docs, model).collect()} == {(0.0, 0)}


def test_apart_ignores_copies_and_ordinary_pieces(spark):
    fillers = [f"filler{i}" for i in range(40)]
    toxic = [f"{fillers[i]} grumble{'xyz'[i % 3]} the" for i in range(30)] + [f"copied chance{'!' * i}" for i in range(20)]
    ordinary = [f"{fillers[i % 40]} the {i}" for i in range(200)]
    rows = spark.createDataFrame([(1, t) for t in toxic] + [(0, t) for t in ordinary], "toxic int, text string")
    got = X.apart(rows, len(toxic), len(ordinary), 4.0, 20.0, 100)
    assert got[0] == b" grumble" and not any(p.startswith((b" chan", b" the")) for p in got)


def test_a_small_language_counts(spark):
    """Twenty toxic documents of 700 whose word beginning a few ordinary ones share."""
    rng = random.Random(5)
    ordinary = [" ".join(f"w{rng.randrange(300)}" for _ in range(40)) for _ in range(1500)]
    toxic = [f"{rng.choice(ordinary)} {rng.choice(BAD)} {rng.choice(BAD)}" for _ in range(280)]
    for i in range(20):
        own = rng.choice(ordinary).split()
        toxic.append(" ".join(x for w in own[:8] for x in (w, f"bomente{rng.choice('abcdefgh')}r")))
    ordinary = [t + (" bomentezz" if i % 150 == 0 else "") for i, t in enumerate(ordinary)]
    rows = spark.createDataFrame([(1, t) for t in toxic] + [(0, t) for t in ordinary], "toxic int, text string")
    assert any(p.startswith(b" bomente") for p in X.apart(rows, 300, 1500, 4.0, 20.0, 100))


def test_evidence_by_brute_force(spark):
    """Window by window with zstandard itself."""
    _, _, docs, labels = corpus(spark, 400)
    model = X.fit(docs, labels)
    ordinary, toxic = X.compressors(model.common, model.pieces)
    for text in (b"", b"one", b"a grumblefool b c d stinkwort. e f vilecreep vilecreep g", b"Grumblefool " * 50):
        words, saved = text.lower().split(), []
        for i in range(0, max(1, len(words)), 3):
            window = model.common[-64:] + b" " + b" ".join(words[i:i + 3]) + b" "
            saved.append(max(0, len(ordinary.compress(window)) - len(toxic.compress(window))))
        want = (sum(saved), max(saved), max(1, len(words)), sum(sorted(saved)[-4:]), sum(s >= X.STRONG for s in saved))
        assert X.evidence(model, text) == want


def test_an_id_with_several_texts_is_learned_once(spark):
    rows, marks, docs, labels = corpus(spark, 300)
    more = docs.unionByName(docs.selectExpr("doc_id", "concat('zz ', text) as text"))
    assert X.fit(more, labels) == X.fit(docs.selectExpr("doc_id", "least(text, concat('zz ', text)) as text"), labels)


def test_dictionaries_come_from_the_trainer():
    """The content is zstandard's own for the samples in hash order; few samples are the content; reruns agree."""
    words = [(f" word{i}stem{i % 7} ".encode(), 1 + i % 9) for i in range(400)]
    samples = sorted((X.xxhash.xxh64_intdigest(w, seed=i), w) for w, n in words for i in range(n))
    want = X.zstandard.train_dictionary(2000, [w for _, w in samples], k=16, d=X.STEP).as_bytes()
    assert X.trained(words, 2000, 16) == want == X.trained(list(reversed(words)), 2000, 16) and len(want) <= 2000
    assert X.trained([(b" one ", 3), (b" two ", 1)], 2000, 16) == b" two  one " and X.trained([], 2000, 16) == b""


def test_a_very_common_word_is_trained_on_evenly_fewer():
    many = [(b" often ", 10 ** 9), *[(f" rare{i} ".encode(), 40) for i in range(50)]]
    assert len(X.trained(many, 1000, 16)) <= 1000
