import hashlib

import public_tokenizers as P
import pytest
from test_line_dedup import brute as brute_lines
from test_simhash import brute as brute_components
from test_simhash import fingerprint
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from rackpulse.llm import common, toxicity

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage over whole documents."""
    docs, seen = common.documents(spark, DATA), []
    for name, stage in corpus_pipeline.STAGES:
        out = common.stage(stage(spark, docs, DATA), f"test-{name}")
        seen.append((name, docs, out))
        docs = out
    return {name: (a, b) for name, a, b in seen}


def test_stages_keep_the_columns_of_documents(spark, stages):
    want = common.documents(spark, DATA).dtypes
    assert [out.dtypes == want for _, out in stages.values()] == [True] * 4 + [False]


def test_toxicity_stage_drops_what_it_predicts(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, common.table(spark, DATA, "labels"))
    kept = {r.doc_id for r in toxicity.score(before, model).where("predicted = 0").collect()}
    assert {r.doc_id for r in after.collect()} == kept


def test_line_dedup_stage(stages):
    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in stages["line_dedup"])
    assert sorted(after) == sorted((d, t) for d, t, _, _ in brute_lines(before))
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"][1].collect())


def test_near_dedup_stage(stages):
    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in stages["simhash_near_dedup"])
    roots = brute_components([(d, fingerprint(t)) for d, t in before])
    assert sorted(after) == sorted((d, t) for (d, t), c in zip(before, roots, strict=True) if d == c)


def test_mixing_stage_nears_its_targets(stages):
    before, after = (df.collect() for df in stages["mixing"])
    texts = {r.doc_id: r for r in before}
    assert all(texts[r.doc_id] == r for r in after)
    copies = {}
    for r in after:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    size = lambda rows: sum(len(r.text.encode().split()) for r in rows)
    assert size(after) == pytest.approx(1.5 * size(before), rel=0.03)


def test_last_stage_is_the_library_s_encoding(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for r in before.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, after.collect())) == sorted(want)


def test_run_gives_the_last_stage_s_rows(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(tuple, stages["bpe"][1].collect()))


def test_entry_registers_everything():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert {"op4_secret_scan", "op7_line_dedup", "op8_exact_topk", "op12_merkle_manifest", "op13_prefix_trie"} <= __spark_entry__.oracle_sql().keys()


@pytest.mark.parametrize("name", ["op4_secret_scan", "op7_line_dedup", "op8_exact_topk", "op12_merkle_manifest", "op13_prefix_trie"])
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    own = __spark_entry__.queries()[name](spark, DATA)
    sql = con.sql(__spark_entry__.oracle_sql()[name])
    at = [sql.columns.index(c) for c in own.columns]
    assert sorted(map(tuple, own.collect())) == sorted(tuple(r[i] for i in at) for r in sql.fetchall())


def test_awkward_rows_pass_all_stages(spark):
    """Nulls in every column, repeated rows, names that clash; then no rows at all."""
    from helpers import AWKWARD
    from pyspark.sql import functions as F

    rows = [(d, t, [None, "en"][i % 2], [None, "s"][i % 3 > 0], [None, 7][i % 2], 9, "decoy") for i, (d, t) in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, Text string")
    for some in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.written(step(spark, some, DATA), name)
            assert out.columns == docs.columns, name
            again = out.toDF(*[f"c{i}" for i in range(len(docs.columns))])
            assert again.where("c5 <> 9 OR c6 <> 'decoy'").isEmpty(), name
            if name == "line_dedup":
                null = some.toDF(*again.columns).where("c4 IS NULL").count()
                assert again.where(F.col("c4").isNull()).count() == null
            some = out
        assert corpus_pipeline.STAGES[-1][1](spark, some, DATA).count() == some.count()
