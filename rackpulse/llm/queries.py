"""The registered queries of this subpackage and their DuckDB SQL.

Each ``opN_<name>`` takes (spark, sf_dir), runs its operator with production
parameters over its whole table and returns the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import license_scan, lm_scoring, merkle, mixing, oracles, prefix_trie, secret_scan, setsketch, toxicity
from .bpe import round_trip
from .exact_topk import exact_topk
from .line_dedup import dedup_lines
from .permutation_index import nearest
from .simhash import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(C.documents(spark, sf_dir))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(C.documents(spark, sf_dir))


@query
def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(C.table(spark, sf_dir, "embeddings"), 20, F.expr("id % 20 = 0"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(C.documents(spark, sf_dir), secret_scan.BASE + secret_scan.MORE)
    base = [r.kind for r in secret_scan.BASE]
    own = F.filter("spans", lambda s: s.kind.isin(base))
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return found.select(
        "doc_id", *map(number, base),
        F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """DuckDB: the spans of one kind, from the matches and the texts between them."""
    q = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, {order} AS ord, start, start + len AS stop FROM (
    SELECT doc_id, len, size, CAST(sum(gap + len) OVER (PARTITION BY doc_id ORDER BY n) - len AS BIGINT) AS start
    FROM (SELECT doc_id, unnest(range(len(m))) AS n, length(unnest(m)) AS len, length(unnest(g)) AS size,
                 length(unnest(string_split_regex(text, '{q}')[:len(m)])) AS gap
          FROM (SELECT doc_id, text, regexp_extract_all(text, '{q}') AS m, regexp_extract_all(text, '{q}', {group}) AS g
                FROM documents WHERE regexp_matches(text, '{q}'))))
  WHERE size >= {least}"""


def _folded(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


_SQL_RULES = [(r.kind, i, r.pattern.replace("(?i:(password|passwd|secret|token|api_?key))", "(" + "|".join(map(_folded, ("password", "passwd", "secret", "token", "api_?key"))) + ")"), r.group, r.least)
              for i, r in enumerate(secret_scan.BASE + secret_scan.MORE)]
ORACLES["op4_secret_scan"] = f"""
WITH found AS ({' UNION ALL '.join(_sql_spans(*r) for r in _SQL_RULES)}
), listed AS (
  SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)},
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 3), '') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM found GROUP BY doc_id
)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(C.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.documents(spark, sf_dir), words=3, max_bits=2)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(C.documents(spark, sf_dir), min_docs=5, min_chars=40)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: Lines with their keys: kept lines are those whose key is short, rare or in
#: the largest doc_id that holds it.
KEPT_LINES = """
lines AS (
  SELECT doc_id, text, generate_subscripts(parts, 1) AS n, unnest(parts) AS line
  FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM {docs})
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), kept_lines AS (
  SELECT doc_id, count(*) AS n_lines, count(f.k) FILTER (doc_id < last) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (f.k IS NULL OR doc_id = last), '') AS kept
  FROM keyed LEFT JOIN frequent f USING (k) GROUP BY doc_id
)"""
ORACLES["op7_line_dedup"] = f"""
WITH {KEPT_LINES.format(docs="documents")}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM kept_lines
"""


@query
def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(C.table(spark, sf_dir, "embeddings"), 10, F.expr("id % 100 = 0"))


ORACLES["op8_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id, max(list_dot_product(q.e, v.e))::BIGINT AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e)
  WHERE q.vec_id % 100 = 0
  GROUP BY 1, 2
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = mixing.copies(mixing.sized(C.documents(spark, sf_dir)), weights=(5, 2, 1), share=1.5, most=2)
    return dealt.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "rate",
                        (F.col("size") * F.col("copies")).alias("taken"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    model = toxicity.fit(docs, C.table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~toxicity.learned_from(F.col("doc_id")), F.lit(False)).alias("held_out")
    return toxicity.score(docs, model, 0.7).select("doc_id", held_out, "score", "predicted")


@query
def op11_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(C.documents(spark, sf_dir), words=5, share=85)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = lambda doc, text: F.when(F.crc32(doc.cast("string").cast("binary")) % 5 == 0, F.translate(text, _UPPER, _LOWER))
    return merkle.manifest(C.documents(spark, sf_dir), tampered={"text": fold})


ORACLES["op12_merkle_manifest"] = oracles.merkle_sql()


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turns(C.table(spark, sf_dir, "conversations"))
    borrow = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    convs, rows = prefix_trie.rebuilt(own, borrow, F.expr("conv - conv % 20"))
    return prefix_trie.prefix_trie(convs, rows, ["late", "pos"])


ORACLES["op13_prefix_trie"] = oracles.trie_sql()
