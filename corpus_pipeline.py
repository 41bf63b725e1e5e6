"""From raw documents to token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir) that calls one operator of
``rackpulse.llm`` on all rows it is given; its result is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``:

1. toxicity: documents predicted toxic go;
2. line dedup: lines of 40 code points or more that 5 documents share stay in
   one of them (``n_chars`` follows the text);
3. SimHash near-dedup: one document of each group stays;
4. mixing: each document comes as often as the mix takes it;
5. BPE: each text is encoded and decoded; digests of both are returned.

Nulls, empty texts, repeated rows and empty tables pass as each operator's
docstring defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rackpulse.llm import bpe, common, line_dedup, mixing, simhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model, threshold=0.7)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All other columns stay as they are; a null ``n_chars`` stays null."""
    names = docs.columns
    columns = [f"c{i}" for i in range(len(names))]
    text = f"c{names.index('text')}"
    kept = line_dedup.dedup_lines(docs.toDF(*columns), min_docs=5, min_chars=40, doc_col=f"c{names.index('doc_id')}", text_col=text)
    kept = kept.select(*columns).toDF(*names)
    if "n_chars" not in names:
        return kept
    old = F.col(f"c{names.index('n_chars')}")
    length = F.length(F.coalesce(F.col(text), F.lit(""))).cast(docs.schema[names.index("n_chars")].dataType)
    return common.replaced(kept, n_chars=F.when(old.isNotNull(), length))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, most=2)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Training, rounding and tokenising have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def written(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written as Parquet and read again; names that differ in case only are no matter."""
    names = docs.columns
    return common.stage(docs.toDF(*[f"c{i}" for i in range(len(names))]), f"pipeline-{name}").toDF(*names)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
