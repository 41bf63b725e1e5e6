"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text, one on ordinary and
one on toxic documents. A text is cut into windows of a few words; each window
is compressed with either dictionary, and what the toxic one saves beyond the
ordinary one (over all windows, for its length, in the best ones, and how many save
``STRONG`` bytes) goes through calibrated logistic weights into a score.

Both dictionaries are made by zstandard's trainer and used as raw content:

* the ordinary one is trained on the words of the ordinary documents, each as often
  as documents hold it, in ``settled`` documents or more (on all, if none is);
* the toxic one is trained on words of the toxic documents, each as often as it
  stands there, and put amid the ordinary one, so that the two differ in the toxic
  part alone. Toxic documents are mostly ordinary words, and a dictionary of all of
  these tells nothing; it learns the words whose beginning sets the toxic documents
  apart: its rate is ``ratio`` times the ordinary one or more, by a likelihood ratio
  of ``least`` or more. No share of the sample is asked for, so the words of a small
  language count. A beginning counts once for each word it follows (where it first
  stands in a document), so copies of one document count once;
* where there are too few samples for the trainer, they are the content themselves.

Samples come in the order of a hash, as the trainer takes a part from each stretch.
Each window follows a fixed lead-in out of the common part, so that even a
short window is compressed and the difference shows the match alone.

The fit reads a bounded, documented sample: at most ``sample`` labelled
documents of each class (one text an id, different texts, in the order of a hash of
their id), ``candidates`` beginnings and the ``vocabulary`` commonest words of each class,
as up to ``TRAINED`` samples. Scoring reads whole texts.

Defined results:

* a null or empty text is one empty window, and is scored like any other;
* labels with a null doc_id or a null mark are not learned from; a document
  with several labels is learned under each, one with several texts by the least of
  them; without both classes to learn from, or a word that sets them apart, every
  score is 0;
* rows are scored one by one: repeated rows and ids get equal scores, a null
  doc_id is carried through; an empty table gives no rows; extra columns, of
  whatever name, are ignored (``reject`` passes them through).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from .common import pick, slices, stage, text_bytes

TRAINED = 500_000  # samples a dictionary is trained on, at most
STEP = 6  # the trainer's d: bytes of what it counts
SHORTEST, LONGEST = 4, 14  # bytes of a piece, the space before the word included
STRONG = 3  # bytes saved by a window that counts by itself
NEAR = 1000  # bytes of the common part that stand after the pieces, so that these are near too
#: A window log of 14 at most keeps hash chains, which hold every position of a dictionary.
SMALL_TABLES = {"window_log": 14, "hash_log": 15, "chain_log": 15, "search_log": 6, "min_match": 5, "target_length": 32}


@dataclass(frozen=True)
class Model:
    """Dictionary contents (ordinary, and what the toxic one has beside it), window length
    and the weights of ``_features``."""

    common: bytes
    pieces: bytes
    words: int
    lead: int
    weights: tuple[float, ...] | None

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(evidence))
        return 1.0 / (1.0 + np.exp(-np.clip(_features(evidence) @ np.array(self.weights), -500, 500)))


def _features(evidence: np.ndarray) -> np.ndarray:
    total, best, words, four, strong = evidence.T
    return np.c_[np.ones(len(evidence)), np.log1p(total), np.minimum(best, 8) / 8, np.log(words), np.log1p(100 * total / words),
                 np.log1p(strong), np.minimum(four, 20) / 8]


@lru_cache(maxsize=4)
def compressors(common: bytes, pieces: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    """(ordinary, toxic), once a worker process."""

    def made(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False, **SMALL_TABLES)
        held = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)

    return made(common), made(common[:-NEAR] + pieces + common[-NEAR:])


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def evidence(model: Model, text: bytes) -> tuple[int, int, int, int, int]:
    """(bytes the toxic dictionary saves over all windows, in its best window, words,
    bytes saved in the best four, windows that save ``STRONG`` bytes)."""
    ordinary, toxic = (c.compress for c in compressors(model.common, model.pieces))
    lead, n = model.common[len(model.common) - min(model.lead, len(model.common)):], model.words
    words, total, strong, best = words_of(text), 0, 0, [0] * 4
    for i in range(0, max(1, len(words)), n):
        window = lead + b" " + b" ".join(words[i: i + n]) + b" "
        saved = len(ordinary(window)) - len(toxic(window))
        if saved > 0:
            total += saved
            strong += saved >= STRONG
            if saved > best[0]:
                best = sorted([saved, *best[1:]])
    return total, best[-1], max(1, len(words)), sum(best), strong


def pieces_of(text: bytes) -> dict[bytes, bytes]:
    """Beginnings of the words of a text, whole short words with the space after
    them, each with the word before the first place it stands at."""
    out, before = {}, b""
    for word in words_of(text):
        for n in range(SHORTEST, min(len(word) + 2, LONGEST) + 1):
            out.setdefault((b" " + word + b" ")[:n], before)
        before = word
    return out


def _listed(sample: DataFrame, parts) -> DataFrame:
    """(part, toxic, before): the parts of each document of (toxic, text), a hash of the word before."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 2 << 20):
                made = [parts(t) for t in text_bytes(piece.column(1))]
                marks = np.repeat(np.asarray(piece.column(0)), [len(m) for m in made])
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([p for m in made for p in m], pa.binary()), "toxic": pa.array(marks, pa.int32()),
                    "before": pa.array([xxhash.xxh3_64_intdigest(w) >> 1 for m in made for w in m.values()], pa.int64())})

    return sample.mapInArrow(split, "part binary, toxic int, before long")


def apart(rows: DataFrame, n_toxic: int, n_ordinary: int, ratio: float, least: float, candidates: int) -> list[bytes]:
    """Beginnings of words that set the toxic documents of (toxic, text) apart, the surest first;
    of those that begin alike the surest, then the longest, stands for all."""
    toxic, places = F.col("toxic") == 1, _listed(rows, pieces_of).groupBy("part", "toxic", "before").agg(F.count("*").alias("n"))
    a, b = F.col("a"), F.col("b")
    counted = places.groupBy("part").agg(F.count(F.when(toxic, 1)).alias("a"), F.sum(F.when(toxic, 0).otherwise(F.col("n"))).alias("b"))

    def fitting(k: Column, n: float, rate: Column) -> Column:
        return F.when(k > 0, k * F.log(rate)).otherwise(0.0) + F.when(k < n, (n - k) * F.log1p(-rate)).otherwise(0.0)

    both, n, m = (a + b) / (n_toxic + n_ordinary), n_toxic, n_ordinary
    sure = 2 * (fitting(a, n, a / n) + fitting(b, m, b / m) - fitting(a, n, both) - fitting(b, m, both))
    found = (counted.where((a >= 3) & (a * m >= ratio * b * n)).withColumn("sure", F.round(sure, 6)).where(F.col("sure") >= least)
             .orderBy(F.desc("sure"), F.desc(F.length("part")), "part").limit(candidates))
    chosen = []
    for part in (bytes(r.part) for r in found.collect()):
        if not any(part.startswith(c) or c.startswith(part) for c in chosen):
            chosen.append(part)
    return chosen


def _words(rows: DataFrame, beginnings: list[bytes] | None, most: int) -> list[tuple[bytes, int]]:
    """The ``most`` commonest words, between spaces, of (toxic, text): with the documents that
    hold them, or with their places where only words of these beginnings count."""
    held = None if beginnings is None else frozenset(beginnings)

    def counted(text: bytes) -> Counter:
        words = (b" " + w + b" " for w in words_of(text) if len(w) <= 64)
        if held is None:
            return Counter(set(words))
        return Counter(w for w in words if any(w[:n] in held for n in range(SHORTEST, min(len(w), LONGEST) + 1)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 2 << 20):
                made = [counted(t) for t in text_bytes(piece.column(1))]
                yield pa.RecordBatch.from_pydict({"word": pa.array([w for m in made for w in m], pa.binary()),
                                                  "n": pa.array([n for m in made for n in m.values()], pa.int64())})

    found = rows.select("toxic", "text").mapInArrow(split, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [(bytes(r.word), r.n) for r in found.orderBy(F.desc("n"), "word").limit(most).collect()]


def trained(words: list[tuple[bytes, int]], size: int, segment: int) -> bytes:
    """A dictionary of ``size`` bytes at most by zstandard's trainer, from each word as often
    as told (evenly fewer beyond ``TRAINED`` in all); the words themselves where they are too few."""
    share = min(1.0, TRAINED / max(1, sum(n for _, n in words)))
    samples = sorted((xxhash.xxh64_intdigest(w, seed=i), w) for w, n in words for i in range(max(1, int(n * share))))
    try:
        return zstandard.train_dictionary(size, [w for _, w in samples], k=segment, d=STEP).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(w for w, _ in reversed(words))[-size:]


def _calibrated(evidence: np.ndarray, toxic: np.ndarray, caution: float) -> tuple[float, ...]:
    """Ridge logistic weights by Newton steps; the ordinary class weighs ``caution`` times the toxic one."""
    x = _features(evidence)
    weights = np.zeros(x.shape[1])
    each = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 * caution / max(1, (toxic == 0).sum())) * len(toxic)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -500, 500)))
        gradient = x.T @ (each * (p - toxic)) + 0.01 * weights
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(weights)), gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-10:
            break
    return tuple(float(w) for w in weights)


def _measured(model: Model, texts: pa.Array) -> np.ndarray:
    return np.array([evidence(model, t) for t in text_bytes(texts)], np.float64).reshape(-1, 5)


def _evidence_rows(docs: DataFrame, model: Model, keep: str, kind: str) -> DataFrame:
    """(keep, total, best, words, four, strong, score) of documents (keep, text)."""
    names = ["total", "best", "words", "four", "strong"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _measured(model, batch.column(1))
            yield pa.RecordBatch.from_pydict({keep: batch.column(0), **{n: pa.array(made[:, i]) for i, n in enumerate(names)},
                                              "score": pa.array(model.scores(made))})

    return docs.mapInArrow(scan, f"{keep} {kind}, {', '.join(n + ' double' for n in names)}, score double")


def learned_from(doc: Column) -> Column:
    """Ids whose labels may be learned from: crc32 of the id as text leaves not 1 by 3."""
    return F.crc32(doc.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, candidates: int = 2000, vocabulary: int = 20000, words: int = 3,
        lead: int = 64, ordinary_bytes: int = 45000, toxic_bytes: int = 3000, settled: int = 9, ratio: float = 4.0, least: float = 20.0, caution: float = 3.0, doc_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train dictionaries and weights on the labelled documents that may be learned from."""
    marks = pick(labels, id="doc_id", toxic="toxic").where(learned_from(F.col("id")))
    marks = marks.select(F.col("id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").distinct()
    chosen = marks.where("toxic = 0").orderBy(F.xxhash64("id"), "id").limit(sample).unionByName(
        marks.where("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(sample))
    own = pick(docs, doc=doc_col, text=text_col).select(F.col("doc").cast("long").alias("doc"), "text")
    texts = own.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "toxic", F.coalesce("text", F.lit("")).alias("text"))  # at most 2 * sample short rows
    rows = stage(texts.groupBy("id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text").distinct(), "toxicity-sample")
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    common = _words(rows.where("toxic = 0"), None, vocabulary)
    often = [x for x in common if x[1] >= settled] or common
    content = trained(often, ordinary_bytes, 16)
    found = apart(rows, sizes[1], sizes[0], ratio, least, candidates) if sizes.get(0) and sizes.get(1) else []
    if not found:
        return Model(content, b"", words, lead, None)
    telling = _words(rows.where("toxic = 1"), found, vocabulary)
    model = Model(content, trained(telling, toxic_bytes, 24), words, lead, None)
    shown = _evidence_rows(rows, model, "toxic", "int").drop("score").collect()
    table = np.array([tuple(r) for r in shown], np.float64)
    return Model(model.common, model.pieces, words, lead, _calibrated(table[:, 1:], table[:, 0], caution))


def score(docs: DataFrame, model: Model, threshold: float = 0.7, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, total, best, score, predicted), one row per row of ``docs``."""
    own = pick(docs, doc=doc_col, text=text_col).select(F.col("doc").cast("long").alias("doc_id"), "text")
    return _evidence_rows(own, model, "doc_id", "long").select(
        "doc_id", "total", "best", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    names = docs.columns
    at = names.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(_measured(model, batch.column(at))) < threshold))

    return plain.mapInArrow(clean, S.StructType([S.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)])).toDF(*names)
