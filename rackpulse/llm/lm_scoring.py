"""LM scoring: a bigram model smoothed by deleted interpolation.

P(w | h) = a * c(hw)/c(h) + b * c(w)/N + d / (V + 1)

mixes the maximum-likelihood estimates of the bigram, the unigram and one
unknown word beside the V known ones. The weights (a, b, d) belong to the bucket of
the context's frequency (powers of two) and are learned by expectation
maximisation on held-out counts: a tenth of the training documents is left out
of the counts while the weights that predict it best are found. The scoring
counts then come from all training documents.

How the counts travel:

1. Documents are tokenised once into *chunks* (about ``chunk_bytes`` of text, a
   written table): a chunk's different words as hashes, its text as positions
   in that list.
2. Each chunk asks once for each different word and bigram it holds, adding
   its own counts: packed runs of sorted 64-bit keys, dealt to ranges of the
   key space. So however common an n-gram, a range hears of it once a chunk.
3. A range sums the counts of its keys and answers every chunk in the same order.
4. Chunks meet their answers: held-out chunks give the table EM runs on, all
   chunks give their documents' scores.

The ranges grow with the number of tokens, so every step's pieces stay bounded.

Tokens: A-Z lower-cased, split at white space, one end token per text.

Defined results:

* a null or empty text is its end token alone; a text of any length is scored whole;
* a null doc_id counts as held out: such rows are scored, not learned from;
* rows are scored one by one; repeated rows are learned from as often as they come;
* without training documents every token has probability 1 / (V + 1) = 1;
* an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, slices, stage, task_number

CHUNK = "chunk long, part int, docs binary, missing binary, folds binary, ends binary, tokens binary, words binary"
ASK = "bucket int, chunk long, part int, n int, grams int, keys binary, counts binary"
ANSWER = "chunk long, bucket int, grams int, main binary, held binary, types long, main_types long"
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
BUCKETS = 64


def squeezed(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, compressed."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def released(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Chunks (schema ``CHUNK``) of documents (doc long, fold int, text); part 1 holds fold 1, the held-out tenth."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            for piece in slices(batch, "text", chunk_bytes):
                in_part = pc.equal(piece.column(1), 1)
                for part, own in ((0, piece.filter(pc.invert(in_part))), (1, piece.filter(in_part))):
                    if own.num_rows:
                        made += 1
                        yield pa.RecordBatch.from_pydict(_chunk(own, task_number() << 32 | made, part))

    return docs.mapInArrow(cut, CHUNK)


def _chunk(own: pa.RecordBatch, number: int, part: int) -> dict:
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(own.column(2), "")))
    flat, ends = split.flatten(), np.asarray(split.offsets, np.int64)
    filled = np.asarray(pc.binary_length(flat)) > 0
    sizes = np.diff(np.r_[0, np.cumsum(filled)][ends - ends[0]])
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    words = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()]
    ends = np.cumsum(sizes + 1)
    tokens = np.full(int(ends[-1]), len(words), np.uint32)
    tokens[np.delete(np.arange(len(tokens)), ends - 1)] = np.asarray(coded.indices, np.uint32)
    return {"chunk": pa.array([number], pa.int64()), "part": pa.array([part], pa.int32()),
            "docs": [np.asarray(pc.fill_null(own.column(0), 0), np.int64).tobytes()],
            "missing": [np.asarray(pc.is_null(own.column(0)), bool).tobytes()],
            "folds": [np.asarray(own.column(1), np.int8).tobytes()], "ends": [ends.astype(np.int64).tobytes()],
            "tokens": [squeezed(tokens)], "words": [np.r_[np.array(words, np.uint64), END].tobytes()]}


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of 64-bit keys (a product-and-shift mix)."""
    x = left * np.uint64(0xBF58476D1CE4E5B9) + (right ^ (right >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Grams:
    """The n-grams of a chunk: for n = 1 and 2 the different keys in order
    (``keys[n]``) and each token's place among them (``at[n]``)."""

    def __init__(self, row) -> None:
        self.ends, self.folds = np.frombuffer(row.ends, np.int64), np.frombuffer(row.folds, np.int8)
        words, tokens = np.frombuffer(row.words, np.uint64), released(row.tokens, np.uint32)
        order = np.argsort(words)
        self.begins = np.r_[0, self.ends[:-1]]
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        word = place[tokens]
        pair = np.r_[0, word[:-1]] * np.int64(len(words)) + word
        pair[self.begins] = len(words) * np.int64(len(words)) + word[self.begins]
        own, inverse = np.unique(pair, return_inverse=True)
        context = np.r_[words[order], START][own // len(words)]
        keys = _mixed(context, words[order][own % len(words)])
        by = np.argsort(keys)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.keys = {1: words[order], 2: keys[by]}
        self.at = {1: word, 2: rank[inverse]}

    def counts(self, grams: int, tokens: np.ndarray) -> np.ndarray:
        return np.bincount(self.at[grams][tokens], minlength=len(self.keys[grams])).astype(np.uint32)

    def of_fold(self, keep: np.ndarray) -> np.ndarray:
        """Which tokens lie in documents of the folds marked."""
        return np.repeat(keep[self.folds], np.diff(self.ends, prepend=0))


def _ranges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of the key space begins in sorted keys (and the last ends)."""
    edges = [-(-(i << 64) // buckets) for i in range(1, buckets)]
    return np.r_[0, np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)]


def asked(table: DataFrame, buckets: int) -> DataFrame:
    """What chunks ask for and add (schema ``ASK``)."""
    learned = np.arange(10) != 0

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                own, out = Grams(row), []
                tokens = own.of_fold(learned)
                for grams in (1, 2):
                    keys, counts = own.keys[grams], own.counts(grams, tokens)
                    cut = _ranges(keys, buckets)
                    for i in np.nonzero(np.diff(cut))[0]:
                        a, b = cut[i], cut[i + 1]
                        out.append((i, row.chunk, row.part, b - a, grams, squeezed(np.diff(keys[a:b], prepend=np.uint64(0))), squeezed(counts[a:b])))
                yield pd.DataFrame(out, columns=ASK.replace(" int", "").replace(" long", "").replace(" binary", "").split(", "))

    return table.select("chunk", "part", "folds", "ends", "tokens", "words").mapInPandas(ask, ASK)


def answered(asks: DataFrame) -> DataFrame:
    """Counts of all keys asked for (schema ``ANSWER``): those of the main folds
    and of the held-out one. A row with chunk -1 has a range's number of different words."""

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for grams, own in rows.groupby("grams"):
            own = list(own.itertuples(index=False))
            keys = np.concatenate([np.cumsum(released(r.keys, np.uint64)) for r in own])
            counts = np.concatenate([released(r.counts, np.uint32) for r in own]).astype(np.float64)
            part = np.repeat([r.part for r in own], [r.n for r in own])
            _, at = np.unique(keys, return_inverse=True)
            main, held = (np.bincount(at, np.where(part == p, counts, 0)).astype(np.uint64) for p in (0, 1))
            if grams == 1:
                out.append((-1, key[0], 0, b"", b"", int(((main + held) > 0).sum()), int((main > 0).sum())))
            start = 0
            for r in own:
                mine = at[start: start + r.n]
                out.append((r.chunk, key[0], grams, squeezed(main[mine]), squeezed(held[mine]), 0, 0))
                start += r.n
        return pd.DataFrame(out, columns=["chunk", "bucket", "grams", "main", "held", "types", "main_types"])

    return asks.groupBy("bucket").applyInPandas(answer, ANSWER)


def _told(grams: Grams, answers: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per n the (main, held) counts of the chunk's keys."""
    out = {}
    for n in (1, 2):
        own = answers[answers.grams == n].sort_values("bucket")
        out[n] = tuple(np.concatenate([released(x, np.uint64) for x in own[c]]) for c in ("main", "held"))
        assert len(out[n][0]) == len(grams.keys[n])
    return out


def _context(grams: Grams, unigrams: np.ndarray) -> np.ndarray:
    """Each token's context count: its predecessor's, and at the beginning the
    number of texts, which is the count of the end token."""
    count = unigrams[grams.at[1]]
    context = np.r_[0, count[:-1]]
    context[grams.begins] = count[grams.ends - 1]
    return context


def frequency_bucket(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the power of two reached."""
    return np.frexp(context.astype(np.float64))[1].astype(np.int64)


def held_out_table(table: DataFrame, answers: DataFrame) -> DataFrame:
    """(bucket, pair, context, word, n): how often held-out tokens had these main counts."""

    def gather(key: tuple, own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples(index=False):
            grams = Grams(row)
            counts = _told(grams, told)
            context = _context(grams, counts[1][0])
            cells = np.stack([counts[2][0][grams.at[2]].astype(np.int64), context.astype(np.int64), counts[1][0][grams.at[1]].astype(np.int64)])
            cells[1][cells[0] == 0] = np.where(context[cells[0] == 0] > 0, 1 << (frequency_bucket(context[cells[0] == 0]) - 1).clip(0), 0)
            order = np.lexsort(cells)  # an unseen pair needs only its context's bucket
            cells = cells[:, order]
            first = np.r_[True, (np.diff(cells, axis=1) != 0).any(0)]
            out.append(np.r_[cells[:, first], [np.diff(np.r_[np.nonzero(first)[0], cells.shape[1]])]])
        made = np.concatenate(out, axis=1) if out else np.empty((4, 0), np.int64)
        return pd.DataFrame({"bucket": frequency_bucket(made[1]), "pair": made[0], "context": made[1], "word": made[2], "n": made[3]})

    held = table.where("part = 1").select("chunk", "folds", "ends", "tokens", "words")
    told = answers.where("chunk >= 0").select(F.col("chunk").alias("of"), "bucket", "grams", "main", "held")
    told = told.join(held.select(F.col("chunk").alias("mine")).distinct(), F.col("of") == F.col("mine"), "left_semi")
    rows = held.groupBy("chunk").cogroup(told.groupBy("of")).applyInPandas(gather, "bucket long, pair long, context long, word long, n long")
    return rows.groupBy("bucket", "pair", "context", "word").agg(F.sum("n").alias("n"))


def learned_weights(held: DataFrame, n_main: int, types: int, rounds: int = 15) -> np.ndarray:
    """Mixture weights (bucket, 3) by expectation maximisation; each round is one
    aggregate over the held-out table. The weights of all buckets together
    (``BUCKETS`` rows) act as ``prior`` tokens, so that sparse buckets are sane too."""
    weights, prior = np.full((BUCKETS, 3), 1 / 3), 10.0
    weights[0] = (0.0, 0.5, 0.5)
    pair = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    word = F.col("word") / F.lit(float(max(1, n_main)))
    unknown = F.lit(1.0 / (types + 1))
    for _ in range(rounds):
        own = [F.expr(f"element_at(array({', '.join(f'{float(w)!r}D' for w in weights[:, i])}), int(bucket) + 1)") * p for i, p in enumerate((pair, word, unknown))]
        rows = held.groupBy("bucket").agg(*[F.sum(F.col("n") * x / (own[0] + own[1] + own[2])).alias(f"m{i}") for i, x in enumerate(own)]).collect()
        mass = np.zeros((BUCKETS, 3))
        for r in rows:
            mass[r.bucket] = (r.m0, r.m1, r.m2)
        if not mass.sum():
            break
        shared = mass.sum(0) / mass.sum()
        shared0 = np.array([0.0, *(mass[:, 1:].sum(0) / max(mass[:, 1:].sum(), 1e-300))])
        mass += prior * shared
        mass[0] += prior * (shared0 - shared)
        weights = mass / mass.sum(1, keepdims=True)
    return weights


def score(docs: DataFrame, chunk_bytes: int = 8 << 20, range_tokens: int = 2_000_000, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 scores of whole texts.

    Learns from rows whose crc32 of the id as text does not end in 0 (modulo 10);
    those that leave 1 are the held-out tenth EM works on.
    """
    own = pick(docs, doc=doc_col, text=text_col).select(
        F.col("doc").cast("long").alias("doc"),
        F.coalesce(F.crc32(F.col("doc").cast("long").cast("string").cast("binary")) % 10, F.lit(0)).cast("int").alias("fold"), "text")
    table = stage(chunks(own, chunk_bytes), "lm-chunks")

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ends, folds in zip(batch.ends, batch.folds, strict=True):
                size, fold = np.diff(np.frombuffer(ends, np.int64), prepend=0), np.frombuffer(folds, np.int8)
                yield pd.DataFrame({"n": [size.sum()], "main": [size[fold > 1].sum()], "held": [size[fold == 1].sum()]})

    total = table.select("ends", "folds").mapInPandas(sizes, "n long, main long, held long").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "main", "held")]).first()
    answers = stage(answered(asked(table, 1 + total.n // range_tokens)), "lm-answers")
    types = answers.where("chunk < 0").agg(F.coalesce(F.sum("types"), F.lit(0)).alias("v"), F.coalesce(F.sum("main_types"), F.lit(0)).alias("m")).first()
    weights = learned_weights(stage(held_out_table(table, answers), "lm-held-out"), total.main, types.m)
    n_train, v = total.main + total.held, types.v

    def rate(key: tuple, mine: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in mine.itertuples(index=False):
            grams = Grams(row)
            uni, bi = (sum(x).astype(np.float64) for x in _told(grams, told).values())
            word, pair, context = uni[grams.at[1]], bi[grams.at[2]], _context(grams, uni)
            mix = weights[frequency_bucket(context)]
            chance = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word / max(1, n_train) + mix[:, 2] / (v + 1)
            if not n_train:
                chance = np.ones(len(word))
            base = np.log10((word + 0.1) / (n_train + 0.1 * (v + 1)))
            sums = lambda x: np.add.reduceat(x, grams.begins)  # noqa: B023, E731
            out.append(pd.DataFrame({"doc_id": pd.arrays.IntegerArray(np.frombuffer(row.docs, np.int64).copy(), np.frombuffer(row.missing, bool).copy()), "held_out": grams.folds == 0, "n_tokens": np.diff(grams.ends, prepend=0),
                                     "n_known": sums((word > 0).astype(np.int64)), "train_tokens": n_train, "base_score": sums(base), "score": sums(np.log10(chance))}))
        return pd.concat(out)

    told = answers.where("chunk >= 0").select(F.col("chunk").alias("of"), "bucket", "grams", "main", "held")
    return (table.select("chunk", "docs", "missing", "folds", "ends", "tokens", "words").groupBy("chunk").cogroup(told.groupBy("of"))
            .applyInPandas(rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
