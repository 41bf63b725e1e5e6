"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A merge round forms the keys
of all neighbouring pairs, finds their ranks by binary search over the sorted
pair keys of the vocabulary, takes each word's lowest rank and merges that
pair wherever it occurs in the word, all words at once. Words with no pair
left drop out, so a few long words do not hold up the rest. A word is merged
once, however often it occurs; a worker remembers a bounded number of words.

The vocabulary (a tokenizer file of the public ``tokenizers`` format with
byte-level BPE) is a path parameter; only its path travels to the tasks.

Defined results:

* a null or empty text has no ids and decodes to the empty text;
* strings of added tokens (``<|endoftext|>``) in a text become their ids, as
  the ``tokenizers`` library does unless told otherwise;
* ids that do not form UTF-8 decode with U+FFFD in place of the broken bytes;
  null ids decode to the empty text, ids outside the vocabulary raise;
* rows are independent: repeated rows and doc_ids give repeated results; an
  empty table gives no rows; other columns pass through whatever their names,
  only one named like the output column is replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from .common import pick, slices

NONE = np.int32(np.iinfo(np.int32).max)
BATCH = 1 << 20  # bytes of text encoded at once


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of ``flat`` one after another, and where each ends."""
    size = sizes[chosen]
    ends = np.cumsum(size)
    at = np.repeat(starts[chosen] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return flat[at], ends


class ByteBPE:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str, keep: int = 200_000) -> None:
        """``keep``: words remembered with their ids between batches."""
        self.keep = keep
        self._forget()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.pattern = regex.compile(pattern)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.of_byte = np.empty(256, np.int32)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        content: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            content[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            content[i] = token.encode()
        self.known = np.array([bool(c) for c in content])
        self._bytes = self._runs(content)
        self._decimals = self._runs([b"%d," % i for i in range(self.size)])

    @staticmethod
    def _runs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of symbols, ``NONE`` for those never merged."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and each word's number of ids."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        ranks = self._ranks(symbols, word, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            begins = np.r_[0, np.nonzero(word[1:] != word[:-1])[0] + 1]
            lowest = np.minimum.reduceat(ranks, begins)
            count = np.diff(np.r_[begins, len(word)])
            if (lowest == NONE).any():
                left = np.repeat(lowest != NONE, count)
                done.append((word[~left], symbols[~left]))
                word, symbols, ranks = word[left], symbols[left], ranks[left]
                lowest, count = lowest[lowest != NONE], count[lowest != NONE]
            at = np.nonzero(ranks == np.repeat(lowest, count))[0]
            if not len(at):
                break
            # of overlapping occurrences (aaa) every second one, from the left
            run = np.r_[0, np.cumsum(np.diff(at) > 1)]
            first = np.r_[0, np.nonzero(np.diff(run))[0] + 1]
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))  # one symbol less for each merge before
            symbols, word, ranks = symbols[stay], word[stay], ranks[stay]
            for near in (at, at[at > 0] - 1):  # only pairs beside a merge change
                ranks[near] = self._ranks(symbols, word, near)
        if not done:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def _ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the given places; none across words."""
        after = np.minimum(at + 1, len(symbols) - 1)
        inside = (word[after] == word[at]) & (after > at)
        return np.where(inside, self.rank(symbols[at], symbols[after]), NONE)

    def words(self, text: str) -> list[str]:
        if self.split is None or not any(t in text for t in self.added):
            return self.pattern.findall(text)
        return [w for piece in self.split.split(text) for w in ([piece] if piece in self.added else self.pattern.findall(piece))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids end."""
        if len(self.table) > self.keep:
            self._forget()
        known, number = len(self.table), self.table.__getitem__
        at, counts = [], []
        for text in texts:
            before = len(at)
            at += map(number, self.words(text or ""))
            counts.append(len(at) - before)
        if len(self.table) > known:
            new = list(islice(self.table, known, None))
            flat, sizes = self.merge([b"" if w in self.added else w.encode() for w in new])
            for i, w in enumerate(new):
                if sizes[i] == 0:  # an added token
                    flat = np.insert(flat, sizes[:i].sum(), self.added[w])
                    sizes[i] = 1
            self.flat, self.sizes = np.append(self.flat, flat), np.append(self.sizes, sizes)
            self.starts = np.cumsum(self.sizes) - self.sizes
        ids, ends = gathered(self.flat, self.starts, self.sizes, np.array(at, np.int64))
        return ids, np.r_[0, ends][np.cumsum(counts)] if counts else np.empty(0, np.int64)

    def _forget(self) -> None:
        """Start anew with the words merged so far: their number is bounded."""
        self.table: defaultdict[str, int] = defaultdict()
        self.table.default_factory = self.table.__len__
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of runs of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return [x.decode("utf-8", "replace") for x in self._cut(self._bytes, ids, ends)]

    def listed(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Each run of ids as decimal numbers joined by commas."""
        return [x[:-1] for x in self._cut(self._decimals, ids, ends)]

    def _cut(self, runs: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        flat, stops = gathered(*runs, ids)
        stops = np.r_[0, stops][ends]
        for a, b in zip(np.r_[0, stops[:-1]], stops, strict=True):
            yield flat[a:b].tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> ByteBPE:
    """One copy a worker process."""
    return ByteBPE(path, pattern)


def _mapped(df: DataFrame, column: str, out: str, kind: S.DataType, change: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with a column ``out`` made from ``column``, other columns as they are."""
    names = df.columns
    at = names.index(column)
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = slices(batch, f"c{at}", BATCH) if pa.types.is_string(batch.column(at).type) else [batch]
            for part in pieces:
                yield pa.RecordBatch.from_arrays([*part.columns, change(part.column(at))], names=[*part.schema.names, "made"])

    schema = S.StructType([S.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)] + [S.StructField("made", kind)])
    old = [i for i, n in enumerate(names) if n != out]
    return plain.mapInArrow(run, schema).select(*[f"c{i}" for i in old], "made").toDF(*[names[i] for i in old], out)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids (array of int) of a text column."""

    def ids(texts: pa.Array) -> pa.Array:
        flat, ends = vocabulary(path, pattern).encode(texts.to_pylist())
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat, pa.int32()))

    return _mapped(docs, text_col, out, S.ArrayType(S.IntegerType()), ids)


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of a column of token ids."""

    def texts(column: pa.Array) -> pa.Array:
        lists = [x or [] for x in column.to_pylist()]
        flat = np.array([i for x in lists for i in x], np.int64)
        return pa.array(vocabulary(path, pattern).decode(flat, np.cumsum([len(x) for x in lists], dtype=np.int64)), pa.string())

    return _mapped(rows, ids_col, out, S.StringType(), texts)


def round_trip(docs: DataFrame, path: str, pattern: str, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, its
    ids decoded again, both digested where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, digest = vocabulary(path, pattern), lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for part in slices(batch, "text", BATCH):
                ids, ends = bpe.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0), "n_tokens": pa.array(np.diff(ends, prepend=0), pa.int64()),
                    "ids_sha256": [digest(x) for x in bpe.listed(ids, ends)],
                    "decoded_sha256": [digest(x.encode()) for x in bpe.decode(ids, ends)]})

    own = pick(docs, doc=doc_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
