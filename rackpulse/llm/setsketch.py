"""MinHash near-dedup with SetSketch registers.

A document's set holds the hashes (64 bits) of its distinct word shingles. Its
sketch has 181 registers, each an exponentially spaced, truncated minimum:
every member of the set draws, from its hash, one exponential value for each
register (rate 20), and a register holding the minimum x is
``floor(1 - log_b x)`` with b = 1.01, kept between 0 and 65,535. Registers of a
union are the larger ones of its parts, and two sets agree in a register with a
probability of about their similarity. A member's values are drawn in ascending
order, register after register (a walk through all 181), and a document is done
as soon as no next value can lower any minimum: about two draws a member.

* Documents of equal word sequences are one *class*; the rest deals with classes.
* 30 bands of 6 registers put classes into buckets: two classes of similarity
  0.85 share no bucket once in 1.4 million pairs. The least class of a bucket is
  its pivot.
* Each class meets its least pivot first; all pairs of a pivot stream through
  the task that holds the pivot's text, hot pivots in pieces.
* A pair whose sizes allow the similarity, and half of whose registers agree, is
  estimated by maximum likelihood from how many registers are greater, equal and smaller, given both sizes;
  estimates six standard errors or more below the threshold go. The others are
  *verified* on the full sets.
* Buckets whose classes are then still in several components are searched
  whole, in blocks of about 1,000 classes against each other: estimates first, then texts
  of classes with a likely partner in another component. Within a block a pair already
  connected need not be verified. So no link is lost, and no list of pairs is
  written.

Components come from star contraction (``simhash.components``).

Defined results:

* a null or empty text, or one of white space only, has an empty set
  (n_shingles 0) and is linked with nothing; with fewer words than a shingle the whole
  sequence is one shingle;
* rows sharing a doc_id stay separate rows; a row with a null doc_id gets the
  smallest id of its component (null if there is none) and counts as kept only
  if that is null;
* an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, slices, stage, text_bytes
from .ordering import HOT, join_hot
from .simhash import components

REGISTERS = 181
BANDS, ROWS = 30, 6
RATE, B = 20.0, 1.01
BLOCK = 1000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread permutation of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _factors(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(seed + 1, seed + n + 1, dtype=np.uint64) * _MIX[0]) | np.uint64(1)


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words (of the whole
    sequence, if it has fewer words; none without words)."""
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    taken = min(size, len(one))
    by = _factors(taken, 1000 * taken)
    total = np.zeros(len(one) - taken + 1, np.uint64)
    for i in range(taken):
        total += one[i: len(one) - taken + 1 + i] * by[i]
    return np.unique(mixed(total))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (uint16) of each set, a row each."""
    m, n = REGISTERS, len(sets)
    least = np.full(n * m, np.inf)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    value, at = np.zeros(len(h)), (h % np.uint64(m)).astype(np.int64)
    step = 1 + (h // np.uint64(m) % np.uint64(m - 1)).astype(np.int64)
    for j in range(m):
        if not len(h):
            break
        salt = np.uint64((j + 1) * int(_MIX[0]) % (1 << 64))
        draw = (mixed(h + salt) >> np.uint64(11)).astype(np.float64)
        value -= np.log((draw + 0.5) / (1 << 53)) / (RATE * (m - j))
        np.minimum.at(least, of * m + at, value)
        open_ = value < least.reshape(n, m).max(axis=1)[of]
        h, of, value, step = h[open_], of[open_], value[open_], step[open_]
        at = (at[open_] + step) % m
    with np.errstate(divide="ignore"):
        made = np.floor(1 - np.log(least) / np.log(B))
    return np.clip(made, 0, 65535).astype(np.uint16).reshape(n, m)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Similarity of sets of sizes na, nb with registers a, b: the maximum of
    the likelihood of the numbers of greater, smaller and equal registers."""
    more, less = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    same = a.shape[-1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)
    tiny = 1e-300

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        return more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny)) + same * np.log(np.maximum(1 - p - q, tiny))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def least_estimate(share: int) -> float:
    """Six standard errors below ``share`` per cent."""
    j = share / 100
    return j - 6 * (j * (1 - j) / REGISTERS) ** 0.5


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, share: int) -> np.ndarray:
    """Whether pairs can have the similarity: by their sizes, by half of their
    registers (some nine standard errors below 0.8), then by the estimate. The
    likelihood is concave, so its maximum lies at ``least_estimate`` or above
    where its slope there is not negative: one evaluation, no search."""
    na, nb = np.broadcast_arrays(np.asarray(na, np.float64), np.asarray(nb, np.float64))
    ok = 100 * np.minimum(na, nb) >= share * np.maximum(na, nb)
    same = (a == b).sum(axis=-1)
    ok &= 2 * same >= REGISTERS
    at = np.nonzero(ok)[0]
    if len(at):
        a, b = np.broadcast_to(a, (len(ok), a.shape[-1]))[at], np.broadcast_to(b, (len(ok), b.shape[-1]))[at]
        same, more = same[at], (a > b).sum(axis=-1)
        ok[at] = slope(least_estimate(share), more, REGISTERS - more - same, same, na[at], nb[at]) >= 0
    return ok


def slope(j: float, more: np.ndarray, less: np.ndarray, same: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Derivative of the log-likelihood of ``estimate`` at similarity ``j``."""
    u, v = na / (na + nb), nb / (na + nb)
    x, y, c, log_b = u - v * j, v - u * j, (B - 1) / B, np.log(B)
    p, q = -np.log1p(-x * c) / log_b, -np.log1p(-y * c) / log_b
    dp, dq = v * c / (1 - x * c) / log_b, u * c / (1 - y * c) / log_b
    return same * (dp + dq) / (1 - p - q) - more * dp / p - less * dq / q


def alike(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    """Whether the full sets have the similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= share * (len(a) + len(b) - both)


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc, k1, k2, class, n, sketch) of documents (doc, k1, k2, text); class and sketch null without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                names, sets = [], []
                for text in text_bytes(part.column("text")):
                    words = _words(text)
                    names.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                    sets.append(shingles(words, size))
                regs = sketches(sets)
                yield pa.RecordBatch.from_pydict({
                    "doc": part.column("doc"), "k1": part.column("k1"), "k2": part.column("k2"), "class": pa.array(names, pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "sketch": pa.array([r.tobytes() if name else None for r, name in zip(regs, names, strict=True)], pa.binary())})

    return docs.mapInArrow(scan, "doc long, k1 long, k2 long, class binary, n long, sketch binary")


def registers(column) -> np.ndarray:
    """Sketches of an Arrow column or list of bytes as rows."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), REGISTERS)


def banded(classes: DataFrame) -> DataFrame:
    """(key, node): each class in the bucket of each of its bands."""
    by = _factors(ROWS, 7)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = registers(batch.column("sketch"))[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
            keys = mixed((regs * by).sum(axis=2, dtype=np.uint64) * _MIX[1] + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0])
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64).ravel()),
                                              "node": pa.array(np.repeat(np.asarray(batch.column("node")), BANDS))})

    return classes.select("node", "sketch").mapInArrow(scan, "key long, node long")


def _split(counts: DataFrame, total: int, key: str) -> DataFrame:
    """(key, pieces) of the keys over a thousandth of ``total`` (a thousand at most), to be broadcast."""
    most = max(32, int(total * HOT))
    return F.broadcast(counts.where(F.col("count") > most).select(key, F.ceil(F.col("count") / most).cast("long").alias("pieces")))


def bucketed(classes: DataFrame, total: int) -> DataFrame:
    """(key, node, pivot, count): members of buckets with several classes; written."""
    rows = banded(classes)
    several = rows.groupBy("key").agg(F.count("*").alias("count"), F.min("node").alias("pivot")).where("count > 1")
    several = stage(several, "sketch-buckets")
    most = max(1, int(total * BANDS * HOT))
    hot, cold = F.broadcast(several.where(F.col("count") > most)), several.where(F.col("count") <= most)
    return stage(rows.join(hot, "key").unionByName(rows.join(cold, "key")), "sketch-members")


@dataclass
class Pivot:
    """The pivot at hand in a stream; its set is made when it is first needed."""

    node: int = -1
    n: int = 1
    regs: np.ndarray = field(default_factory=lambda: np.zeros(REGISTERS, np.uint16))
    text: bytes = b""
    own: np.ndarray | None = None

    def set(self, size: int) -> np.ndarray:
        if self.own is None:
            self.own = shingles(_words(self.text), size)
        return self.own


def star_links(texts: DataFrame, size: int, share: int) -> DataFrame:
    """(a, b): verified links of classes with their pivots; ``texts``: (node, n,
    sketch, text, pivot, piece, pieces): pieces is not null for pivots."""
    none = F.array().cast("array<struct<to:bigint,in:bigint,turn:int>>")
    asked = F.when(F.col("pivot").isNotNull(), F.array(F.struct(F.col("pivot").alias("to"), F.col("piece").alias("in"), F.lit(1).alias("turn"))))
    given = F.transform(F.when(F.col("pieces").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)),
                        lambda i: F.struct(F.col("node").alias("to"), i.alias("in"), F.lit(0).alias("turn")))
    dealt = (texts.select("node", "n", "sketch", "text", F.inline(F.concat(F.coalesce(asked, none), F.coalesce(given, none))))
             .repartition("to", "in").sortWithinPartitions("to", "in", "turn", "node"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = Pivot()
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                to, turn, node, n = (batch.column(c).to_pylist() for c in ("to", "turn", "node", "n"))
                regs, texts = registers(batch.column("sketch")), text_bytes(batch.column("text"))
                pivots, at = [last], []
                for i, first in enumerate(turn):
                    if first == 0:
                        pivots.append(Pivot(to[i], n[i], regs[i].copy(), texts[i]))
                    at.append(len(pivots) - 1)
                near = likely(regs, np.stack([p.regs for p in pivots])[at], n, np.array([p.n for p in pivots])[at], share)
                pairs = [(node[i], to[i]) for i in np.nonzero(near & (np.array(turn) == 1))[0].tolist()
                         if alike(shingles(_words(texts[i]), size), pivots[at[i]].set(size), share)]
                last = pivots[-1]
                yield _pair_batch(pairs)

    return dealt.select("to", "turn", "node", "n", "sketch", "text").mapInArrow(scan, "a long, b long")


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def open_buckets(members: DataFrame, links: DataFrame) -> DataFrame:
    """(key, node, root, my, blocks): the members of buckets that lie in several
    components of ``links``, each set of members once; ``my``: the member's block."""
    roots = components(links).select(F.col("node").alias("of"), "root")
    blocks = F.ceil(F.col("count") / BLOCK).cast("long")
    rows = stage(members.join(roots, F.col("node") == F.col("of"), "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"), blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).alias("my")), "sketch-roots")
    buckets = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.first("blocks").alias("blocks"),
                                      F.struct(F.count("*"), F.sum(F.xxhash64("node").cast("decimal(38,0)")),
                                               F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)"))).alias("same"))
    once = buckets.where("low < high").groupBy("same").agg(F.min("key").alias("key"), F.first("blocks").alias("blocks"))
    once = once.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("my"))
    return rows.join(once, ["key", "my"])


def _against(rows: DataFrame) -> DataFrame:
    """Rows (key, my, blocks, ...) dealt out to pairs of blocks (i, j), sorted by
    them; ``side``: which of the two blocks a row is of."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = rows.select("*", other).select("*", F.least("my", "other").alias("i"), F.greatest("my", "other").alias("j"), F.expr("int(my > other)").alias("side"))
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (key, i, j) of a sorted stream: two blocks at most."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = np.stack([np.asarray(batch.column(c)) for c in ("key", "i", "j")])
        starts = np.r_[0, np.nonzero((own[:, 1:] != own[:, :-1]).any(axis=0))[0] + 1, batch.num_rows]
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            now = tuple(own[:, start].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _near_pairs(group: pa.Table, root: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the group's pairs in different components that can be alike."""
    regs, n = registers(group.column("sketch")), np.asarray(group.column("n"))
    across = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    side = np.asarray(group.column("side"))
    left = np.nonzero(side == 0)[0] if across else np.arange(len(n) - 1)
    right = np.nonzero(side == 1)[0]
    found = []
    step = max(1, 4096 // max(1, len(n)))
    for start in range(0, len(left), step):  # some thousand pairs at a time
        some = left[start: start + step]
        if across:
            x, y = np.repeat(some, len(right)), np.tile(right, len(some))
        else:
            x = np.repeat(some, len(n) - 1 - some)
            y = np.concatenate([np.arange(i + 1, len(n)) for i in some])
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        if len(x):
            near = likely(regs[x], regs[y], n[x], n[y], share)
            found.append((x[near], y[near]))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.empty(0, int), np.empty(0, int))


def asked(rows: DataFrame, share: int) -> DataFrame:
    """(key, node, my, blocks): members with a likely partner in another component."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            x, y = _near_pairs(group, np.asarray(group.column("root")), share)
            if len(x):
                yield from group.select(["key", "node", "my", "blocks"]).take(pa.array(np.union1d(x, y))).combine_chunks().to_batches()

    return _against(rows).mapInArrow(scan, "key long, node long, my long, blocks long").distinct()


def verified(rows: DataFrame, size: int, share: int) -> DataFrame:
    """(a, b): links within groups that connect different components."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            root, node = np.asarray(group.column("root")).copy(), np.asarray(group.column("node"))
            texts, sets, pairs = text_bytes(group.column("text").combine_chunks()), {}, []
            for x, y in zip(*(p.tolist() for p in _near_pairs(group, root, share)), strict=True):
                if root[x] == root[y]:
                    continue  # connected by now
                for k in (x, y):
                    if k not in sets:
                        sets[k] = shingles(_words(texts[k]), size)
                if alike(sets[x], sets[y], share):
                    pairs.append((int(node[x]), int(node[y])))
                    root[root == root[y]] = root[x]
            yield _pair_batch(pairs)

    return _against(rows).mapInArrow(scan, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, share: int = 85, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``:
    documents whose shingle sets have a similarity of ``share`` per cent or more are linked."""
    own = pick(docs, doc=doc_col, text=text_col).withColumn("doc", F.col("doc").cast("long"))
    own = own.select("doc", "text", F.xxhash64("doc", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc").alias("k2"))
    every = stage(sketched(own, words), "sketch-documents")
    classes = every.where("class IS NOT NULL").groupBy("class").agg(F.min("doc").alias("first"), F.min(F.struct("k1", "k2", "n", "sketch")).alias("one"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("node"), "class", "first", "one.*"), "sketch-classes")
    total = classes.count()

    members = bucketed(classes, total)
    star = members.where("node <> pivot").groupBy("node").agg(F.min("pivot").alias("pivot"))
    pivots = star.groupBy("pivot").count()
    hot = _split(pivots, total, "pivot")
    star = star.join(hot, "pivot", "left").select("node", "pivot", F.pmod(F.xxhash64("node"), F.coalesce("pieces", F.lit(1))).alias("piece"))
    pivots = pivots.join(hot, "pivot", "left").select(F.col("pivot").alias("node"), F.coalesce("pieces", F.lit(1)).cast("long").alias("pieces"))
    roles = members.select("node").distinct().join(star, "node", "left").join(pivots, "node", "left")
    held = classes.select("node", "k1", "k2", "n", "sketch").join(roles, "node")
    texts = stage(own.select("k1", "k2", "text").join(held, ["k1", "k2"]).dropDuplicates(["k1", "k2", "node"]).drop("k1", "k2"), "sketch-texts")

    links = stage(star_links(texts, words, share), "sketch-links")
    rest = stage(open_buckets(members, links).join(classes.select("node", "n", "sketch"), "node"), "sketch-open")
    some = stage(asked(rest, share).join(rest.select("key", "node", "root"), ["key", "node"]), "sketch-asked")
    more = verified(some.join(texts.select("node", "n", "sketch", "text"), "node"), words, share)
    linked = components(links.unionByName(more)).select(F.col("node").alias("of"), "root")

    placed = stage(classes.join(linked, F.col("node") == F.col("of"), "left").select("class", "first", "node", F.coalesce("root", "node").alias("root")), "sketch-components")
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = join_hot(placed.select("class", "node", "root"), ids, "root", F.xxhash64("node")).select("class", "component_id")
    full, none = every.where("class IS NOT NULL").select("doc", "class", "n"), every.where("class IS NULL").select("doc", "n", F.col("doc").alias("component_id"))
    found = join_hot(full, named, "class", F.xxhash64("doc")).select("doc", "n", "component_id").unionByName(none)
    return found.select(F.col("doc").alias(doc_col), F.col("n").alias("n_shingles"), "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))
