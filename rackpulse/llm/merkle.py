"""Merkle dataset manifest by a cogrouped subtree exchange.

Every row is a leaf: the SHA-256 digest (lowercase hex) of its fields, each
`-` if null, else its UTF-8 byte count, `:` and its value. The leaves of one
source, in the order of their ids, form a tree in which 16 consecutive nodes at
a time (the last run may be shorter) become the digest of their digests joined,
until one node is left: the source's subroot. The subroots in the order of
their sources (null first, then by UTF-8 bytes) form a tree in the same way,
whose last node is the root.

Leaves get their places by ranges (``ordering``), so no task holds a source. A
tree is cut into *superblocks* of 16 ** LEVELS neighbouring nodes:

* up: each superblock is reduced to its top node in one ``applyInPandas``
  call; tops are the nodes of the next layer, until each tree has one;
* down: from the last layer to the leaves, the nodes of a superblock and the
  one *outer* row it requires (the siblings on the way from its top to the
  root) are cogrouped in ``applyInPandas``. There the local reduction is done,
  each node's local siblings are joined to the outer ones, and, for leaves, the
  proof is folded to a root.

A group holds at most 256 nodes and one outer row, whatever the number of
rows, sources or layers.

Defined results:

* a null field counts as `-`, an empty text as `0:`; a null source is a source
  of its own, before all others;
* ids are ordered with null first; rows of one source that share an id are
  ordered by leaf digest, and rows that are alike in all fields are leaves of
  their own, one beside the other;
* an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stage
from .ordering import in_order, placed

RUN = 16
LEVELS = 2
BLOCK = RUN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODE = "tree string, pos long, n long, digest string"
PROVED = "tree string, pos long, before array<string>, after array<string>, subroot string, root string"


def digest(*parts: str) -> str:
    """The lowercase hex digest of the parts joined."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """The leaf of a row with these fields."""
    shown = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]), 256)


def reduced(nodes: list[str], n: int) -> list[list[str]]:
    """A superblock's nodes by level, its own first; ``n``: nodes of the whole
    tree at the first level. The last level has one node."""
    levels = [nodes]
    while len(levels) <= LEVELS and n > 1:
        nodes = [digest(*nodes[i: i + RUN]) for i in range(0, len(nodes), RUN)]
        levels.append(nodes)
        n = -(-n // RUN)
    return levels


def siblings(levels: list[list[str]]) -> Iterator[tuple[list[str], list[str]]]:
    """For each node of the first level: the siblings left and right of its way
    up, joined, one entry a level."""
    sides = []
    for nodes in levels[:-1]:
        runs = [nodes[i: i + RUN] for i in range(0, len(nodes), RUN)]
        sides.append([("".join(run[:i]), "".join(run[i + 1:])) for run in runs for i in range(len(run))])
    for i in range(len(levels[0])):
        way = [side[i // RUN ** k] for k, side in enumerate(sides)]
        yield [w[0] for w in way], [w[1] for w in way]


def folded(leaf: str, before: Sequence[str], after: Sequence[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in zip(before, after, strict=True):
        leaf = digest(left, leaf, right)
    return leaf


def _tops(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    n, first = int(nodes["n"].iloc[0]), int(nodes["pos"].iloc[0])
    top = reduced(nodes["digest"].tolist(), n)[-1][0]
    return pd.DataFrame({"tree": nodes["tree"].iloc[:1], "pos": first // BLOCK, "n": -(-n // BLOCK), "digest": top})


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).groupBy("tree", "block")


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The layers of the trees of ``nodes`` (tree, pos, n, digest; written): the
    nodes, the tops of their superblocks, and so on until each tree has one."""
    layers = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        layers.append(stage(_blocks(layers[-1].select("tree", "pos", "n", "digest")).applyInPandas(_tops, NODE), "merkle-layer"))
        most = -(-most // BLOCK)
    return layers


def _joined(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """(nodes by place, before, after): each node's siblings up to the root."""
    nodes = nodes.sort_values("pos")
    over = [list(outer[side].iloc[0]) for side in ("before", "after")]
    levels = reduced(nodes["digest"].tolist(), int(nodes["n"].iloc[0]))
    ways = [(b + over[0], a + over[1]) for b, a in siblings(levels)]
    return nodes.assign(before=[w[0] for w in ways], after=[w[1] for w in ways],
                        subroot=outer["subroot"].iloc[0], root=outer["root"].iloc[0])


def _inner(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    return _joined(nodes, outer)[["tree", "pos", "before", "after", "subroot", "root"]]


def descended(layers: list[DataFrame], outer: DataFrame, last: Callable = _inner, schema: str = PROVED) -> DataFrame:
    """What ``last`` makes of the nodes of the first layer and their outer rows;
    ``outer``: those of the last layer's nodes (PROVED)."""
    for layer in reversed(layers[1:-1]):
        outer = stage(_blocks(layer).cogroup(outer.groupBy("tree", "pos")).applyInPandas(_inner, PROVED), "merkle-outer")
    return _blocks(layers[0]).cogroup(outer.groupBy("tree", "pos")).applyInPandas(last, schema)


def _over_sources(tops: DataFrame) -> DataFrame:
    """The outer rows (PROVED) of the subroots ``tops`` (tree, digest)."""
    written = stage(in_order(tops.select(F.lit("").alias("all"), F.col("tree").alias("source"), "digest"), "all", ["source"]), "merkle-sources")
    nodes = stage(placed(written, "all").withColumnRenamed("all", "tree"), "merkle-subroots")
    layers = climbed(nodes)
    none = F.array().cast("array<string>")
    outer = layers[-1].select("tree", "pos", none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    if len(layers) == 1:  # one source: its subroot is the root
        proved = outer.join(nodes, ["tree", "pos"])
    else:
        proved = descended(layers, outer).join(nodes, ["tree", "pos"])
    return proved.select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "before", "after", F.col("digest").alias("subroot"), "root")


def _proved_leaves(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    made = _joined(nodes, outer)
    ways = list(zip(made["before"], made["after"], strict=True))
    made["proof_sha256"] = [digest(*(x for pair in zip(b, a, strict=True) for x in pair)) for b, a in ways]
    shown = made["digest"].where(made["other"].isna(), made["other"])
    made["folded_root"] = [folded(leaf, *way) for leaf, way in zip(shown, ways, strict=True)]
    return made


PROOF = "known boolean, doc long, digest string, subroot string, root string, proof_sha256 string, folded_root string"


def _digests(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    return _proved_leaves(nodes, outer)[["known", "doc", "digest", "subroot", "root", "proof_sha256", "folded_root"]]


def _proofs(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    return _proved_leaves(nodes, outer)[["known", "doc", "digest", "subroot", "root", "proof_sha256", "folded_root", "before", "after"]]


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             tampered: dict[str, Callable[..., Column]] | None = None, proofs: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), one row
    per row of ``docs``.

    ``tampered``: for a field, a function of (id, field) giving its changed
    value, null where it is left as it is; the proof is then folded from the leaf
    with changed fields, and ``verified`` is whether that leads to the root.
    ``proofs`` adds the siblings themselves, ``before`` and ``after`` (one
    entry a level, digests joined)."""
    plain = pick(docs, **{f"f{i}": f for i, f in enumerate(fields)}, id=id_col, source=source_col)
    own = [F.col(f"f{i}") for i in range(len(fields))]
    changes = {f: change(F.col("id"), own[fields.index(f)]) for f, change in (tampered or {}).items()}
    other = F.lit(None).cast("string")
    if changes:
        touched = F.coalesce(*[c.cast("string") for c in changes.values()]).isNotNull()
        other = F.when(touched, leaf_digest(*[F.coalesce(changes[f], x) if f in changes else x for f, x in zip(fields, own, strict=True)]))
    leaves = stage(plain.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),  # a null source comes first
        F.col("id").isNotNull().alias("known"), F.coalesce(F.col("id").cast("long"), F.lit(0)).alias("doc"),
        leaf_digest(*own).alias("digest"), other.alias("other")), "merkle-leaves")
    nodes = stage(placed(stage(in_order(leaves, "tree", ["known", "doc", "digest"]), "merkle-order"), "tree"), "merkle-nodes")
    layers = climbed(nodes)
    outer = stage(_over_sources(layers[-1].where("pos = 0").select("tree", "digest")), "merkle-outer")
    last, schema = (_proofs, PROOF + ", before array<string>, after array<string>") if proofs else (_digests, PROOF)
    return descended([layers[0], layers[0]] if len(layers) == 1 else layers, outer, last, schema).select(
        F.when(F.col("known"), F.col("doc")).alias(id_col), F.col("digest").alias("leaf"), "subroot", "root",
        "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
        *(["before", "after"] if proofs else []))
