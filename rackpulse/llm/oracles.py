"""DuckDB SQL that is built up level by level."""

from __future__ import annotations


def crc32(value: str) -> str:
    """The unsigned CRC-32 of an integer's decimal text, bit by bit."""
    s = f"CAST({value} AS VARCHAR)"
    byte = f"(CASE WHEN at_ % 8 = 0 THEN xor(crc_, ascii(substr({s}, CAST(at_ // 8 + 1 AS INTEGER), 1))::BIGINT) ELSE crc_ END)"
    step = f"xor({byte} >> 1, CASE WHEN {byte} & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], range(0, 8 * length({s}))), lambda crc_, at_: {step}), 4294967295::BIGINT)"


def _field(value: str) -> str:
    v = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({v}) || ':' || {v}, '-')"


def _ways(name: str, nodes: str, levels: int) -> str:
    """CTEs: for each node (tree, pos, n, d) of ``nodes`` its tree's top and, level by
    level, the siblings left and right of its way up (empty above the top)."""
    ctes = [f"{name}0 AS (SELECT tree, pos, n, d FROM {nodes})"]
    for i in range(levels):
        ctes.append(f"{name}{i + 1} AS (SELECT tree, pos // 16 AS pos, (n + 15) // 16 AS n,"
                    f" CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM {name}{i} GROUP BY tree, pos // 16, n)")
        run = "PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
        ctes.append(f"{name}s{i} AS (SELECT tree, pos, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,"
                    f" coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{i})")
    sides = ", ".join(f"s{i}.b AS {name}b{i}, s{i}.a AS {name}a{i}, s{i}.n AS {name}n{i}" for i in range(levels))
    joins = " ".join(f"JOIN {name}s{i} s{i} ON s{i}.tree = x.tree AND s{i}.pos = x.pos // {16 ** i}" for i in range(levels))
    ctes.append(f"{name} AS (SELECT x.tree, x.pos, t.d AS top, {sides} FROM {name}0 x JOIN {name}{levels} t ON t.tree = x.tree {joins})")
    return ",\n".join(ctes)


def merkle_sql(leaf_levels: int = 5, source_levels: int = 3) -> str:
    """The manifest of documents; trees of up to 16 ** levels leaves."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    leaf = lambda text: "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    names = [f"w{{}}{i}" for i in range(leaf_levels)] + [f"o{{}}{i}" for i in range(source_levels)]
    at = lambda side: [x.format(side) for x in names]
    proof = " || ".join(f"{b} || {a}" for b, a in zip(at("b"), at("a"), strict=True))
    folds = []
    for i, (b, a, n) in enumerate(zip(at("b"), at("a"), at("n"), strict=True)):
        folds.append(f"fold{i} AS (SELECT * EXCLUDE (node), CASE WHEN {n} = 1 THEN node ELSE sha256({b} || node || {a}) END AS node"
                     f" FROM {f'fold{i - 1}' if i else 'proved'})")
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS d,
    CASE WHEN {crc32("doc_id")} % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{lower}')")} ELSE {leaf("text")} END AS node
  FROM documents
), nodes AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
),
{_ways("w", "nodes", leaf_levels)},
sources AS (
  SELECT '' AS tree, tree AS source, d, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM w{leaf_levels}
),
{_ways("o", "sources", source_levels)},
proved AS (
  SELECT nodes.doc_id, nodes.d AS leaf, nodes.node, w.top AS subroot, o.top AS root, sha256({proof}) AS proof_sha256,
         {", ".join(at("b") + at("a") + at("n"))}
  FROM nodes JOIN w ON w.tree = nodes.tree AND w.pos = nodes.pos
  JOIN sources ON sources.source = nodes.tree JOIN o ON o.pos = sources.pos
),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, node AS folded_root, node = root AS verified FROM fold{len(names) - 1}
"""


def trie_sql() -> str:
    """The trie of rebuilt conversations: every prefix as one text, by a chain of steps."""
    return f"""
WITH RECURSIVE own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30)) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, {crc32("c")} % 4 AS h FROM (SELECT DISTINCT c FROM own)
), rebuilt AS (
  SELECT v.c, o.role, o.text, 0 AS late, o.pos FROM convs v JOIN own o ON o.c = v.c - v.c % 20 AND o.pos < v.h
  UNION ALL SELECT v.c, o.role, o.text, 1, o.pos FROM convs v JOIN own o ON o.c = v.c AND o.pos >= v.h
), rows_ AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY late, pos) AS d, sha256(strlen(role) || ':' || role || text) AS sym,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w
  FROM rebuilt
), pre AS (
  SELECT c, 0::BIGINT AS d, '' AS k, '' AS up, 0::BIGINT AS w FROM convs
  UNION ALL SELECT r.c, r.d, sha256(p.k || r.sym), p.k, r.w FROM pre p JOIN rows_ r ON r.c = p.c AND r.d = p.d + 1
), lens AS (
  SELECT c, max(d) AS len FROM pre GROUP BY c
), nodes AS (
  SELECT k, min(up) AS up, min(c) AS c, min(d) AS d, count(*) AS n, min(w) AS w,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = len), '')) AS ends
  FROM pre JOIN lens USING (c) GROUP BY k
), kids AS (
  SELECT up, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up
), named AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.k
), sums AS (
  SELECT a.k, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n - 1) * b.w) AS saved
  FROM named b JOIN pre a ON a.c = b.c AND a.d <= b.d GROUP BY a.k
)
SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, x.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM named x JOIN sums s ON s.k = x.k LEFT JOIN nodes p ON x.d > 0 AND p.k = x.up
"""
