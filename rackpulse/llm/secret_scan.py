"""Secret scans with a trigram inverted index.

Each rule's regular expression is read (by Python's own expression parser)
into a Boolean query over trigrams: an AND of clauses, each an OR of
trigrams, that every match must satisfy. The inverted index posts, for every
trigram that any rule's query names, the documents whose lower-cased text
holds it. Postings are intersected per rule: a document is a candidate if it
has a posting in each clause. Candidates are verified by the expression
itself; rules without a mandatory trigram scan every text.

Postings are rows (trigram, document key), summed up per (rule, clause) before
they are counted, so a trigram that all documents hold is spread like any
other. A document's key is its id and a digest of its text: rows that agree in
both have the same spans, so each different row is verified once.

Everything is DataFrame operations; the rules, a parameter, are the only thing
that travels with the plan.

Spans are code points, end exclusive. Per rule, matches are leftmost and do
not overlap; a rule may ask for a least length of a group or of the match and
then drops what falls short. Different rules' spans may overlap.

Defined results:

* a null or empty text has no spans (counts 0, empty strings);
* rows are scanned one by one: repeated rows give repeated results; a null
  doc_id is carried through;
* an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stage


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax Java and Python share; group ``group`` of a
    match must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further kinds of widely known secrets, by their public formats.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20:/@]+:[^\x00-\x20:/@]+@"),
)
MOST_STRINGS = 64  # alternatives a piece of an expression may have before it counts as unknown


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses (ORs of lower-case trigrams) that all hold in every text with a match.

    A run of the expression that can only be one of a few strings gives a
    clause for each position its strings share; what is optional, repeated
    freely or any of many characters ends a run.
    """
    clauses: set[frozenset[str]] = set()

    def settle(strings: set[str]) -> None:
        """The strings of one run: each match holds one of them whole."""
        if strings and min(map(len, strings)) >= 3:
            grams = [[s[i: i + 3] for i in range(len(s) - 2)] for s in strings]
            if len(strings) == 1:
                clauses.update(frozenset([g]) for g in grams[0])
            else:  # a trigram of each string: the first ones, and the last ones
                clauses.update((frozenset(g[0] for g in grams), frozenset(g[-1] for g in grams)))

    def exact(node) -> set[str] | None:
        """All strings a node can match, lower-case, if they are few."""
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return {chr(value).lower()}
        if kind == "IN":
            out: set[str] = set()
            for k, v in value:
                if str(k) == "LITERAL":
                    out.add(chr(v).lower())
                elif str(k) == "RANGE" and v[1] - v[0] < MOST_STRINGS:
                    out |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
                else:
                    return None
            return out if len(out) <= 8 else None
        if kind == "SUBPATTERN":
            return strings_of(value[-1])
        if kind == "BRANCH":
            each = [strings_of(b) for b in value[1]]
            return None if None in each else set().union(*each)
        if kind in ("MAX_REPEAT", "MIN_REPEAT") and value[1] <= 4:
            inner = strings_of(value[2])
            if inner is not None and (value[1] <= 1 or len(inner) == 1):
                return {s * n for s in inner for n in range(int(value[0]), int(value[1]) + 1)}
        return None

    def joined(a: set[str], b: set[str]) -> set[str] | None:
        return {x + y for x, y in product(a, b)} if len(a) * len(b) <= MOST_STRINGS else None

    def strings_of(nodes) -> set[str] | None:
        out: set[str] | None = {""}
        for node in nodes:
            own = exact(node)
            out = joined(out, own) if own is not None else None
            if out is None:
                return None
        return out

    def walk(nodes) -> None:
        run = {""}
        for node in nodes:
            own = exact(node)
            longer = joined(run, own) if own is not None else None
            if longer is not None:
                run = longer
                continue
            settle(run)
            run = own if own is not None else {""}
            kind, value = str(node[0]), node[1]
            if own is None and kind == "SUBPATTERN":
                walk(value[-1])
            elif own is None and kind in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
                walk(value[2])  # comes once at least
        settle(run)

    walk(re._parser.parse(pattern))
    return sorted(clauses, key=sorted)


def posted(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, doc, digest) of rows (doc, digest, text)."""
    held = F.lower("text")
    found = F.array_compact(F.array(*[F.when(held.contains(F.lit(t)), F.lit(t)) for t in trigrams]))
    return rows.select(F.explode(found).alias("trigram"), "doc", "digest")


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc, digest, kinds): documents with a posting in every clause of a kind's query."""
    terms = [F.struct(F.lit(t).alias("term"), F.lit(kind).alias("kind"), F.lit(i).alias("clause"), F.lit(len(q)).alias("clauses"))
             for kind, q in queries.items() for i, clause in enumerate(q) for t in sorted(clause)]
    spark = postings.sparkSession
    named = spark.range(1).select(F.explode(F.array(*terms)).alias("t")).select("t.*")
    return (postings.join(F.broadcast(named), F.col("trigram") == F.col("term"))  # as many rows as the rules have terms
            .groupBy("doc", "digest", "kind", "clauses").agg(F.collect_set("clause").alias("met"))  # of a few clauses
            .where("size(met) = clauses").groupBy("doc", "digest").agg(F.collect_set("kind").alias("kinds")))


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'"


def spans(rule: Rule, order: int, text: str = "text") -> Column:
    """Array of (start, order, end, kind) of the rule's matches in a column.

    The texts between matches and the matches themselves, alternating, tell
    where each match lies.
    """
    pattern = _quoted(rule.pattern)
    matches = f"regexp_extract_all({text}, {pattern}, 0)"
    sized = f"regexp_extract_all({text}, {pattern}, {rule.group})"
    placed = f"""aggregate(
        zip_with(zip_with({matches}, {sized}, (m, g) -> struct(m, g)), slice(split({text}, {pattern}, -1), 1, size({matches})),
                 (x, gap) -> struct(length(gap) as gap, length(x.m) as len, length(x.g) as size)),
        struct(0 as at, cast(array() as array<struct<start: int, ord: int, end: int, kind: string>>) as out),
        (acc, x) -> struct(acc.at + x.gap + x.len as at,
            if(x.size >= {rule.least},
               concat(acc.out, array(struct(acc.at + x.gap as start, {order} as ord, acc.at + x.gap + x.len as end, '{rule.kind}' as kind))),
               acc.out) as out),
        acc -> acc.out)"""
    return F.when(F.expr(f"{text} rlike {_quoted(_sure(rule))}"), F.expr(placed))


def _sure(rule: Rule) -> str:
    """The pattern of a text that can have a long enough match: cheap to deny."""
    if rule.group == 0 and rule.least > 1 and rule.pattern.endswith("]+"):
        head = rule.pattern[:-1]
        fixed = len(head) - len(head[head.rindex("["):])
        return f"{head}{{{max(1, rule.least - fixed)},}}"
    return rule.pattern


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans: array of (start, ord, end, kind)), one row per row of ``docs``,
    in the order of start, then of the rules."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    nothing = "cast(array() as array<struct<start: int, ord: int, end: int, kind: string>>)"
    rows = pick(docs, doc=doc_col, text=text_col).select(
        F.col("doc").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    full = [F.coalesce(spans(r, i), F.expr(nothing)) for i, r in enumerate(rules) if r.kind not in indexed]
    trigrams = sorted({t for q in indexed.values() for clause in q for t in clause})
    postings = stage(posted(rows, trigrams), "secret-postings")
    chosen = candidates(postings, indexed).select(F.col("doc").alias("of"), F.col("digest").alias("like"), "kinds")
    found = [F.coalesce(F.when(F.array_contains("kinds", r.kind), spans(r, i)), F.expr(nothing)) for i, r in enumerate(rules) if r.kind in indexed]
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("like"))
    verified = rows.join(chosen, same).select("doc", "digest", F.concat(*found).alias("hits"))
    verified = stage(verified.where("size(hits) > 0").dropDuplicates(["doc", "digest"])
                     .select(F.col("doc").alias("of"), F.col("digest").alias("like"), "hits"), "secret-hits")
    scanned = rows.select("doc", "digest", (F.concat(*full) if full else F.expr(nothing)).alias("own"))
    return scanned.join(verified, same, "left").select(
        F.col("doc").alias("doc_id"), F.array_sort(F.concat("own", F.coalesce("hits", F.expr(nothing)))).alias("spans"))
