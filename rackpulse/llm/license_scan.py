"""License scans: a trained paragraph classifier confirmed by templates.

A paragraph is a line of a text; a block is a run of lines up to a blank one,
within which a notice may be hard-wrapped. A paragraph's features are the different word unigrams
and bigrams it shares with the licence templates (a bounded vocabulary). One
logistic regression per licence family is trained by full-batch descent steps
(each bounded by a diagonal majorant of the curvature, so the loss never
grows), on

* each template, whole, in part (runs of ``part`` of its words, and of ``row``
  words as a wrapped line has them), amid words of ordinary paragraphs and
  beside a template of each other family, and
* a bounded sample of ``sample`` corpus paragraphs as the unknown class
  (in the order of a hash of their text, without those that hold a template
  or of which half is from one).

A long paragraph is judged in pieces of ``PIECE`` words, which overlap, and
compared whole, with the templates of every family: it may hold two notices,
and notices of related licences differ by a word.

The unknown class is calibrated: a paragraph is unknown unless a family's
probability in one of its pieces reaches the threshold half way between what nearly all unknown
sample paragraphs stay under and what nearly all template paragraphs reach.
What reaches it is confirmed if it holds 0.8 of the five-word shingles of one
of a family's templates (all its words, if it has fewer) and what ``NEEDED``
asks of the family, or if its block
does: its lines, ``SIDE`` to either side at least, read as one text. The rest
is reported as unconfirmed. As a line of a wrapped notice shows but a part of
it, and one of two notices is less likely, a line that reaches what nearly all
template paragraphs reach for their families is compared too, and counts if
confirmed.

``n_license`` counts paragraphs that hold a notice alone, and besides them,
once a block and family, notices that run over lines.

Training and scoring are DataFrame operations only. Scoring is one pass without
a shuffle of texts: only lines with a prediction are grouped afterwards.

Words: A-Z lower-cased, then runs of a-z and 0-9.

Defined results:

* a null or empty text is one paragraph without a licence;
* rows are judged one by one: repeated rows give repeated results; a null
  doc_id is carried through;
* a corpus without ordinary paragraphs trains on the templates alone;
* an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stage

#: Wordings of well-known public licences, by family: short
#: notices (the verb before them is free), the usual header or first sentence,
#: and SPDX lines.
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "under the Apache License 2.0", "under the Apache 2.0 License", "under the terms of the Apache License", "Apache License Version 2.0, January 2004",
                   "SPDX-License-Identifier: Apache-2.0",
                   "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "under the MIT License", "under the terms of the MIT License", "under an MIT license", "The MIT License (MIT)", "SPDX-License-Identifier: MIT",
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License",
                "under the GNU General Public License v3", "under the GNU GPL version 3", "under the GPLv3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
                "SPDX-License-Identifier: GPL-3.0"),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License",
                "under the GNU General Public License v2", "under the GNU GPL version 2", "under the GPLv2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
                "SPDX-License-Identifier: GPL-2.0"),
    "lgpl": ("licensed under the GNU Lesser General Public License",
             "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "under the LGPL", "under the GNU LGPL", "GNU LESSER GENERAL PUBLIC LICENSE Version", "SPDX-License-Identifier: LGPL"),
    "agpl": ("licensed under the GNU Affero General Public License",
             "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             "under the AGPL", "under the GNU AGPL", "under the AGPLv3", "GNU AFFERO GENERAL PUBLIC LICENSE Version", "SPDX-License-Identifier: AGPL"),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                     "under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0", "creativecommons.org/licenses/by-nc/4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                     "under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0", "creativecommons.org/licenses/by-sa/4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "cc-by-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License.",
                  "under CC BY 4.0", "Creative Commons Attribution 4.0", "creativecommons.org/licenses/by/4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    "cc0-1.0": ("Released under CC0 1.0.",
                "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
                "CC0 1.0 Universal", "under the CC0 license", "under CC0", "creativecommons.org/publicdomain/zero/1.0", "SPDX-License-Identifier: CC0-1.0"),
    "bsd": ("Released under the BSD License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "under the BSD License", "under a BSD-style license", "under the BSD 2-Clause License", "under the BSD 3-Clause License", "under the terms of the BSD license",
            "SPDX-License-Identifier: BSD"),
    "isc": ("Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
            "under the ISC License", "under the terms of the ISC License", "SPDX-License-Identifier: ISC"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "under the Mozilla Public License 2.0", "under the Mozilla Public License, version 2.0", "under the MPL 2.0",
                "subject to the terms of the Mozilla Public License", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "epl-2.0": ("under the Eclipse Public License 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
                "under the Eclipse Public License v2.0", "under the EPL 2.0", "Eclipse Public License v 2.0", "SPDX-License-Identifier: EPL-2.0"),
}
#: What a confirmed text must hold besides: wordings that differ by a word or two
#: share most shingles.
NEEDED = {
    "gpl-3.0": r" gnu (gpl|general public license)( as published by the free software foundation)?( either)? (version 3|v 3|v3) | gplv3 | identifier gpl 3 ",
    "gpl-2.0": r" gnu (gpl|general public license)( as published by the free software foundation)?( either)? (version 2|v 2|v2) | gplv2 | identifier gpl 2 ",
    "lgpl": r" lesser general public license | lgpl ",
    "agpl": r" affero general public license | agpl(v3)? ",
}
SHINGLE, ALIKE = 5, 0.8
BUCKETS = 512
PIECE, STEP = 80, 64  # words of a piece of a long line, and from one piece to the next
LINES, SIDE = 32, 40  # lines that share one surrounding text, and how many more it has to either side


@dataclass
class Model:
    """``weights``: per gram one weight a family; ``bias`` and ``families`` in the same order."""

    families: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    threshold: float
    faint: float = 0.0  # from here on a paragraph is compared with templates


def normal(text: Column) -> Column:
    """The words of a text, each between single spaces (also at both ends)."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " ")), F.lit(" "))


def words(normalised: Column) -> Column:
    return F.split(F.trim(normalised), " ")


def constant(value: object, kind: str) -> Column:
    """A nested constant as one JSON text, which Spark reads once a plan: as an
    expression a value, each of its copies fills the driver's memory."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _by_hash(values: dict[str, object], kind: str) -> Column:
    """The map of grams in ``BUCKETS`` small maps: a look-up in a map reads all its keys."""
    maps = [{} for _ in range(BUCKETS)]
    for gram, value in values.items():
        maps[_bucket(gram)][gram] = value
    return constant(maps, f"array<map<string,{kind}>>")


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def _looked_up(table: Column, gram: Column) -> Column:
    """Null if the table lacks the gram."""
    return F.try_element_at(F.element_at(table, (F.crc32(gram.cast("binary")) % BUCKETS + 1).cast("int")), gram)


def present(own: Column, vocabulary: list[str]) -> Column:
    """The different word unigrams and bigrams of an array of words that the vocabulary has."""
    table = _by_hash(dict.fromkeys(vocabulary, True), "boolean")
    pairs = F.zip_with(own, F.slice(own, F.lit(2), F.size(own)), lambda a, b: F.concat(a, F.lit(" "), b))  # the last one null
    return F.array_distinct(F.filter(F.concat(own, pairs), lambda g: _looked_up(table, g).isNotNull()))


def once(column: Column) -> Column:
    """The column behind a generator, so that filters on it do not compute it again."""
    return F.explode(F.array(column))


def _plain(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _vocabulary(templates: dict[str, tuple[str, ...]]) -> list[str]:
    out = set()
    for own in templates.values():
        for text in own:
            w = _plain(text)
            out |= {*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))}
    return sorted(out)


def _shingles(text: str) -> list[str]:
    w = _plain(text)
    return [" ".join(w[i: i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))]


def likeness(normalised: Column, template: str) -> Column:
    """Share of the template's shingles that a normalised paragraph holds."""
    own = _shingles(template)
    held = sum((F.when(normalised.contains(f" {s} "), 1).otherwise(0) for s in own), F.lit(0))
    return held / float(len(own))


def _known(templates: dict[str, tuple[str, ...]]) -> Column:
    """Array of struct(family, shingles), a struct a template."""
    return constant([{"family": f, "shingles": [f" {s} " for s in _shingles(t)]} for f, own in templates.items() for t in own],
                    "array<struct<family:string,shingles:array<string>>>")


def _held(normalised: Column, template: Column) -> Column:
    """Number of a template's shingles that the normalised text holds."""
    return F.aggregate(template.shingles, F.lit(0), lambda n, s: n + normalised.contains(s).cast("int"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc, digest, block, pos, around, line, norm) of the lines of documents (doc, digest, text).

    ``around``: the line amid its block, of which a long one is read in parts
    that overlap by ``SIDE`` lines, so that rows stay bounded.
    """
    blocks = docs.select("doc", "digest", F.posexplode(F.split("text", r"\n\s*\n", -1)).alias("block", "own"))
    blocks = blocks.select("doc", "digest", "block", F.split("own", "\n", -1).alias("lines"))
    parts = blocks.withColumn("at", F.explode(F.expr(f"sequence(0, size(lines) - 1, {LINES})")))
    parts = parts.select("doc", "digest", "block", "at", F.expr(f"slice(lines, at + 1, {LINES})").alias("own"),
                         F.expr(f"array_join(slice(lines, greatest(at - {SIDE}, 0) + 1, {LINES + 2 * SIDE}), ' ')").alias("around"))
    lines = parts.select("doc", "digest", "block", "at", "around", F.posexplode("own").alias("n", "line"))
    return lines.select("doc", "digest", "block", (F.col("at") + F.col("n")).alias("pos"), "around", "line", normal(F.col("line")).alias("norm"))


def _borrowed(own: Column, templates: dict[str, tuple[str, ...]]) -> Column:
    """Share of the five-word shingles of an array of words that are in a template (all its words, if it has fewer)."""
    known = [" " + " ".join(_plain(t)) + " " for texts in templates.values() for t in texts]
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size(own) - SHINGLE + 1, F.lit(1))), lambda i: F.concat(F.lit(" "), F.array_join(F.slice(own, i, SHINGLE), " "), F.lit(" ")))
    return F.size(F.filter(shingles, lambda s: F.exists(constant(known, "array<string>"), lambda t: t.contains(s)))) / F.size(shingles)


def _examples(lines: DataFrame, templates: dict[str, tuple[str, ...]], sample: int, part: float, row: int) -> DataFrame:
    """(id, family, other, grams) of the training paragraphs; family null: unknown; other: a second family."""
    held = F.exists(_known(templates), lambda t: _held(F.col("norm"), t) >= 0.5 * F.size(t.shingles))
    drawn = (lines.select("norm").where("norm <> '  '").withColumn("turn", F.xxhash64("norm")).orderBy("turn", "norm").limit(2 * sample)
             .distinct().where(~held & (_borrowed(words(F.col("norm")), templates) < 0.5)).orderBy("turn", "norm").limit(sample))
    drawn = stage(drawn.select(words(F.col("norm")).alias("words"), F.row_number().over(Window.orderBy("turn", "norm")).alias("n")), "license-sample")
    given = [{"family": f, "words": _plain(t)} for f, own in templates.items() for t in own]
    whole = lines.sparkSession.range(1).select(F.explode(constant(given, "array<struct<family:string,words:array<string>>>")).alias("r")).select("r.family", "r.words")
    size = F.ceil(F.size("words") * part).cast("int")
    runs = (whole.withColumn("size", size).withColumn("at", F.explode(F.expr("sequence(1, size(words) - size + 1)")))
            .select("family", F.expr("slice(words, at, size)").alias("words")))
    rows = (whole.where(F.size("words") > 2 * row).withColumn("at", F.explode(F.expr(f"sequence(1, size(words) - {row - 1}, {max(1, row // 2)})")))
            .select("family", F.expr(f"slice(words, at, {row})").alias("words")))
    amid = (whole.withColumn("n", F.explode(F.array(*map(F.lit, range(1, 5)))))  # each template in four ordinary paragraphs
            .join(drawn.withColumnRenamed("words", "around"), "n")
            .select("family", F.concat(F.slice("around", 1, 8), "words", F.slice("around", -1, 1)).alias("words")))
    sides = {f: (min(own, key=len), max(own, key=len)) for f, own in templates.items()}
    pairs = [{"family": a, "other": b, "words": _plain(x + " " + y)}
             for a in sides for b in sides if a < b for x, y in dict.fromkeys(zip(sides[a], sides[b], strict=True))]
    marked = whole.unionByName(runs).unionByName(rows).unionByName(amid).withColumn("other", F.lit(None).cast("string"))
    if pairs:
        both = constant(pairs, "array<struct<family:string,other:string,words:array<string>>>")
        marked = marked.unionByName(lines.sparkSession.range(1).select(F.explode(both).alias("r")).select("r.*"))
    none = F.lit(None).cast("string")
    both = marked.unionByName(drawn.select(none.alias("family"), none.alias("other"), "words"))
    return both.select(F.monotonically_increasing_id().alias("id"), "family", "other", present(F.col("words"), _vocabulary(templates)).alias("grams"))


def fit(lines: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, sample: int = 2000, part: float = 0.7, row: int = 10,
        steps: int = 30, ridge: float = 0.02) -> Model:
    """Train on templates and a bounded sample of paragraphs (``norm``)."""
    families = list(templates)
    table = stage(_examples(lines, templates, sample, part, row), "license-training").select("id", "family", "other", F.concat("grams", F.array(F.lit(""))).alias("grams"))
    n = {r.of: r["count"] for r in table.select(F.explode(F.array("family", "other")).alias("of")).groupBy("of").count().collect()}  # a row a family
    total = table.count()
    # one row an example and family; positives weigh as much as all the others together
    each = (table.select("id", "family", "other", "grams", F.explode(F.array(*map(F.lit, families))).alias("of"))
            .withColumn("y", (F.col("family").eqNullSafe(F.col("of")) | F.col("other").eqNullSafe(F.col("of"))).cast("double"))
            .withColumn("v", F.when(F.col("y") == 1, F.coalesce(*[F.when(F.col("of") == f, 0.5 * total / n[f]) for f in families]))
                        .otherwise(F.coalesce(*[F.when(F.col("of") == f, 0.5 * total / max(1, total - n[f])) for f in families]))))
    flat = stage(each.select("id", "of", "y", "v", F.size("grams").alias("size"), F.explode("grams").alias("gram")), "license-cells").coalesce(1)
    # examples, families and vocabulary are all bounded: the steps run in one partition, without shuffles
    weights = stage(flat.groupBy("of", "gram").agg((0.25 * F.sum(F.col("v") * F.col("size")) + ridge * total / 100).alias("bend")).withColumn("w", F.lit(0.0)), "license-weights").coalesce(1)
    for _ in range(steps):
        margins = flat.join(F.broadcast(weights.select("of", "gram", "w")), ["of", "gram"]).groupBy("id", "of").agg(F.sum("w").alias("m"))  # families by vocabulary, bounded
        wrong = margins.withColumn("p", 1 / (1 + F.exp(-F.col("m")))).drop("m")
        slopes = (flat.join(wrong, ["id", "of"]).groupBy("of", "gram").agg(F.sum(F.col("v") * (F.col("p") - F.col("y"))).alias("slope")))
        weights = stage(weights.join(slopes, ["of", "gram"]).select(
            "of", "gram", "bend", (F.col("w") - (F.col("slope") + ridge * total / 100 * F.col("w")) / F.col("bend")).alias("w")), "license-weights").coalesce(1)
    found = {f: {} for f in families}
    for r in weights.collect():  # families by vocabulary
        found[r.of][r.gram] = r.w
    own = Model(families, {g: [found[f].get(g, 0.0) for f in families] for g in _vocabulary(templates)}, [found[f].get("", 0.0) for f in families], 0.5)
    shown = table.select("family", "other", _named(own, F.filter("grams", lambda g: g != "")).alias("named")).select(
        "family", F.array_max("named.p").alias("p"),
        F.array_min(F.filter("named", lambda x: x.family.eqNullSafe(F.col("family")) | x.family.eqNullSafe(F.col("other")))).getField("p").alias("own"))
    cut = shown.agg(F.percentile(F.when(F.col("family").isNull(), F.col("p")), 0.999).alias("most"),
                    F.percentile(F.when(F.col("family").isNotNull(), F.col("p")), 0.05).alias("few"), F.percentile("own", 0.01).alias("least")).first()
    own.threshold = ((cut.most or 0.0) + (cut.few or 1.0)) / 2
    own.faint = min(own.threshold, cut.least or 1.0)
    return own


def _named(model: Model, present: Column) -> Column:
    """Array of struct(p, family), of every family."""
    table = _by_hash(model.weights, "array<double>")
    margins = F.aggregate(present, F.array(*map(F.lit, model.bias)), lambda a, g: F.zip_with(a, _looked_up(table, g), lambda x, y: x + y))
    return F.zip_with(margins, F.array(*map(F.lit, model.families)),
                      lambda m, f: F.struct((1 / (1 + F.exp(-m))).alias("p"), f.alias("family")))


def pieces(own: Column) -> Column:
    """An array of words in pieces of ``PIECE`` words that overlap by ``PIECE - STEP``."""
    at = F.sequence(F.lit(1), F.greatest(F.size(own) - (PIECE - STEP), F.lit(1)), F.lit(STEP))
    return F.transform(at, lambda i: F.slice(own, i, PIECE))


def confirmed(normalised: Column, templates: dict[str, tuple[str, ...]]) -> Column:
    """The families of which the normalised text holds a template and what is ``NEEDED``."""
    found = F.filter(_known(templates), lambda t: _held(normalised, t) >= ALIKE * F.size(t.shingles))
    found = F.array_distinct(F.transform(found, lambda t: t.family))
    lacking = [F.when(~normalised.rlike(r), F.lit(f)) for f, r in NEEDED.items()]
    return F.when(F.size(found) > 0, F.array_except(found, F.array(*lacking))).otherwise(found)


def _counted(checked: DataFrame) -> DataFrame:
    """(of, like, n_license, n_unconfirmed, families, best), a row a document with predicted lines.

    ``checked``: (doc, digest, block, pos, p, own, wide), the families a line
    holds and those its block holds; repeated rows count once.
    """
    sure = F.size("own") > 0
    blocks = checked.groupBy("doc", "digest", "block").agg(
        F.size(F.collect_set(F.when(sure, F.col("pos")))).alias("alone"),
        F.array_distinct(F.flatten(F.collect_set("own"))).alias("own"), F.array_distinct(F.flatten(F.collect_set("wide"))).alias("wide"),
        F.size(F.array_except(F.collect_set("pos"), F.collect_set(F.when(sure | (F.size("wide") > 0), F.col("pos"))))).alias("open"), F.max("p").alias("p"))
    return (blocks.groupBy("doc", "digest").agg(
        F.sum(F.col("alone") + F.size(F.array_except("wide", "own"))).alias("n_license"), F.sum("open").alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_union("own", "wide"))))), ",").alias("families"), F.max("p").alias("best"))
        .select(F.col("doc").alias("of"), F.col("digest").alias("like"), "n_license", "n_unconfirmed", "families", "best"))


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, doc_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """(doc_id, n_paragraphs, n_license, n_unconfirmed, families, best), one row per row of ``docs``.

    ``families``: those confirmed, in order, joined by commas; ``best``: the
    largest probability among the predicted paragraphs (0 if none is).
    """
    rows = pick(docs, doc=doc_col, text=text_col).select(F.col("doc").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    lines = paragraphs(rows)
    model = fit(lines, templates, **training)
    parts = lines.withColumn("words", once(words(F.col("norm")))).withColumn("piece", F.explode(pieces(F.col("words")))).drop("words")
    judged = (parts.withColumn("present", once(present(F.col("piece"), list(model.weights)))).where("size(present) > 0")
              .withColumn("p", once(F.array_max(_named(model, F.col("present"))).getField("p"))).where(F.col("p") >= model.faint))
    judged = (judged.withColumn("wide", once(normal(F.col("around"))))
              .select("doc", "digest", "block", "pos", "norm", "wide", "p"))
    checked = judged.withColumn("own", once(confirmed(F.col("norm"), templates))).withColumn("wide", once(confirmed(F.col("wide"), templates)))
    told = _counted(checked.where((F.col("p") >= model.threshold) | (F.size("own") > 0) | (F.size("wide") > 0)))
    count = rows.select("doc", "digest", F.size(F.split("text", "\n", -1)).cast("long").alias("n_paragraphs"))
    return (count.join(told, F.col("doc").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("like")), "left")
            .select(F.col("doc").alias("doc_id"), "n_paragraphs", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_license", "n_unconfirmed")],
                    F.coalesce("families", F.lit("")).alias("families"), F.coalesce("best", F.lit(0.0)).alias("best")))
