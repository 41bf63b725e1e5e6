import random
import textwrap

import pytest
from helpers import awkward

from rackpulse.llm import license_scan as X

ORDINARY = ["the", "of", "a", "river", "stone", "public", "version", "under", "free", "source", "this", "work", "is", "house", "code", "by", "software", "terms"]


def ordinary(rng, n=None):
    return " ".join(rng.choice(ORDINARY) for _ in range(n or rng.randrange(3, 40)))


@pytest.fixture(scope="module")
def corpus():
    rng, rows = random.Random(2), []
    notices = [(f, t) for f, own in X.TEMPLATES.items() for t in own]
    for i in range(300):
        lines, want = [ordinary(rng) for _ in range(rng.randrange(4))], set()
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            family, text = rng.choice(notices)
            want.add(family)
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", ordinary(rng, 5) + " "]) + rng.choice([text, text.upper(), text.replace(" ", "  ")]))
        rows.append((i, "\n".join(lines), ",".join(sorted(want))))
    return rows


def test_finds_notices_and_leaves_ordinary_text(spark, corpus):
    df = spark.createDataFrame([r[:2] for r in corpus], "doc_id long, text string").selectExpr("*", "1 as doc", "2 as norm", "'x' as Text")
    got = {r.doc_id: r for r in X.scan(df).collect()}
    assert len(got) == len(corpus)
    wrong = [(i, want, got[i].families) for i, _, want in corpus if got[i].families != want]
    assert len(wrong) <= 0.02 * len(corpus), wrong
    assert all(got[i].n_paragraphs == t.count("\n") + 1 for i, t, _ in corpus)
    assert not any(got[i].n_license for i, _, want in corpus if not want)


def test_awkward_rows(spark):
    got = X.scan(awkward(spark)).collect()
    assert len(got) == awkward(spark).count() and not any(r.n_license for r in got)
    assert X.scan(awkward(spark).limit(0)).count() == 0
    notice = X.TEMPLATES["mit"][1]
    twice = spark.createDataFrame([(None, notice)] * 2 + [(1, notice + "\n" + notice)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_license, r.families) for r in X.scan(twice).collect()) == [("1", 2, "mit"), ("None", 1, "mit"), ("None", 1, "mit")]


def test_template_comparison(spark):
    text = X.TEMPLATES["bsd"][1]
    cut = " ".join(text.split()[:18])
    rows = spark.createDataFrame([(text,), ("x " + text.upper() + " y",), (cut,), ("nothing of it",)], "t string")
    from pyspark.sql import functions as F
    got = [r.s for r in rows.select(X.likeness(X.normal(F.col("t")), text).alias("s")).collect()]
    shingles = len(text.replace(",", "").split()) - 4
    assert got == [1.0, 1.0, pytest.approx(14 / shingles), 0.0]


HEADERS = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}


def test_wrapped_headers_are_confirmed(spark):
    rng, rows, want = random.Random(5), [], {}
    for family, text in HEADERS.items():
        for width in (60, 70, 80):
            for mark in ("", "# ", " * "):
                header = textwrap.fill(" ".join(text.split()), width, initial_indent=mark, subsequent_indent=mark)
                want[len(rows)] = family
                rows.append((len(rows), "\n\n".join([ordinary(rng), header, ordinary(rng)])))
    for _ in range(100):
        rows.append((len(rows), "\n".join(ordinary(rng) for _ in range(4))))
    got = {r.doc_id: r for r in X.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(i, f, got[i].families) for i, f in want.items() if (got[i].families, got[i].n_license) != (f, 1)] == []
    assert not any(got[i].n_license for i, _ in rows if i not in want)


def test_a_blank_line_ends_a_notice(spark):
    head, tail = X.TEMPLATES["mit"][1][:60], X.TEMPLATES["mit"][1][60:]
    rows = [(1, head + "\n" + tail), (2, head + "\n  \n" + tail), (3, "a line\n" * 200 + head + "\n" + tail + "\nanother" * 200)]
    got = {r.doc_id: (r.families, r.n_license) for r in X.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("mit", 1), 2: ("", 0), 3: ("mit", 1)}


def test_every_family_of_a_line_is_confirmed(spark):
    rng, notice = random.Random(6), {f: own[1] for f, own in X.TEMPLATES.items() if len(own) > 1}
    pairs = [(a, b) for a in notice for b in notice if a < b and not {a, b} <= {"cc-by-4.0", "cc-by-nc-4.0"}]
    rows = [(i, f"{notice[a]} or {notice[b]}") for i, (a, b) in enumerate(pairs)]
    long = " ".join([ordinary(rng, 3000), notice["mit"], ordinary(rng, 71), notice["bsd"], ordinary(rng, 2000)])
    rows += [(1000, long)] + [(2000 + i, ordinary(rng)) for i in range(100)]
    got = {r.doc_id: (r.families, r.n_license) for r in X.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(i, p, got[i]) for i, p in enumerate(pairs) if got[i] != (",".join(p), 1)] == []
    assert got[1000] == ("bsd,mit", 1)


def test_pieces_lose_no_words(spark):
    from pyspark.sql import functions as F
    for n in (1, 16, 17, 80, 81, 144, 145, 1000):
        own = [str(i) for i in range(n)]
        got = spark.createDataFrame([(own,)], "w array<string>").select(X.pieces(F.col("w")).alias("p")).first().p
        runs = {tuple(own[i: i + 16]) for i in range(max(1, n - 15))}
        assert {tuple(p[i: i + 16]) for p in got for i in range(max(1, len(p) - 15))} >= runs


#: Wordings that are not templates as they stand.
OTHERS = {
    "mit": ["Distributed under the MIT License", "SPDX-License-Identifier: MIT", "This project is available under the terms of the MIT license."],
    "gpl-3.0": ["This file is part of Stone. Stone is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, version 3 of the License.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
             "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
             "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "apache-2.0": ["The code is made available under the Apache License 2.0, see LICENSE", "// SPDX-License-Identifier: Apache-2.0"],
    "isc": ["Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
            "notice and this permission notice appear in all copies.", "Distributed under the ISC license"],
    "cc0-1.0": ["To the extent possible under law, the author has dedicated this under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "cc-by-sa-4.0": ["The text is shared under CC BY-SA 4.0", "Except where noted, content is under a Creative Commons Attribution-ShareAlike 4.0 license"],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org"],
    "bsd": ["# SPDX-License-Identifier: BSD-3-Clause", "Distributed under the BSD 3-Clause License"],
    "mpl-2.0": ["Distributed under the Mozilla Public License 2.0"],
}


def test_wordings_that_are_not_templates(spark):
    rng, rows, want = random.Random(7), [], {}
    for family, own in OTHERS.items():
        for text in own:
            for shown in (text, textwrap.fill(text, 60), ordinary(rng, 12) + "\n" + text):
                want[len(rows)] = family
                rows.append((len(rows), shown))
    rows += [(len(rows) + i, ordinary(rng)) for i in range(200)]
    got = {r.doc_id: r for r in X.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(rows[i][1], f, got[i].families) for i, f in want.items() if got[i].families != f] == []
    assert not any(r.n_license for i, r in got.items() if i not in want)


def test_tables_are_one_constant(spark):
    from pyspark.sql import functions as F
    rng = random.Random(8)
    table = {f'w{i} "x\\': [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-20, 20) for _ in range(14)] for i in range(600)}
    held = X._by_hash(table, "array<double>")
    words = spark.createDataFrame([(w,) for w in [*table, "none"]], "w string")
    got = dict(words.select("w", X._looked_up(held, F.col("w")).alias("v")).collect())
    assert got == {**table, "none": None}
