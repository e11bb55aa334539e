"""Licence texts as they are distributed: hard-wrapped, with titles, numbered clauses and comment marks."""

import random
import textwrap
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from gleaner.llm import licenses

MIT = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE.",
]
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
GPL = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY.",
]


def _wrap(parts, width, end="\n", mark=""):
    lines = [line for p in parts for line in [*textwrap.wrap(p, width, break_on_hyphens=False), ""]]
    return end.join((mark + line).rstrip() for line in lines)


def _scan(spark, texts):
    rows = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [(r.sentence_ids, r.licenses) for r in sorted(rows)]


def test_wrapped_texts(spark):
    layouts = [{"width": w} for w in (30, 72, 78, 10_000)] + [{"width": 78, "end": "\r\n"}, {"width": 70, "mark": "# "}, {"width": 70, "mark": " * "}]
    for parts, ids, name in ((MIT, ["mit-grant", "mit-notice", "mit-warranty"], "MIT"), (BSD, ["bsd-use", "bsd-source", "bsd-binary", "bsd-endorse"], "BSD-3-Clause"), (GPL, ["gpl-free", "gpl3-terms", "gpl-hope"], "GPL-3.0-or-later")):
        assert _scan(spark, [_wrap(parts, **x) for x in layouts]) == [(ids, [name])] * len(layouts)


def test_titles_and_paragraphs(spark):
    texts = [
        "MIT License\nCopyright (c) 2020 A B\n" + _wrap(MIT, 78),
        "The MIT License\n(MIT)\n\nText",
        "Released under\nthe MIT License",
        "Released under\n\nthe MIT License",
        "all\nrights\n---\nreserved",
        "we are released under the mit license",
        "Licensed under the Apache License, Version 2.0\nText P L of it",
    ]
    got = _scan(spark, texts)
    assert got[0] == (["mit-title", "mit-grant", "mit-notice", "mit-warranty"], ["MIT"])
    assert got[1:] == [(["mit-title-full"], ["MIT"]), (["mit-released"], ["MIT"]), (["mit-title-the"], ["MIT"]), ([], []), ([], []), (["apache-licensed"], ["Apache-2.0"])]


def _both(spark, texts):
    """The operator's rows and those of the SQL, which finds sentences by words and gaps, not by the operator's pattern."""
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    want = duckdb.connect().register("documents", documents).execute(licenses.OP5_SQL).fetchall()
    rows = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return sorted((r.doc_id, r.n_sentences, ",".join(r.sentence_ids), ",".join(r.licenses)) for r in rows), sorted(want)


def test_like_the_sql(spark):
    known = {i: s.replace(":", ";\n") for i, s in licenses.SENTENCES.items()}
    rng = random.Random(4)
    texts = [textwrap.fill(s, rng.choice([25, 60, 9999])).capitalize() + rng.choice(["", ".", ";", " ...", ".\n\n"]) for s in known.values()]
    texts += [rng.choice(["\n", "\n\n", ". ", " ", "\r\n# ", "\n \t\n"]).join(rng.sample(texts, 4)) for _ in range(80)]
    texts += ["// SPDX-License-Identifier: MIT\ncode", "SPDX-License-Identifier:\n Apache-2.0", "SPDX-License-Identifier: GPL-2.0 WITH x", "", None, ". . .\n", "MIT License" * 3]
    got, want = _both(spark, texts)
    assert got == want
    names = {r[0]: r[3] for r in got}
    assert [names[len(texts) - 7 + k] for k in range(3)] == ["MIT", "Apache-2.0", ""]
    assert all(r[2] == i for r, i in zip(got, known, strict=False) if "\n" not in texts[r[0]].strip())


WHOLE = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


def test_whole_texts_as_shipped(spark):
    found = [(n, p) for n in WHOLE if (p := Path("/usr/share/common-licenses", n)).exists()]
    if not found:
        pytest.skip("this machine has no licence texts")
    got, want = _both(spark, [p.read_text(errors="replace") for _, p in found])
    assert got == want and [r[3] for r in got] == [WHOLE[n] for n, _ in found]
