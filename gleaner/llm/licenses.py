"""License scans by sentence rules.

Texts are cut into sentences, sentences are normalised (lower-cased A-Z, runs of
anything but a-z and 0-9 to a space) and mapped to identifiers of known licence
sentences. Unknown sentences drop out; what is left is a sequence of
identifiers, which is matched against ordered rules: each rule is a sequence of
identifiers, the first rule that occurs takes its sentences, and so on.

A sentence ends at a mark with white space after it, at a blank line, or at a
line's end; over a line's end inside a paragraph it may also go on, for licences
are hard-wrapped. Texts without any of a few stems that every known sentence
holds one of aren't looked at closely.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import ascii_lower, table

# SPDX identifiers that a tag may name.
SPDX = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "NCSA", "OFL-1.1", "PostgreSQL", "PSF-2.0", "Unlicense", "UPL-1.0", "WTFPL", "Zlib",
]

# Sentences of well-known licences and notices, normalised.
SENTENCES: dict[str, str] = {
    "mit-title": "mit license",
    "mit-title-the": "the mit license",
    "mit-title-full": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit0-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "isc-title": "isc license",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "bsd-use": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-advertising": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-university": "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd2-title": "bsd 2 clause license",
    "bsd3-title": "bsd 3 clause license",
    "apache-title": "apache license version 2 0 january 2004",
    "apache-definition": "license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl3-preamble": "the gnu general public license is a free copyleft license for software and other kinds of works",
    "gpl3-licensed": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl3-terms-semicolon": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation: either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl2-terms-semicolon": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation: either version 2 of the license or at your option any later version",
    "gpl2-only-terms": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3-only-terms": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl3-incorporates": "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below",
    "lgpl-free": "this library is free software",
    "lgpl21-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl21-terms-semicolon": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation: either version 2 1 of the license or at your option any later version",
    "lgpl3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3-terms-semicolon": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation: either version 3 of the license or at your option any later version",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "agpl3-preamble": "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software",
    "agpl3-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-terms-semicolon": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation: either version 3 of the license or at your option any later version",
    "gfdl13-title": "gnu free documentation license version 1 3 3 november 2008",
    "mpl2-title": "mozilla public license version 2 0",
    "mpl2-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl2-copy-https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl11-title": "mozilla public license version 1 1",
    "mpl11-header": "the contents of this file are subject to the mozilla public license version 1 1 the license",
    "epl1-title": "eclipse public license v 1 0",
    "epl2-title": "eclipse public license v 2 0",
    "epl1-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "epl2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "wtfpl-title": "do what the fuck you want to public license version 2 december 2004",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl-title": "boost software license version 1 0 august 17th 2003",
    "bsl-licensed": "distributed under the boost software license version 1 0",
    "artistic1-title": "the artistic license",
    "artistic2-title": "the artistic license 2 0",
    "cddl1-title": "common development and distribution license cddl version 1 0",
    "eupl12-title": "european union public licence v",
    "eupl-licensed": "licensed under the eupl",
    "mspl-title": "microsoft public license ms pl",
    "ncsa-title": "university of illinois ncsa open source license",
    "ofl-title": "sil open font license version 1 1 26 february 2007",
    "ofl-licensed": "this font software is licensed under the sil open font license version 1 1",
    "postgresql-grant": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "psf-title": "python software foundation license version 2",
    "upl-title": "the universal permissive license upl version 1 0",
    "cc-by-title": "creative commons attribution 4 0 international public license",
    "cc-by-sa-title": "creative commons attribution sharealike 4 0 international public license",
    "cc-by-nc-title": "creative commons attribution noncommercial 4 0 international public license",
    "cc-by-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-licensed": "licensed under cc by 4 0",
    "cc-by-sa-licensed": "licensed under cc by sa 4 0",
    "cc-by-nc-licensed": "licensed under cc by nc 4 0",
    "cc0-title": "cc0 1 0 universal",
    "cc0-waiver": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "all-rights": "all rights reserved",
    # a tag's colon ends a sentence; a mark in a known sentence stands for such an end within it
    **{f"spdx-{x}": "spdx license identifier: " + re.sub("[^a-z0-9]+", " ", x.lower()) for x in SPDX},
}

# Rules in their order, whole texts before notices.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT-0", ["mit0-grant", "mit-warranty"]),
    ("BSD-4-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-advertising"]),
    ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-endorse-university"]),
    ("BSD-2-Clause", ["bsd-use", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-title", "apache-definition"]),
    ("Apache-2.0", ["apache-header", "apache-use", "apache-copy"]),
    # the whole texts end with a model of the notice
    ("GPL-3.0-only", ["gpl3-title", "gpl3-preamble", "gpl-free", "gpl3-terms", "gpl-hope"]),
    ("GPL-3.0-only", ["gpl3-title", "gpl3-preamble"]),
    ("GPL-2.0-only", ["gpl2-title", "gpl-free", "gpl2-terms", "gpl-hope"]),
    ("GPL-2.0-only", ["gpl2-title", "gpl-free", "gpl2-terms-semicolon", "gpl-hope"]),
    ("GPL-2.0-only", ["gpl2-title"]),
    ("LGPL-2.1-only", ["lgpl21-title", "lgpl-free", "lgpl21-terms"]),
    ("LGPL-2.1-only", ["lgpl21-title", "lgpl-free", "lgpl21-terms-semicolon"]),
    ("LGPL-2.1-only", ["lgpl21-title"]),
    ("LGPL-3.0-only", ["lgpl3-title", "lgpl3-incorporates"]),
    ("AGPL-3.0-only", ["agpl3-title", "agpl3-preamble", "gpl-free", "agpl3-terms", "gpl-hope"]),
    ("AGPL-3.0-only", ["agpl3-title"]),
    ("GFDL-1.3", ["gfdl13-title"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms-semicolon"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms-semicolon"]),
    ("GPL-2.0-only", ["gpl-free", "gpl2-only-terms"]),
    ("GPL-3.0-only", ["gpl-free", "gpl3-only-terms"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-terms"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-terms-semicolon"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl21-terms"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl21-terms-semicolon"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "lgpl3-terms"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "lgpl3-terms-semicolon"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Zlib", ["zlib-warranty", "zlib-grant"]),
    ("MPL-2.0", ["mpl2-form", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-form", "mpl2-copy-https"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-grant-and"]),
    ("0BSD", ["0bsd-grant"]),
    ("PostgreSQL", ["postgresql-grant"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-title"]),
    ("GPL-3.0-only", ["gpl3-licensed"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("MPL-1.1", ["mpl11-title"]),
    ("MPL-1.1", ["mpl11-header"]),
    ("EPL-1.0", ["epl1-title"]),
    ("EPL-2.0", ["epl2-title"]),
    ("EPL-1.0", ["epl1-terms"]),
    ("EPL-2.0", ["epl2-terms"]),
    ("Unlicense", ["unlicense-free"]),
    ("WTFPL", ["wtfpl-title"]),
    ("BSL-1.0", ["bsl-title"]),
    ("BSL-1.0", ["bsl-licensed"]),
    ("Artistic-1.0", ["artistic1-title"]),
    ("Artistic-2.0", ["artistic2-title"]),
    ("CDDL-1.0", ["cddl1-title"]),
    ("EUPL-1.2", ["eupl12-title"]),
    ("EUPL-1.2", ["eupl-licensed"]),
    ("MS-PL", ["mspl-title"]),
    ("NCSA", ["ncsa-title"]),
    ("OFL-1.1", ["ofl-title"]),
    ("OFL-1.1", ["ofl-licensed"]),
    ("PSF-2.0", ["psf-title"]),
    ("UPL-1.0", ["upl-title"]),
    ("CC-BY-4.0", ["cc-by-title"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-title"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-title"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-long"]),
    ("CC-BY-4.0", ["cc-by-licensed"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-licensed"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-licensed"]),
    ("CC0-1.0", ["cc0-title"]),
    ("CC0-1.0", ["cc0-waiver"]),
    ("BSD-2-Clause", ["bsd2-title"]),
    ("BSD-3-Clause", ["bsd3-title"]),
    ("ISC", ["isc-title"]),
    ("MIT", ["mit-title-full"]),
    ("MIT", ["mit-title-the"]),
    ("MIT", ["mit-title"]),
    *[(x, [f"spdx-{x}"]) for x in SPDX],
]

#: Each known sentence holds one of these.
STEMS = ("licen", "softw", "warrant", "permi", "redistribut", "copyright", "reserv", "cc0", "mpl")

# In a text without A-Z these letters mark where it is cut: P for good, L at a line's end inside a paragraph.
_SENTENCE_END = r"[.!?;:]+[ \t\r\n]+|[.!?;:]+$"
_CUT = _SENTENCE_END + r"|[\r\n]+"
_BLANK = r"(?>\r\n|\r|\n)[^a-z0-9P]*(?>\r\n|\r|\n)"


def _marked(low: Column) -> Column:
    """Normalised text with its cuts: a sentence's end or lines without letters and digits (P), any other line's end (L)."""
    out = low
    for pattern, mark in ((_SENTENCE_END, " P "), (_BLANK, " P "), (r"[\r\n]+", " L "), ("[^a-z0-9PL]+", " ")):
        out = F.regexp_replace(out, pattern, mark)
    return F.concat(F.lit("P "), out, F.lit(" P"))


def _wrapped(known: dict[str, str]) -> str:
    """Matches known sentences from cut to cut, the longest first, over any line ends within."""
    longest = sorted(known.values(), key=lambda s: -len(s))
    return f"(?<=[PL] {{1,2}})(?:{'|'.join(' (?:L )?'.join(map(re.escape, s.replace(':', ' P').split())) for s in longest)})(?= {{1,2}}[PL])"


def license_scan(docs: DataFrame, known: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licenses``, a row per document.

    ``sentence_ids`` are the known sentences in their order, with repetitions;
    ``licenses`` the distinct licences in the order of the rules that matched.
    Null and empty texts have no sentences. Rows that repeat an id each get a
    row. Sentences are known whether or not they are wrapped over the lines of a
    paragraph; ``n_sentences`` counts what lies between cuts, with each line's end
    as a cut. Other columns are ignored.
    """
    known, rules = known or SENTENCES, rules or RULES
    stems = STEMS if known is SENTENCES else ("",)
    ids = F.create_map(*[F.lit(x) for i, s in known.items() for x in (s.replace(":", " P"), i)])
    low = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("low"))
    hits = F.regexp_extract_all(_marked(F.col("low")), F.lit(_wrapped(known)), F.lit(0))
    hits = F.when(reduce(or_, [F.contains("low", F.lit(x)) for x in stems]), hits).otherwise(F.array().cast("array<string>"))
    n = F.size(F.filter(F.split("low", _CUT), lambda x: x.rlike("[a-z0-9]"))).cast("long")
    found = low.select("doc_id", n.alias("n_sentences"), F.transform(hits, lambda x: ids[F.replace(x, F.lit(" L"), F.lit(""))]).alias("ids"))
    found = found.withColumn("seq", F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    table_of_rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in seq)).alias("seq")) for name, seq in rules])

    def step(a: Column, r: Column) -> Column:
        hit = F.contains(a["seq"], r["seq"])
        return F.struct(F.when(hit, F.replace(a["seq"], r["seq"], F.lit("#"))).otherwise(a["seq"]).alias("seq"), F.when(hit, F.concat(a["found"], F.array(r["name"]))).otherwise(a["found"]).alias("found"))

    start = F.struct(F.col("seq").alias("seq"), F.array().cast("array<string>").alias("found"))
    names = F.when(F.col("seq") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.aggregate(table_of_rules, start, step)["found"]))
    return found.select("doc_id", "n_sentences", F.col("ids").alias("sentence_ids"), names.alias("licenses"))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """``license_scan`` of whole ``documents``, lists joined by commas."""
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


_STEPS = "\n".join(
    f", r{k + 1} as (select doc_id, n_sentences, ids, replace(seq, '{q}', '#') as seq, case when contains(seq, '{q}') then list_append(found, '{name}') else found end as found from r{k})"
    for k, (name, q) in enumerate((n, "".join(f"<{i}>" for i in s)) for n, s in RULES)
)

# Words with the gaps after them: 2 where a sentence ends or lines are blank, 1 at a line's end, else 0. A known sentence
# starts and ends at a gap and holds no 2 but where it has a colon; of those that overlap the earlier and longer one counts.
OP5_SQL = f"""
with known(s, id) as (values {", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())}),
k as (select s, id, len(string_split(s, ' ')) as m, replace(string_split(s, ' ')[1], ':', '') as head from known),
tokens as (
  select doc_id, unnest(t) as t, unnest(range(1, len(t) + 1)) as i
  from (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[a-z0-9]+|[.!?;:]+[ \\t\\r\\n]+|[.!?;:]+$|\\r\\n|\\r|\\n') as t from documents)
),
placed as (select *, regexp_matches(t, '^[a-z0-9]') as is_word, sum(case when regexp_matches(t, '^[a-z0-9]') then 1 else 0 end) over (partition by doc_id order by i) as g from tokens),
words as (
  select doc_id, g, max(case when is_word then t end) as w,
    case when bool_or(regexp_matches(t, '^[.!?;:]')) or count(*) filter (not is_word) > 1 then 2 when count(*) filter (not is_word) = 1 then 1 else 0 end as gap
  from placed group by doc_id, g
),
texts as (select doc_id, list(w order by g) as w, list(gap order by g) as gap from words where g > 0 group by doc_id),
starts as (
  select doc_id, w, gap, g from (select doc_id, w, gap, unnest(range(1, len(w) + 1)) as g from texts) where g = 1 or gap[g - 1] > 0
),
hits as (
  select doc_id, g, g + m as until, id from starts join k on starts.w[g] = head
  where g + m - 1 <= len(w) and (g + m - 1 = len(w) or gap[g + m - 1] > 0)
    and array_to_string(list_transform(range(g, g + m), lambda j: w[j] || case when j < g + m - 1 and gap[j] = 2 then ':' else '' end), ' ') = s
),
first as (
  select * from hits h where not exists (
    select 1 from hits o where o.doc_id = h.doc_id and ((o.g < h.g and o.until > h.g) or (o.g = h.g and o.until > h.until))
  )
),
each as (select doc_id, string_agg(id, ',' order by g) as ids, string_agg('<' || id || '>', '' order by g) as seq from first group by doc_id),
n as (select doc_id, count(*) as n_sentences from starts group by doc_id),
r0 as (
  select d.doc_id, coalesce(n_sentences, 0) as n_sentences, coalesce(ids, '') as ids, coalesce(seq, '') as seq, cast([] as varchar[]) as found
  from documents d left join n using (doc_id) left join each using (doc_id)
)
{_STEPS}
select doc_id, cast(n_sentences as bigint) as n_sentences, ids as sentence_ids,
  coalesce(array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ','), '') as licenses from r{len(RULES)}
"""
