"""Licence scans by sentence rules; DataFrame functions only.

A text is cut into sentences, at signs that end one and at blank lines; a known
sentence may also start or end with a line, and be wrapped over lines, with
comment signs before each. A sentence is normalised (lower case, runs of other
signs than letters and digits become one space) and looked up among the known
licence sentences. What is left of a text is the sequence of its sentence
identifiers, which ordered rules are then matched against: a rule holds where
its identifiers stand one behind the other, with any other sentences between
them left out. Each row is worked on where it is read: nothing is shuffled.

Defined results
  null or empty text, or no licence sentence: a row with no identifiers and null rule
  repeated rows and repeated sentences: each counts; null doc_id: stays null
  extra columns: ignored; no rows: no rows; texts of any length: scanned whole
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table

#: identifier -> the sentence, normalised when it is used
SENTENCES: dict[str, str] = {
    "apache2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache2-notice-long": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-comply": "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-law": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-title": "MIT License",
    "mit-title-the": "The MIT License (MIT)",
    "mit-notice": "Released under the MIT License.",
    "mit-notice-licensed": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-notice": "Licensed under the BSD License.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "either version 2 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "This work is dedicated to the public domain under CC0 1.0.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mit-disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "bsd-disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21-later": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-accompanies": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

#: (licence, identifiers in order), strongest first; the first that matches names a text's licence
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache2-notice-long", "apache2-comply", "apache2-copy", "apache2-law", "apache2-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-warranty")),
    ("MIT", ("mit-title", "mit-grant", "mit-keep")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache2-notice-long", "apache2-comply")),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("Apache-2.0", ("apache2-notice",)),
    ("MPL-2.0", ("mpl2",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-licensed",)),
    ("BSD", ("bsd-notice",)),
    ("AGPL-3.0-or-later", ("agpl3-terms",)),
    ("LGPL-3.0-or-later", ("lgpl3-terms",)),
    ("LGPL-2.1-or-later", ("lgpl-terms", "lgpl21-later")),
    ("GPL-2.0-or-later", ("gpl2-terms", "gpl2-free")),
    ("ISC", ("isc-grant",)),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
    ("BSL-1.0", ("boost-grant",)),
    ("EPL-2.0", ("epl2-terms",)),
    ("EPL-2.0", ("epl2-accompanies",)),
]

#: Every known sentence holds one of these (as the module checks below): other texts needn't be cut up.
ANCHORS = ("licen", "permission", "redistribut", "copyright", "warrant", "public domain", "mozilla", "liable")


def normal(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def sentences_in(text: str) -> list[str]:
    """The sentences of a known licence text, cut at the signs that end one."""
    return [normal(s) for s in re.split("\n+", re.sub(r"([.!?;:])[ \t\r]+", "\\1\n", text))]


def _known() -> dict[str, str]:
    """normalised sentence -> identifier; a known sentence that is itself cut is known by its longest part."""
    return {max(sentences_in(text), key=len): key for key, text in SENTENCES.items()}


KNOWN = _known()
for _s in KNOWN:
    if not any(a in _s for a in ANCHORS):
        raise ValueError(f"no anchor in: {_s}")


#: Where a sentence ends for certain, and where a line ends that may go on in the next.
END, WRAP = "\x01", "\x02"


def normalised(text: Column) -> Column:
    """The words of a text with END and WRAP between them, all parted by one space."""
    t = F.regexp_replace(text, f"[{END}{WRAP}]", " ")
    t = F.regexp_replace(t, r"([.!?;:])(?:[ \t\r]+|\n)", f"$1{END}")
    t = F.regexp_replace(t, r"\n(?:[^\p{L}\p{N}\n]*\n)+", END)  # blank lines, be it with comment signs
    t = F.regexp_replace(F.regexp_replace(t, "\n", WRAP), f"([{END}{WRAP}])", " $1 ")
    return F.concat(F.lit(f"{END} "), F.trim(F.regexp_replace(F.lower(t), f"[^a-z0-9{END}{WRAP}]+", " ")), F.lit(f" {END}"))


def identifiers(text: Column) -> Column:
    """The identifiers of a text's licence sentences, in order: a known one stands on one line or is wrapped over several."""
    table_ = F.create_map(*[F.lit(x) for kv in KNOWN.items() for x in kv])
    known = "|".join(s.replace(" ", f" (?:{WRAP} )?") for s in sorted(KNOWN, key=len, reverse=True))
    found = F.regexp_extract_all(normalised(text), F.lit(f"(?<=[{END}{WRAP}] )({known})(?= [{END}{WRAP}])"), F.lit(1))
    ids = F.transform(found, lambda s: F.element_at(table_, F.regexp_replace(s, f"{WRAP} ", "")))
    return F.when(text.rlike("(?i)" + "|".join(a.replace(" ", r"[^a-z0-9]+") for a in ANCHORS)), ids).otherwise(F.array().cast("array<string>"))


def matched(ids: Column) -> Column:
    """The numbers of the rules that hold, in the rules' order."""
    line = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    return F.array_compact(F.array(*[F.when(line.contains("," + ",".join(rule) + ","), F.lit(k)) for k, (_, rule) in enumerate(RULES)]))


def scan(docs: DataFrame) -> DataFrame:
    """A row (doc_id, n_sentences, sentence_ids, rule, license, licenses) for each document."""
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), identifiers(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("ids"))
    got = got.withColumn("rules", matched(F.col("ids")))
    names = F.array(*[F.lit(n) for n, _ in RULES])
    name = lambda k: F.element_at(names, k + 1)
    return got.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.try_element_at("rules", F.lit(1)).alias("rule"),
        F.when(F.size("rules") > 0, name(F.element_at("rules", 1))).alias("license"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("rules", name))), ",").alias("licenses"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {q(k)})" for s, k in KNOWN.items())
    rules = ", ".join(f"({k}, {q(n)}, {q(',' + ','.join(r) + ',')})" for k, (n, r) in enumerate(RULES))
    return rf"""
WITH known(sentence, id) AS (VALUES {known}), rules(rule, name, line) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS row_no, doc_id, replace(replace(coalesce(text, ''), chr(1), ' '), chr(2), ' ') AS t FROM documents),
p AS (SELECT row_no, string_split(regexp_replace(regexp_replace(t, '([.!?;:])(?:[ \t\r]+|\n)', '\1' || chr(1), 'g'), '\n(?:[^\pL\pN\n]*\n)+', chr(1), 'g'), chr(1)) AS parts FROM d WHERE regexp_matches(lower(t), '{"|".join(a.replace(" ", "[^a-z0-9]+") for a in ANCHORS)}')),
s AS (SELECT row_no, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM p),
l AS (SELECT row_no, pos, list_transform(string_split(part, chr(10)), lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))) AS lines FROM s),
h AS (SELECT DISTINCT row_no, pos, lines FROM l JOIN known ON contains(' ' || array_to_string(lines, ' ') || ' ', ' ' || sentence || ' ')),
a AS (SELECT row_no, pos, lines, unnest(range(1, len(lines) + 1)) AS i FROM h),
b AS (SELECT row_no, pos, lines, i, unnest(range(i, len(lines) + 1)) AS j FROM a),
n AS (SELECT row_no, pos, i, j, id FROM b JOIN known ON known.sentence = array_to_string(lines[i:j], ' ') AND lines[i] <> '' AND lines[j] <> ''),
m AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM n o WHERE o.row_no = n.row_no AND o.pos = n.pos AND o.i <= n.i AND o.j >= n.j AND o.j - o.i > n.j - n.i)),
i AS (SELECT row_no, count(*) AS n, string_agg(id, ',' ORDER BY pos, i) AS ids FROM m GROUP BY row_no),
r AS (SELECT row_no, min(rule) AS rule, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM i JOIN rules ON contains(',' || ids || ',', line) GROUP BY row_no)
SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(i.n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids,
  CAST(r.rule AS INTEGER) AS rule, rules.name AS license, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN i USING (row_no) LEFT JOIN r USING (row_no) LEFT JOIN rules ON rules.rule = r.rule
"""


SQL = _sql()
