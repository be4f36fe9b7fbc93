"""Licence scans by digests of canonical entire texts.

A text is made canonical line by line: lower case, copyright statements dropped, equivalent spellings made one, every
run of other characters than letters and digits one space; lines that are left empty don't count. The digest of an
entire canonical text is joined with those of known licence texts and notices. Every run of lines of a document is such
a text; it is looked up from its first line, whose digest must be that of a known text's first words, and its last, which
ends where the known text does.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import pathlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.llm.common import materialise

#: Spellings that mean the same, applied in this order to lower-case text.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("organisation", "organization"), ("holder", "owner"),
    ("https://", "http://"), ("©", "(c)"), ("ver. ", "version "), ("v. ", "version "), ("&", "and"),
]
COPYRIGHT_LINE = r"(?m)^[ \t#*/;%-]*(copyright\b|\(c\))[^\n]*$"
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
#: Fixed values, also of the SQL: known licences as (identifier, entire text); full texts, usual headers and one-line notices.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}"),
    ("0BSD", f"{_ISC}. {_ISC_END}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]


_MIT, _APACHE_HEADER = KNOWN[0][1], KNOWN[7][1]
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_2 = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_TEXTS = [
    ("MIT", _MIT, ["MIT License", "The MIT License", "The MIT License (MIT)"]),
    ("ISC", KNOWN[4][1], ["ISC License", "The ISC License"]),
    ("0BSD", KNOWN[5][1], ["BSD Zero Clause License", "Zero-Clause BSD"]),
    ("Apache-2.0", _APACHE_HEADER, []),
    ("BSD-2-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_END, ["BSD 2-Clause License", "The 2-Clause BSD License"]),
    ("BSD-2-Clause", f"{_BSD}1. {_BSD_1}2. {_BSD_2}{_BSD_END}", ["BSD 2-Clause License", "The 2-Clause BSD License"]),
    ("BSD-3-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_END, ["BSD 3-Clause License", "The 3-Clause BSD License"]),
    ("BSD-3-Clause", f"{_BSD}1. {_BSD_1}2. {_BSD_2}3. {_BSD_3}{_BSD_END}", ["BSD 3-Clause License", "The 3-Clause BSD License"]),
]
_FILES = [("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")]
#: KNOWN, further full texts, and full texts under a title.
ALL_KNOWN = KNOWN + [(k, (pathlib.Path(__file__).parent / "license_texts" / f"{name}.txt").read_text()) for k, name in _FILES] + [(k, f"{title} {t}".strip()) for k, t, titles in _TEXTS for title in ["", *titles]]
#: Words that a notice after a copyright statement on the same line begins with.
_NOTICE = r"released|licensed|permission|redistribution|spdx|this (?:work|program|software|source|file)"
#: A copyright statement at the start of a line: with a year, a '(c)' or a holder, but not one that goes on with the words
#: of a licence text. It ends with the line, or before a notice.
COPYRIGHT_NOTICE = (
    r"^[ \t#*/;%-]*(?:\(c\)|copyright\b(?=.*(?:\b[12][0-9]{3}\b|\(c\)))|copyright[ \t]+(?!(?:notices?|holders?|owners?|laws?|licen[sc]es?|statements?|and|or|in|is|of|to|the above|on|for)\b)(?=\w))"
    rf".*?(?:[.;,!)][ \t]+(?=(?:{_NOTICE})\b)|$)"
)


def canonical(line: Column) -> Column:
    """The canonical form of one line; null is empty."""
    out = F.replace(F.lower(F.coalesce(line, F.lit(""))), F.lit("©"), F.lit("(c)"))
    out = F.concat(F.regexp_replace(out, COPYRIGHT_NOTICE, " "), F.lit(" "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def canonical_text(text: Column) -> Column:
    """The canonical form of an entire text."""
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), canonical), lambda c: c != ""), " ")


def _anchor(known: str) -> str:
    """Letters that any spelling of a known canonical text has, in lower case; empty if there are none for sure."""
    if "license" in known:
        return "licen"
    made = ("sublicense", "noncommercial", "organization", "owner", "http", "version", "and")
    return max((w for w in known.split() if w != "c" and not any(m in w for m in made)), key=len, default="")


def license_hits(docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id_col, unit, position, license)`` for each unit of a document that is a known licence text as a whole.

    ``unit`` is ``document``, ``paragraph`` (between blank lines), ``paragraphs`` (a run of several, at its first one's
    position), ``line`` or ``lines`` (a run of several that is neither); ``position`` counts paragraphs or lines from 0. A
    text of one paragraph or line has no such unit, and a run that is all of its text is only the document. Null, empty
    and wordless texts match nothing; repeated rows give repeated hits; null ids stay; other columns are not read. A very
    long text is taken apart into its lines. ``known`` is a policy: its digests, one for each of its words, are broadcast.

    Only documents with a word that every known text has are made canonical, each line once. Their lines are narrow rows
    from then on, so a document, however long, is never held whole.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame(sorted({(k, t) for k, t in known or ALL_KNOWN}), "license string, known string")
    table = table.select(canonical_text(F.col("known")).alias("known"), "license").where("known <> ''").groupBy("known").agg(F.min("license").alias("license"))
    policy = sorted((r.known, r.license) for r in table.collect())
    beginnings = []  # every known text's first words: their digest, the text's number of words, digest and licence
    for text, name in policy:
        words, said, whole = text.split(" "), hashlib.sha1(), hashlib.sha1(text.encode()).hexdigest()
        for k, w in enumerate(words):
            said.update((" " * bool(k) + w).encode())
            beginnings.append((said.hexdigest(), len(words), whole, name))
    begins = spark.createDataFrame(beginnings, "begin string, length int, whole string, license string")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    anchors = sorted({_anchor(text) for text, _ in policy}, key=len)
    anchors = [a for i, a in enumerate(anchors) if not any(o in a for o in anchors[:i])]
    text = F.lower(F.col("text"))
    rows = rows.where(functools.reduce(operator.or_, [text.contains(a) for a in anchors] or [F.lit(False)]))
    parts = F.transform(F.split("text", "\n"), lambda t: F.struct(t.rlike(r"\A[ \t\r]*\z").alias("blank"), canonical(t).alias("canon")))
    rows = rows.select("id", F.monotonically_increasing_id().alias("row"), parts.alias("parts"))
    lines = rows.select("id", "row", F.posexplode_outer("parts").alias("line", "l")).select("id", "row", "line", "l.blank", "l.canon")
    lines = materialise(lines.withColumn("n", F.when(F.col("canon") == "", 0).otherwise(F.size(F.split("canon", " ")))))

    # paragraphs are numbered as by a split at every two line ends with at most blanks between
    so_far, every = Window.partitionBy("row").orderBy("line"), Window.partitionBy("row")
    said = F.when(~F.col("blank"), F.col("line"))
    before = F.last(said, ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    ends = F.col("line") - F.coalesce(before, F.lit(0))  # line ends since the last line that is not blank
    lines = lines.withColumns({
        "cuts": F.when(F.col("blank"), 0).otherwise(F.floor(ends / 2)), "end": F.sum("n").over(so_far), "total": F.sum("n").over(every), "n_lines": F.count("*").over(every),
        "after": F.count("*").over(every) - 1 - F.max(said).over(every),
    })
    lines = lines.withColumns({"par": F.sum("cuts").over(so_far), "n_pars": F.sum("cuts").over(every) + F.floor(F.col("after") / 2) + 1, "start": F.col("end") - F.col("n")}).where("n > 0")
    paragraph = Window.partitionBy("row", "par")
    lines = lines.withColumns({"par_start": F.min("start").over(paragraph), "par_end": F.max("end").over(paragraph)})
    lines = materialise(lines.select("id", "row", "line", "canon", "start", "end", "total", "n_lines", "par", "n_pars", "par_start", "par_end"))

    found = lines.join(F.broadcast(begins), F.sha1("canon") == F.col("begin"))
    found = found.withColumn("stop", F.col("start") + F.col("length")).select("id", "row", "line", "start", "end", "stop", "total", "n_lines", "par", "n_pars", "par_start", "whole", "license")
    last = lines.select("row", F.col("end").alias("stop"), F.col("line").alias("to"), F.col("par").alias("to_par"), F.col("par_end").alias("to_end"))
    found = materialise(found.join(last, ["row", "stop"]))
    longer = found.where("to > line")
    inside = longer.select("row", "line", "to", "whole", F.explode(F.sequence("line", "to")).alias("at")).join(lines.select("row", F.col("line").alias("at"), "canon"), ["row", "at"])
    same = inside.groupBy("row", "line", "to", "whole").agg(F.array_sort(F.collect_list(F.struct("at", "canon"))).alias("said"))
    same = same.where(F.sha1(F.array_join(F.transform("said", lambda x: x["canon"]), " ")) == F.col("whole")).select("row", "line", "to", "whole")
    hits = found.where("to = line").unionByName(longer.join(same, ["row", "line", "to", "whole"]).select(*found.columns))

    document = (F.col("start") == 0) & (F.col("stop") == F.col("total"))
    aligned = (F.col("start") == F.col("par_start")) & (F.col("stop") == F.col("to_end"))
    several, one_line = F.col("par") != F.col("to_par"), F.col("line") == F.col("to")
    unit = lambda name, at: F.struct(F.lit(name).alias("unit"), at.cast("int").alias("position"))
    units = F.array_compact(F.array(
        F.when(document, unit("document", F.lit(0))), F.when((F.col("n_pars") > 1) & aligned & ~several, unit("paragraph", F.col("par"))),
        F.when(aligned & several & ~document, unit("paragraphs", F.col("par"))), F.when((F.col("n_lines") > 1) & one_line, unit("line", F.col("line"))),
        F.when(~one_line & ~document & ~aligned, unit("lines", F.col("line"))),
    ))
    return hits.select(F.col("id").alias(id_col), "license", F.inline(units)).select(id_col, "unit", "position", "license")
