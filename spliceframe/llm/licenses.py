"""License scans by canonical digest.

A text is brought to a canonical form (A-Z in lower case, copyright lines gone, equivalent spellings made one, runs of
punctuation and white space one space) and its digest is joined with the digests of known licenses. Compared are a
document as a whole and each run of its lines that has a known text's first word and length, so that a notice in a line
of its own is found, and a license wrapped anyhow inside a longer document.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spliceframe.llm.common import Sealed, ascii_lower, cut, table

#: Spellings that count as one.
SPELLINGS = (("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("copyright owner", "copyright holder"), ("per cent", "percent"), ("&", " and "))
#: Lines of copyright, with a year or a name, and "all rights reserved" right after one; not what licenses themselves say of copyright.
COPYRIGHT = (
    r"(?m)^[^0-9a-z\n]*(?:(?:\(c\)|©)[ \t]*[0-9]|©|copyright[ \t:,]*(?:\(c\)|©|[\[<{]?[ \t]*(?:[0-9]|yyyy|year\b))|copyright[ \t]*:|copyright[ \t]+(?!"
    r"(?:holders?|owners?|ownership|and|or|notices?|laws?|line|interests?|disclaimers?|the|permissions?|on|in|to|of|is|licen[sc]es?|also|like|treaty|statements?|if|doctrines|are|protection|terms|rights?|act|as|for|with|infringement)\b)[a-z])[^\n]*"
    r"(?:\n[^0-9a-z\n]*all rights reserved[^0-9a-z\n]*)?$"
)
#: The SQL's, which knows lines with a year only; the tables hold no others.
_COPYRIGHT = r"(?m)^[^0-9a-z\n]*(copyright[ \t]*)?(\(c\)|©|copyright)[ \t]*[0-9][^\n]*$"
#: At most so many known texts are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 100_000

_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
#: Notices and short texts, (license, text). catalogue() adds the full ones.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _WARRANTY),
    (
        "MIT",
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
)


def canonical(text: Column) -> Column:
    """The canonical form, line by line; null: ''."""
    x = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT, "")
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(a), F.lit(b))
    x = F.regexp_replace(x, r"copyright([\x00-\x2F\x3A-\x60\x7B-\x7F]+)owner", "copyright$1holder")  # over a line's end
    return F.regexp_replace(x, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def whole(canonical_text: Column) -> Column:
    """A canonical text as one line."""
    return F.trim(F.regexp_replace(canonical_text, r"[ \n]+", " "))


_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
)
_TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"), "Unlicense": ("The Unlicense", "Unlicense")}
_SPDX = ("BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "MPL-2.0", "Unlicense", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")
#: Full texts in license_texts/, and from where to where each holds the header that source files carry.
_FULL = {"Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the", "limitations under the License."), "CC0-1.0": None, "GPL-2.0": ("This program is free software", "Boston, MA 02110-1301 USA."), "GPL-3.0": ("This program is free software", "licenses/>."), "LGPL-2.1": ("This library is free software", "02110-1301  USA"), "LGPL-3.0": None, "MPL-2.0": ("This Source Code Form is subject to the terms", "MPL/2.0/."), "Unlicense": None}


def catalogue() -> list[tuple[str, str]]:
    """The known texts, (license, text): KNOWN, SPDX lines, standard headers, and full texts with and without title, with and
    without what follows the terms."""
    out = [*KNOWN, *((i, f"SPDX-License-Identifier: {i}{x}") for i in _SPDX for x in (("-only", "-or-later", "") if "GPL" in i else ("",)))]
    mit = next(t.split("\n", 1)[1] for i, t in KNOWN if i == "MIT" and "\n" in t)
    bodies = [("MIT", mit), *((i, t) for i, t in KNOWN if i in ("ISC", "0BSD")), *((i, t.replace("and/or distribute", "and distribute", 1)) for i, t in KNOWN if i == "ISC")]
    for i, clauses in (("BSD-2-Clause", _BSD[1:3]), ("BSD-3-Clause", _BSD[1:4])):
        for mark in ("{}. ", "* "):
            bodies.append((i, "\n".join([_BSD[0], *(mark.format(n) + c for n, c in enumerate(clauses, 1)), _BSD[4]])))
    for i, header in _FULL.items():
        text = resources.files("spliceframe.llm").joinpath("license_texts", f"{i}.txt").read_text("utf-8").strip()
        ends = [text]
        if m := re.search(r"\n *END OF TERMS AND CONDITIONS", text):
            ends += [text[: m.end()], text[: m.start()]]
        bodies += [(i, x) for x in ends] if i == "Unlicense" else []
        out += [(i, x) for t in ends for x in (t, re.split(r"\n[ \t]*\n", t, maxsplit=1)[1])] if i != "Unlicense" else []
        if header:
            start = text.rindex(header[0])
            if (end := text.find(header[1], start)) < 0:
                raise ValueError(f"{i}: no end of the header")
            out.append((i, text[start : end + len(header[1])]))
    out += [(i, x) for i, t in bodies for x in (t, *(f"{title}\n{t}" for title in _TITLES[i]))]
    return sorted({(i, x) for i, t in out for x in (t, t.replace("https://", "http://"), t.replace("http://", "https://"))})


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(catalogue(), "license string, text string")


def _runs(docs: DataFrame, known: DataFrame, small: bool) -> DataFrame:
    """(key, d): digests of the runs of two lines or more that start with a known text's first word and have its length."""
    heads = [r[0] for r in known.select(F.substring_index("c", " ", 3)).distinct().limit(1001).collect()]
    x = docs.filter(F.col("_li_text").contains("\n"))
    if len(heads) <= 1000:
        x = x.filter(F.col("_li_whole").rlike("(?:^| )(?:" + "|".join(re.escape(h) for h in sorted(heads)) + ")(?: |$)"))
    x = x.groupBy(F.md5("_li_text").alias("key")).agg(F.first("_li_text").alias("t"))
    x = cut(x.select("key", F.filter(F.transform(F.split("t", "\n", -1), lambda v: F.trim(v)), lambda v: v != "").alias("lines")))
    rows = x.select("key", F.posexplode("lines").alias("i", "line"))
    size = F.length("line")
    rows = rows.withColumn("end", F.sum(size + 1).over(W.partitionBy("key").orderBy("i")) - 1).withColumn("w", F.substring_index("line", " ", 1)).withColumn("start", F.col("end") - size)
    lengths = known.select(F.substring_index("c", " ", 1).alias("w"), "n").distinct()
    starts = rows.join(F.broadcast(lengths) if small else lengths, "w").select("key", F.col("i").alias("a"), (F.col("start") + F.col("n")).alias("end"))
    found = starts.join(rows.select("key", F.col("i").alias("b"), "end"), ["key", "end"]).filter("b > a").join(x, "key")
    return found.select("key", F.sha2(F.array_join(F.slice("lines", F.col("a") + 1, F.col("b") - F.col("a") + 1), " "), 256).alias("d"))


def find_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without text_col and with digest (SHA-256 of the whole canonical text), licenses (ids found, sorted) and whole
    (ids that the whole text is).

    known: (license, text). Texts of one canonical form may have several licenses; all are told. Texts that are empty in
    canonical form match nothing. Null and empty texts: the digest of ''. Rows are told apart by their text's digest, so
    repeated ids and rows keep their own results. Columns of docs with these names are replaced.
    """
    known = known_texts(docs.sparkSession) if known is None else known
    known = known.select("license", whole(canonical(F.col("text"))).alias("c")).filter("c <> ''").select("license", "c", F.sha2("c", 256).alias("d"), F.length("c").alias("n")).distinct()
    known = cut(known)
    small = known.count() <= BROADCAST_ROWS
    by_digest = known.select("license", "d")
    lengths = [r[0] for r in known.select("n").distinct().limit(1000).collect()]
    s = Sealed(docs, "digest", "licenses", "whole")
    own = s.df.withColumn("_li_text", canonical(F.col(s[text_col]))).withColumn("_li_whole", whole(F.col("_li_text"))).withColumn("digest", F.sha2("_li_whole", 256))
    units = F.transform(F.split("_li_text", "\n", -1), lambda x: F.trim(x))
    if len(lengths) < 1000:  # a unit of no known text's length is none of them
        units = F.filter(units, lambda x: F.length(x).isin(lengths))
    digests = F.array_distinct(F.transform(F.filter(units, lambda x: x != ""), lambda x: F.sha2(x, 256)))
    looked = own.select("digest", F.explode_outer(F.array_union(digests, F.array("digest"))).alias("d"), F.md5(F.col("_li_text")).alias("key"))
    looked = looked.unionByName(_runs(own, known, small), allowMissingColumns=True)
    pairs = looked.join(F.broadcast(by_digest) if small else by_digest, "d").distinct()
    per = pairs.groupBy("key").agg(F.array_sort(F.collect_set("license")).alias("licenses"), F.array_sort(F.collect_set(F.when(F.col("d") == F.col("digest"), F.col("license")))).alias("whole"))
    out = own.withColumn("own_key", F.md5("_li_text")).drop(s[text_col], "_li_text", "_li_whole")
    out = out.join(per, F.col("own_key") == F.col("key"), "left")
    none = F.array().cast("array<string>")
    return s.opened(out, "digest", F.coalesce("licenses", none).alias("licenses"), F.coalesce("whole", none).alias("whole"), without=(text_col,))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "digest", F.array_join("licenses", ",").alias("licenses"), F.array_join("whole", ",").alias("whole"))


def _sql_canonical(text: str) -> str:
    x = f"regexp_replace(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_COPYRIGHT}', '', 'g')"
    for a, b in SPELLINGS:
        x = f"replace({x}, '{a}', '{b}')"
    return rf"regexp_replace({x}, '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')"


def _sql_whole(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[ \n]+', ' ', 'g'))"


#: All known texts, as whole documents, single lines and runs of lines.
_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in catalogue())
OP4_SQL = f"""
WITH k AS MATERIALIZED (SELECT DISTINCT license, {_sql_whole(_sql_canonical("t"))} AS c FROM (VALUES {_VALUES}) v(license, t)),
d AS MATERIALIZED (SELECT doc_id, list_filter(list_transform(string_split({_sql_canonical("text")}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM documents),
w AS MATERIALIZED (SELECT *, array_to_string(ls, ' ') AS c FROM d),
h AS (SELECT w.doc_id, k.license, w.ls, k.c, k.c = w.c AS w FROM w JOIN k ON k.c <> '' AND contains(w.c, k.c)),
i AS (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM h WHERE NOT w),
j AS (SELECT *, unnest(range(i, len(ls) + 1)) AS j FROM i WHERE starts_with(c, ls[i])),
m AS MATERIALIZED (SELECT DISTINCT doc_id, license, w FROM h WHERE w UNION SELECT DISTINCT doc_id, license, w FROM j WHERE array_to_string(ls[i:j], ' ') = c)
SELECT doc_id, sha256(c) AS digest,
  coalesce((SELECT string_agg(DISTINCT license, ',' ORDER BY license) FROM m WHERE m.doc_id = w.doc_id), '') AS licenses,
  coalesce((SELECT string_agg(DISTINCT license, ',' ORDER BY license) FROM m WHERE m.doc_id = w.doc_id AND m.w), '') AS whole
FROM w
"""
