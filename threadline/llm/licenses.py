"""Licence scan by canonical digest lookup. DataFrame functions only.

A text is brought to a canonical form (lower case, copyright lines dropped, punctuation to single
spaces, equivalent spellings unified) and its MD5 digest is joined with the digests of known licence
texts. The same form keeps line breaks, so each line is a text of its own and short notices inside a
document are found by the same digests. Where that names no licence for the whole text, a second form decides, which
has no SQL: copyright lines are only those with a mark, a year or a place for them, and spellings are unified after
the lines are joined, so that hard wraps do not matter. It is compared with the whole texts in ``license_texts`` and
those above two lines in ``KNOWN``, each also without its title.

Cases: null and empty texts have the canonical form '' and match nothing; repeated rows each get a
result row; equal digests under two names yield the smaller name; extra columns are not looked at;
an empty table gives an empty result.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Public licence texts and customary notices, as (name, text).
KNOWN = (
    ("MIT", """MIT License

Copyright (c) <year> <holder>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Copyright (c) <year> <holder>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

# Equivalent spellings, applied to canonical words in this order. A blank stands for a bound: every line begins with one.
SPELLINGS = (
    (" licence", " license"), (" sublicence", " sublicense"), (" sub license", " sublicense"), (" non commercial", " noncommercial"), (" https ", " http "),
    (" organisation", " organization"), (" favour", " favor"), (" merchantibility", " merchantability"), (" ver ", " version "), (" v 2 0", " version 2 0"),
)

#: A line that starts (after signs) with a copyright mark, or reserves all rights, is no part of the licence.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*$"


def canonical_lines(text: Column) -> Column:
    """Canonical form that keeps line breaks."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    out = F.concat(F.lit(" "), F.replace(F.regexp_replace(out, r"[^a-z0-9\n]+", " "), F.lit("\n"), F.lit("\n ")))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def one_line(canonical: Column) -> Column:
    """Canonical form of a whole text, from the form with line breaks."""
    return F.trim(F.regexp_replace(canonical, r"[ \n]+", " "))


#: In a whole text, a line of a copyright mark, a year or a place for them, or one that only reserves all rights.
OWNER_LINE = r"(?m)^[^a-z0-9\n]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9]{4}|[<\[{])[^\n]*|(?:\(c\)[ \t]*(?:[0-9]{4}|[<\[{])|©)[^\n]*|all rights reserved[. \t\r]*)$"
#: Every whole text has one of these.
ANY_WHOLE = r"(?i)softw|licen"


def whole_form(text: Column) -> Column:
    """Canonical form of a whole text, whatever its line breaks."""
    out = F.concat(F.lit(" "), one_line(F.regexp_replace(F.regexp_replace(F.lower(text), OWNER_LINE, ""), r"[^a-z0-9]+", " ")), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def whole_texts(known: tuple[tuple[str, str], ...] = KNOWN) -> list[tuple[str, str]]:
    """Whole licences, with and without a title."""
    files = [(f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    found = []
    for name, text in [*files, *((n, t) for n, t in known if n in ("MIT", "ISC") and t.count("\n") > 2)]:
        title, _, rest = text.partition("\n")
        found += [(name, text)] + ([(name, rest)] if title.endswith(" License") else [])
    return found


def whole_digests(spark: SparkSession, known: tuple[tuple[str, str], ...]) -> DataFrame:
    """Digests of the whole texts with a name."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(text).alias("text")) for name, text in whole_texts(known)]))
    texts = spark.range(1).select(rows.alias("k")).select(F.col("k.name").alias("name"), F.md5(whole_form(F.col("k.text")).cast("binary")).alias("_whole"))
    return texts.groupBy("_whole").agg(F.min("name").alias("_is"))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """Distinct digests of the known texts with a name and the canonical length; as many rows as the parameter has, at most."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(text).alias("text")) for name, text in known]))
    texts = spark.range(1).select(rows.alias("k")).select(F.col("k.name").alias("name"), one_line(canonical_lines(F.col("k.text"))).alias("canon"))
    return texts.groupBy(F.md5(F.col("canon").cast("binary")).alias("digest")).agg(F.min("name").alias("license_id"), F.min(F.length("canon")).alias("canon_length"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """Per document the digest of its canonical text, the licence it is, and the licences its lines state.

    Columns: id, canon_md5, license_id (null: the whole text is no known licence), notices
    (names in order, joined by commas, '' for none), notice_lines.
    """
    digests = known_digests(docs.sparkSession, known)
    lengths = [r[0] for r in digests.select("canon_length").distinct().collect()]  # no more than the parameter
    other = F.when(F.col(text_col).rlike(ANY_WHOLE), F.md5(whole_form(F.col(text_col)).cast("binary")))
    canon = docs.select(F.col(id_col), canonical_lines(F.col(text_col)).alias("_lines"), other.alias("_whole"))
    canon = canon.select(id_col, "_lines", "_whole", F.md5(one_line(F.col("_lines")).cast("binary")).alias("canon_md5"))
    lines = F.filter(F.transform(F.split("_lines", "\n"), lambda line: F.trim(line)), lambda line: F.length(line).isin(lengths))
    base = canon.select(id_col, "canon_md5", "_whole", lines.alias("_kept"))
    hits = base.where(F.size("_kept") > 0).select(F.col(id_col).alias("_id"), F.col("canon_md5").alias("_md5"), F.posexplode("_kept").alias("_no", "_line"))
    hits = hits.select("_id", "_md5", "_no", F.md5(F.col("_line").cast("binary")).alias("digest")).join(digests.select("digest", "license_id"), "digest")
    found = hits.groupBy("_id", "_md5").agg(
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"), F.countDistinct("_no").alias("notice_lines")
    )
    whole = base.select(id_col, "canon_md5", "_whole").join(digests.select(F.col("digest").alias("canon_md5"), "license_id"), "canon_md5", "left")
    whole = whole.join(F.broadcast(whole_digests(docs.sparkSession, known)), "_whole", "left").withColumn("license_id", F.coalesce("license_id", "_is"))
    out = whole.join(found, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("canon_md5") == F.col("_md5")), "left")
    return out.select(
        id_col, "canon_md5", "license_id", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("notice_lines", F.lit(0)).cast("long").alias("notice_lines")
    )


def op4_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of all documents."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    def lines(text: str) -> str:
        out = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '', 'g')"
        out = rf"regexp_replace({out}, '[^a-z0-9\n]+', ' ', 'g')"
        out = f"(' ' || replace({out}, chr(10), chr(10) || ' '))"
        for old, new in SPELLINGS:
            out = f"replace({out}, '{old}', '{new}')"
        return out

    quoted = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    return rf"""
WITH known(name, txt) AS (VALUES {quoted}),
digests AS (
  SELECT md5(trim(regexp_replace({lines("txt")}, '[ \n]+', ' ', 'g'))) AS digest, min(name) AS license_id FROM known GROUP BY 1
), canon AS (
  SELECT doc_id, {lines("text")} AS ls FROM documents
), whole AS (
  SELECT doc_id, md5(trim(regexp_replace(ls, '[ \n]+', ' ', 'g'))) AS canon_md5, ls FROM canon
), split AS (
  SELECT doc_id, canon_md5, unnest(string_split(ls, chr(10))) AS line, generate_subscripts(string_split(ls, chr(10)), 1) AS no FROM whole
), found AS (
  SELECT s.doc_id, s.canon_md5, string_agg(DISTINCT d.license_id, ',' ORDER BY d.license_id) AS notices, count(DISTINCT s.no) AS notice_lines
  FROM split s JOIN digests d ON md5(trim(s.line)) = d.digest GROUP BY 1, 2
)
SELECT w.doc_id, w.canon_md5, d.license_id, coalesce(f.notices, '') AS notices, coalesce(f.notice_lines, 0)::BIGINT AS notice_lines
FROM whole w LEFT JOIN digests d ON w.canon_md5 = d.digest
LEFT JOIN found f ON w.doc_id IS NOT DISTINCT FROM f.doc_id AND w.canon_md5 = f.canon_md5
"""


QUERIES = {"op4_license_digest": op4_license_digest}
ORACLES = {"op4_license_digest": _sql()}
