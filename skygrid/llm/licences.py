"""Licence scans by canonical digest.

A text is brought to one canonical form: capitals, punctuation, titles, copyright lines and spellings that mean the same
do not count. Titles, and copyright lines that name no year, count only as the first lines of a text. Entire texts are then looked up by the digest of that form in a table of known licences: the whole
document, and each of its lines, as notices are often a line of their own. The lookup is an equi-join with the known
digests, on each document's distinct digests only.

Defined results: null, empty and blank texts match nothing; a licence that occurs on several lines is named once;
repeated rows each get their result; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from skygrid.llm.common import whole_text

# Texts of public licences and the usual notices of them; the longer texts are in a file, read by the driver.
TEXTS = Path(__file__).with_name("licence_texts.json")
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
     "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
     "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
     "THIS SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions:\n"
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software.\n"
     "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
     "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
     "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    *((i, t) for i, t in json.loads(TEXTS.read_text(encoding="utf8"))),
)
# Spellings that count as one, left by right; words of the canonical form.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"),
    ("organisation", "organization"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"),
    # The same where a line ends between the words.
    ("non \n commercial", "noncommercial \n"), ("per \n cent", "percent \n"), ("copyright \n owner", "copyright \n holder"),
)
# Lines of the canonical form that only say which licence follows, or who holds the rights; titles that belong to the text stay.
TITLE = (
    r"(?:the )?(?:mit|expat|isc|zlib|(?:new |revised |modified |simplified )?bsd|bsd [23] clause|[23] clause bsd)"
    r" license(?: (?:mit|expat|isc|zlib))?(?: version [0-9](?: [0-9])?)?")
_HEAD = rf"\A(?:(?: {TITLE} | copyright(?: [a-z0-9]+){{1,12}} | (?:copyright|c) (?:c )?[0-9]{{4}} .*| all rights reserved | ?)\n){{1,40}}"
COPYRIGHT = rf"(?m){_HEAD}|^ (copyright|c) (c )?[0-9]{{4}} .*$|^ copyright c .*$|^ all rights reserved $"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Lines of words in lower case, a single space round each word; copyright lines are left empty, titles too."""
    c = F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"[^a-z0-9\n]+", " ")
    c = F.regexp_replace(F.concat(F.lit(" "), F.replace(c, F.lit("\n"), F.lit(" \n ")), F.lit(" ")), " +", " ")
    for other, one in SPELLINGS:
        c = F.replace(c, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.regexp_replace(c, COPYRIGHT, "")


def _digest(canonical_text: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(canonical_text, r"[ \n]+", " ")), 256)


def scan(docs: DataFrame, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """doc_id, whole (the licence that the entire text is), notices (those of its lines, sorted, comma-joined), n_notices."""
    licences = docs.sparkSession.createDataFrame([(i, t) for i, t in known], "licence string, _t string")
    licences = licences.groupBy(_digest(canonical(F.col("_t"))).alias("_digest")).agg(F.min("licence").alias("licence"))
    # Rows that are the same in doc_id and text share a row of hits.
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_rid"), whole_text().alias("_text"))
    plain = rows.select("_rid", canonical(F.col("_text")).alias("_c"))
    units = plain.select("_rid", F.explode(F.array_distinct(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), _digest(F.col("_c")).alias("digest"))),
        F.transform(F.split("_c", "\n"), lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(F.trim(x), 256).alias("digest")))))).alias("_u"))
    hits = (
        units.select("_rid", "_u.whole", F.col("_u.digest").alias("_digest")).join(licences, "_digest")
        .groupBy("_rid").agg(
            F.min(F.when(F.col("whole"), F.col("licence"))).alias("whole"),
            F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("licence")))).alias("_names")))
    return rows.select("doc_id", "_rid").join(hits, "_rid", "left").select(
        "doc_id", "whole", F.coalesce(F.array_join("_names", ","), F.lit("")).alias("notices"),
        F.coalesce(F.size("_names"), F.lit(0)).cast("long").alias("n_notices"))
