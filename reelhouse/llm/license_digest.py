"""Licence scans by canonical digest, with DataFrame functions only.

A text is put into canonical form: lower case, licence spellings made equal, copyright lines and
everything but a-z and 0-9 dropped, runs of white space made one space.  Its SHA-256 is joined with
the digests of known licences: once for the whole text (a document that is a licence), and once
for each line (a notice inside a document).  Texts never travel; the known table is a parameter (by
default ``licenses()``, some dozen rows), broadcast, and all joins are hash joins on the digest.

Canonical form drops a line that begins with a dated copyright as a whole.  Texts with a copyright mark
have a second form, where only the copyright statement goes, with or without a year, up to the end of
its sentence or line or to the words that open a licence.  A text matches by either form; the first
form, which is also that of the DuckDB SQL, counts before the second.

Defined results: null and empty texts, and those that canonical form empties, match nothing; repeated
rows are reported one by one; other columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Well-known licence texts and notices, by SPDX name.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
    "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
    "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE.")
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License.")
KNOWN = (
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", _MIT),
    ("ISC", "ISC License\n" + _ISC),
    ("ISC", _ISC),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("proprietary", "All rights reserved."),
)
#: Full texts by SPDX name, one file each.
TEXTS = Path(__file__).with_name("license_texts")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT %s OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")


def _bsd(clauses: int) -> list[str]:
    """The usual spellings: with a title, reserved rights, numbers, and owner for holder, or not."""
    title, rights = ("", f"BSD {clauses}-Clause License\n"), ("", "All rights reserved.\n")
    heads = ["", *(f"{k}. " for k in range(1, clauses + 1))]
    out = []
    for t, r, numbered, who in itertools.product(title, rights, (False, True), ("HOLDER", "OWNER")):
        parts = [(heads[k + 1] if numbered else "") + c for k, c in enumerate(_BSD[:clauses])]
        out.append(t + r + "Redistribution and use in source and binary forms, with or without modification, are permitted "
                   "provided that the following conditions are met:\n" + "\n".join(parts) + "\n" + _BSD_END % who)
    return out


def licenses() -> list[tuple[str, str]]:
    """(license, text): the notices of ``KNOWN`` and the full texts, those with an appendix also without it."""
    out = [*KNOWN, *(("BSD-2-Clause", t) for t in _bsd(2)), *(("BSD-3-Clause", t) for t in _bsd(3))]
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(path.stem, text), *([(path.stem, terms), (path.stem, terms + end)] if end else [])]
    return out


#: Fixed values: (pattern, replacement) of canonical form, in this order, on lower-cased text.
STEPS = (
    (r"(?m)^[^a-z0-9\n]*(copyright|copr\.?|©|\(c\))[^\n]*[0-9]{4}[^\n]*$", " "),
    (r"licence", "license"),
    (r"sub-license", "sublicense"),
    (r"non-infringement", "noninfringement"),
    (r"https:", "http:"),
    (r"version ([0-9])|v\. ?([0-9])", " $1$2"),
    (r"[^a-z0-9]+", " "),
)
_MARK = r"(?:copyright|copr\.?|©|\(c\))"
_YEAR = r"(?:[0-9]{4}|\[?yyyy\]?|<year>)"
#: A copyright statement ends before the end of a sentence, before words that open a licence, or with its line.
_STOP = (r"(?=(?<=[a-z0-9>)]{2})\.[ \t]|\b(?:permission (?:is|to)|licen[sc]ed under|released under|redistribution and use|"
         r"all rights reserved|this (?:file|library|program|software|source code|work) is)\b|$)")
#: The first step of the second form, in place of that of ``STEPS``.
STATEMENT = (rf"(?m)(?:^[^a-z0-9\n]*{_MARK}[^\n.]*?{_YEAR}|^[^a-z0-9\n]*(?:copyright[ \t]*(?:\(c\)|©|by\b|the\b)|©)"
             rf"|\bcopyright[ \t,]*(?:(?:\(c\)|©)[ \t]*)?{_YEAR})[^\n]*?{_STOP}", " ")


def canonical(text: Column, first: tuple[str, str] = STEPS[0]) -> Column:
    """The canonical form of a text."""
    out = F.lower(text)
    for pattern, to in (first, *STEPS[1:]):
        out = F.regexp_replace(out, pattern, to)
    return F.trim(out)


def _digests(text: Column) -> Column:
    """The digests of both forms; the second is null for texts without a copyright mark."""
    marked = F.regexp_like(F.lower(text), F.lit(_MARK))
    two = F.when(marked, F.sha2(canonical(text, STATEMENT), 256))
    return F.struct(F.sha2(canonical(text), 256).alias("one"), two.alias("two"))


def known(spark: SparkSession, table: DataFrame | None = None) -> DataFrame:
    """(digest, license) of the known texts, given as a table (license, text)."""
    if table is None:
        table = spark.createDataFrame(licenses(), "license string, text string")
    rows = table.select("license", _digests(F.col("text")).alias("d")).select("license", F.explode(F.array("d.one", "d.two")).alias("digest"))
    return rows.where("digest <> sha2('', 256)").groupBy("digest").agg(F.min("license").alias("license"))


def find_licenses(docs: DataFrame, text: str = "text", table: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, text_license (null if the whole text is none), n_license_lines, licenses (of lines; sorted, comma-joined).

    ``table`` (license, text) are the known licences, ``licenses()`` if none is given.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("row", "doc_id", _digests(F.col("text")).alias("whole"),
                       F.transform(F.split("text", "\n"), _digests).alias("lines"))
    names = F.broadcast(known(spark, table))

    def named(df: DataFrame, column: str, to: str) -> DataFrame:
        for form in ("one", "two"):
            side = names.select(F.col("digest").alias(f"_{form}"), F.col("license").alias(f"_license_{form}"))
            df = df.withColumn(f"_{form}", F.col(f"{column}.{form}")).join(side, f"_{form}", "left").drop(f"_{form}")
        return df.withColumn(to, F.coalesce("_license_one", "_license_two")).drop("_license_one", "_license_two")

    whole = named(rows, "whole", "text_license")
    lined = named(whole.select("row", "doc_id", "text_license", F.explode_outer("lines").alias("line")), "line", "license")
    return lined.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_license").alias("text_license"),
        F.count("license").alias("n_license_lines"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses")).drop("row")
