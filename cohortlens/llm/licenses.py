"""License scan by canonical digests.

A text is normalised (case, punctuation, copyright lines, equivalent spellings), the SHA-256 of the
result is hash-joined to the digests of known licence texts. The same lookup runs on every whole
line, because a notice ("Licensed under ...") stands on a line of its own.

Everything is DataFrame code. The known table is a plain join side: Catalyst broadcasts it when its
measured size is small and shuffles it otherwise (AQE then splits a digest that many texts share).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

# A line is a copyright line if it starts (after marks) like this.
COPYRIGHT_LINE = (r"^[^A-Za-z\n]*(?:[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt][ \t]*(?:\([Cc]\)|©|[0-9]{4}|[Bb][Yy] )"
                  r"|©|\([Cc]\)[ \t]*[0-9]|[Aa][Ll][Ll] [Rr][Ii][Gg][Hh][Tt][Ss] [Rr][Ee][Ss][Ee][Rr][Vv][Ee][Dd]\W*\z)[\s\S]*\z")
PUNCTUATION = r"[^\p{L}\p{N}]+"
# Fixed values: (literal triggers, pattern, replacement) of spellings that licence matching treats as equal. A pattern
# can match only where one of its triggers occurs; looking for those first is far cheaper than the pattern.
SPELLINGS = [
    (["licenc"], r"\b(licen)c(e|es|ed|ing|or|ors|ee|ees)\b", "$1s$2"),
    (["authoris", "categoris", "emphasis", "initialis", "maximis", "minimis", "optimis", "organis", "realis", "recognis", "utilis",
      "capitalis"],
     r"\b(author|categor|emphas|initial|maxim|minim|optim|organ|real|recogn|util|capital)is(e|es|ed|ing|er|ers|ation|ations)\b",
     "$1iz$2"),
    (["favour", "colour", "honour", "behaviour", "labour", "endeavour"], r"\b(fav|col|hon|behavi|lab|endeav)our", "$1or"),
    (["alogue"], r"\b(catal|anal|dial)ogue", "$1og"),
    (["gement"], r"\b(acknowledg|judg)ement", "$1ment"),
    (["cancell", "labell", "modell", "signall"], r"\b(cancel|label|model|signal)l(ed|ing)\b", "$1$2"),
    (["copyright owner"], r"\bcopyright owner", "copyright holder"),
    ([f"{a} {b}" for a in ("sub", "non") for b in ("licens", "commercial", "infring", "exclusive")], r"\b(sub|non) (licens|commercial|infring|exclusive)", "$1$2"),
    (["per cent"], r"\bper cent\b", "percent"),
    (["whilst"], r"\bwhilst\b", "while"),
    (["https"], r"\bhttps\b", "http"),
]

# Licence texts and one-line notices with their SPDX identifiers.
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
          "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
          "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
            "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
            "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
          "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
          "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
          "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
          "distribution.\n\n")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
          "derived from this software without specific prior written permission.\n\n")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
        "{0}\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.")
KNOWN: list[tuple[str, str]] = [
    ("MIT", "MIT License\n\nCopyright (c) 2000 Holder\n\nPermission is hereby granted, free of charge, to any person obtaining a copy "
            'of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software.\n\n" + _AS_IS),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
    ("ISC", _ISC.format(", provided that the above copyright notice and this permission notice appear in all copies.")),
    ("0BSD", _ISC.format(".")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
]


def canonical_line(line: Column) -> Column:
    """One line: copyright lines vanish, the rest in lower case with single spaces for punctuation."""
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(line, COPYRIGHT_LINE, ""), PUNCTUATION, " ")))


def equal_spellings(canonical: Column) -> Column:
    """One spelling for each word of ``SPELLINGS`` (a lambda variable holds each step, so it is computed once)."""
    def spelled(triggers, pattern, to):
        def step(x):
            there = reduce(lambda a, b: a | b, [F.contains(x, F.lit(t)) for t in triggers])
            return F.when(there, F.regexp_replace(x, pattern, to)).otherwise(x)
        return step
    for rule in SPELLINGS:
        canonical = let(canonical, spelled(*rule))
    return canonical


def known_licenses(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """The built-in (license_id, text) table as a local relation of known size."""
    rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in known])
    return spark.range(1).select(F.inline(rows))


def _lines(text: str) -> Column:
    """Canonical lines of a text that are not empty."""
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: equal_spellings(canonical_line(x)))
    return F.filter(lines, lambda x: x != "")


def _units(text: str) -> Column:
    """Digests of the whole canonical text (first) and of each canonical line."""
    def digests(lines):
        whole = equal_spellings(F.array_join(lines, " "))
        return F.concat(F.array(F.sha2(whole, 256)), F.transform(lines, lambda x: F.sha2(x, 256)))
    return let(_lines(text), digests)


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``canonical_sha256``, ``license_id``, ``n_notice_lines``, ``notices``.

    ``license_id``: known licence whose canonical text equals the whole canonical text (the smallest id
    if several do), else null. ``notices``: sorted distinct ids of known texts that equal a whole line,
    comma-joined (empty string if none); ``n_notice_lines``: such lines. A null text counts as empty; an
    empty canonical text matches nothing. Other columns of the input are ignored, so names cannot clash;
    rows that repeat an id and a text get the same result each. Empty input gives an empty result.
    """
    digests = (known.select("license_id", _units("text")[0].alias("digest"))
               .filter(F.col("digest") != F.sha2(F.lit("").cast("binary"), 256))
               .groupBy("digest").agg(F.min("license_id").alias("license_id")))
    units = docs.select(F.col(id_col).alias("id"), _units(text_col).alias("units"))
    units = units.select("id", F.col("units")[0].alias("canonical_sha256"), F.posexplode("units").alias("at", "digest"))
    whole, line = F.col("at") == 0, F.col("at") > 0
    found = (units.join(digests, "digest", "left").groupBy("id", "canonical_sha256")
             .agg(F.count_if(whole).alias("rows"), F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
                  F.count(F.when(line, F.col("license_id"))).alias("lines"),
                  F.collect_set(F.when(line, F.col("license_id"))).alias("notices")))
    return found.select(
        F.col("id").alias(id_col), "canonical_sha256", "license_id", (F.col("lines") / F.col("rows")).cast("long").alias("n_notice_lines"),
        F.array_join(F.array_sort("notices"), ",").alias("notices"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_")).drop("_")


def oracle(known: list[tuple[str, str]] = KNOWN) -> str:
    """DuckDB SQL of ``scan`` over ``documents`` with the built-in table."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    line = (f"trim(lower(regexp_replace(regexp_replace(l, {q(COPYRIGHT_LINE)}, '', 'g'), {q(PUNCTUATION)}, ' ', 'g')))")

    def digest(x: str) -> str:
        for _, pattern, to in SPELLINGS:
            x = f"regexp_replace({x}, {q(pattern)}, {q(to.replace('$', chr(92)))}, 'g')"
        return f"sha256({x})"

    def lines(t: str) -> str:
        return f"list_filter(list_transform(string_split(coalesce({t}, ''), chr(10)), lambda l: {line}), lambda x: x <> '')"
    whole = digest("array_to_string(lines, ' ')")
    values = ", ".join(f"({q(i)}, {q(t)})" for i, t in known)
    return f"""
WITH k AS (SELECT {whole} AS digest, min(license_id) AS license_id
           FROM (SELECT license_id, {lines('text')} AS lines FROM (VALUES {values}) v(license_id, text))
           GROUP BY 1 HAVING digest <> sha256('')),
d AS (SELECT doc_id, lines, {whole} AS canonical_sha256 FROM (SELECT doc_id, {lines('text')} AS lines FROM documents)),
n AS (SELECT doc_id, count(*) AS n_notice_lines, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
      FROM (SELECT doc_id, {digest('line')} AS digest FROM (SELECT doc_id, unnest(lines) AS line FROM d)) JOIN k USING (digest)
      GROUP BY doc_id)
SELECT d.doc_id, canonical_sha256, k.license_id, coalesce(n_notice_lines, 0) AS n_notice_lines, coalesce(notices, '') AS notices
FROM d LEFT JOIN k ON k.digest = canonical_sha256 LEFT JOIN n ON n.doc_id = d.doc_id"""
