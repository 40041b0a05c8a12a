"""Licence scan by canonical digest.

A text is normalised: lower case, copyright statements dropped, spellings made equal,
everything but letters and digits turned to single spaces. The SHA-256 of the whole
normalised text is looked up, by a hash join, among the digests of known licence
texts. Entire texts are meant: a document that is a licence, whatever its line
breaks, punctuation or copyright holder. Notices that stand as a line of their own in
a document are looked up by the same digests, line by line.

The known texts are a parameter, a DataFrame (license_id, text). By default they are
KNOWN, short public licences and notices, and KNOWN_DIGESTS, the digests of long public
ones. Of the lines of a document only those are normalised that have the longest word of
a known text of one line. All is built-in functions, so that plans stay in the JVM.

Null and empty texts have the digest of the empty text, which is no licence. Two known
texts with one digest count as the id that sorts first. Rows are looked up one by one,
repeated ones too. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, from public licence matching practice.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("authorise", "authorize"),
    ("recognise", "recognize"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("fulfil", "fulfill"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZERO_BSD = "\n".join(("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", _ISC.split("\n")[1]))
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <{0}://unlicense.org/>"""
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def _titled(text: str, *titles: str) -> tuple[str, ...]:
    return (text, *(f"{t}\n{text}" for t in titles))


# Short public licence texts and notices.
KNOWN = {
    "MIT": _titled(_MIT, "MIT License", "The MIT License (MIT)", "The MIT License"),
    "ISC": _titled(_ISC, "ISC License", "The ISC License"),
    "0BSD": _titled(_ZERO_BSD, "BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": _titled("\n".join((_BSD_HEAD, _BSD_1, _BSD_2, _BSD_END)), "BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": _titled("\n".join((_BSD_HEAD, _BSD_1, _BSD_2, _BSD_3, _BSD_END)), "BSD 3-Clause License", "The 3-Clause BSD License"),
    "Zlib": _titled(_ZLIB, "zlib License", "The zlib/libpng License"),
    "Unlicense": (*(_UNLICENSE.format(x) for x in ("http", "https")), "\n".join(_UNLICENSE.split("\n")[:-1])),
    "BSL-1.0": (_BOOST, _BOOST.split("\n", 1)[1]),
    "notice:MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "MIT License"),
    "notice:Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Apache License, Version 2.0"),
    "notice:GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."),
    "notice:CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "notice:CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "notice:CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "notice:CC0-1.0": ("Licensed under CC0 1.0.",),
    "notice:all-rights": ("All rights reserved.",),
}

# Digests of the canonical forms of long public licences.
KNOWN_DIGESTS = {
    "Apache-2.0": ("e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",),
    "Artistic-1.0-Perl": ("d1ce9579b2c8d32b706b421d9c42208152298e00849e57ce7da8e906ed3802f2",),
    "CC0-1.0": ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",),
    "GFDL-1.2": ("5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71",),
    "GFDL-1.3": ("93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6",),
    "GPL-1.0": ("9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c",),
    "GPL-2.0": ("efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",),
    "GPL-3.0": ("0d3c171c5c43c8ba6cb7c5850249fc6766dd85cca709271b31086b150e91716e",),
    "LGPL-2.0": ("5b313222545879140519fc4f8ac7558088e9529f29bda08d2b75946987652f50",),
    "LGPL-2.1": ("6ce9e9dc5005db9536b303ace5104e7d79eb77fa76f5ca2e335ea6401497ea1e",),
    "LGPL-3.0": ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",),
    "MPL-1.1": ("3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1",),
    "MPL-2.0": ("f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",),
    "BSD-3-Clause": ("3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9",),
}

# Words that follow "copyright" in the wording of licences. Where a line break comes between, the line is wording and no statement.
WORDING = ("and", "claim", "claims", "disclaimer", "for", "holder", "holders", "if", "in", "interest", "interests", "is", "law", "laws", "license", "licenses", "licence", "licences", "notice", "notices", "of", "on", "or", "owner", "owners", "ownership", "patent", "permission", "permissions", "protection", "right", "rights", "statement", "statements", "to", "treaty", "under")


def _both(letters: str) -> str:
    return letters + letters.upper()


def _other_than(words: tuple[str, ...]) -> str:
    """A regular expression for a word of letters that is none of these in any case, without looking ahead, which RE2 cannot."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    if not heads:
        return "[A-Za-z]+"
    other = "".join(c for c in "abcdefghijklmnopqrstuvwxyz" if c not in heads)
    return "(" + "|".join([f"[{_both(other)}][A-Za-z]*", *(f"[{_both(c)}]" + (rest if "" in tails else rf"({rest}|[^A-Za-z\n]|\b)") for c, tails in heads.items() for rest in [_other_than(tuple(tails))])]) + ")"


_SAYS = "".join(f"[{_both(c)}]" for c in "copyright")
# A line that begins with "copyright" and a year, a sign or a holder, with "(c)" and a year, or with the sign.
COPYRIGHT_LINE = r"(^|\n)[^\nA-Za-z0-9]*(" + _SAYS + r"[^\nA-Za-z0-9]*([0-9]|" + _other_than(WORDING) + ")|" + _SAYS + r"[ \t:]*[^\x00-\x7F]|\([cC]\)[^\n]*(19|20)[0-9][0-9]|©)[^\n]*"


def normalised(text: Column) -> Column:
    """The canonical form: words of a-z and 0-9 with single spaces between."""
    small = F.lower(text)
    said = small.contains("copyright") | small.contains("(c)") | small.contains("©")
    words = F.when(said, F.regexp_replace(text, COPYRIGHT_LINE, "$1")).otherwise(text)
    # two spaces between words, so that each has its own when spellings are replaced
    words = F.lower(F.concat(F.lit("  "), F.regexp_replace(words, "[^A-Za-z0-9]+", "  "), F.lit("  ")))
    for other, own in SPELLINGS:
        words = F.replace(words, F.lit(_spaced(other)), F.lit(f" {own} "))
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def _spaced(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def digest(text: Column) -> Column:
    return F.sha2(normalised(F.coalesce(text, F.lit(""))), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, t) for k, texts in KNOWN.items() for t in texts], "license_id string, text string")


def known_digests(texts: DataFrame) -> DataFrame:
    """(digest, license_id), one row for each digest; empty texts are no licence."""
    return texts.where(normalised(F.coalesce("text", F.lit(""))) != "").groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def default_digests(spark: SparkSession) -> DataFrame:
    long = spark.createDataFrame([(d, k) for k, found in KNOWN_DIGESTS.items() for d in found], "digest string, license_id string")
    return known_digests(known_texts(spark)).union(long).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def line_marks(texts: list[str]) -> list[str]:
    """Words of which every line that is one of the texts has one, in lower case: the longest that no replaced pair makes, in all its spellings. Texts of several lines need none."""
    made = {own for other, own in SPELLINGS if " " in other}
    found: set[str] = set()
    for text in texts:
        if "\n" in text.strip():
            continue
        words = set("".join(c if "a" <= c <= "z" or "0" <= c <= "9" else " " for c in text.lower()).split())
        words = {next((own for other, own in SPELLINGS if other == w), w) for w in words} - made
        longest = max(words, key=lambda w: (len(w), w), default="")
        found |= {longest, *(other for other, own in SPELLINGS if own == longest)}
    return sorted(found)


def scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license_id, notices) for each row of docs: the licence that the entire text is, or null, and the sorted ids of those that stand in it as lines, joined by commas.

    Lines are looked up before they are brought back to their documents: only lines that are a licence travel. Distinct documents are told apart by id and text hash.
    With texts given, every line is normalised, as the plan cannot know their words.
    """
    known = default_digests(docs.sparkSession) if texts is None else known_digests(texts)
    marks = line_marks([t for own in KNOWN.values() for t in own]) if texts is None else [""]
    own = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_row"), digest(F.col("text")).alias("digest"))

    def marked(text: Column) -> Column:
        small, out = F.lower(text), F.lit(False)
        for word in marks:
            out = out | small.contains(word)
        return out

    lines = docs.select("text", F.xxhash64("doc_id", "text").alias("_row")).where(marked(F.col("text"))).select("_row", F.explode(F.array_distinct(F.split("text", "\n"))).alias("_line"))
    lines = lines.where(marked(F.col("_line"))).select("_row", digest(F.col("_line")).alias("_d"))
    found = lines.join(known.withColumnRenamed("digest", "_d"), "_d").groupBy("_row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    whole = own.drop("text").join(known, "digest", "left").join(found, "_row", "left")
    return whole.select("doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices"))


def _sql_normalised(text: str) -> str:
    words = f"lower('  ' || regexp_replace(regexp_replace({text}, '{COPYRIGHT_LINE}', '\\1', 'g'), '[^A-Za-z0-9]+', '  ', 'g') || '  ')"
    for other, own in SPELLINGS:
        words = f"replace({words}, '{_spaced(other)}', ' {own} ')"
    return f"trim(replace({words}, '  ', ' '))"


def oracle_sql() -> str:
    """The same in DuckDB SQL."""
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, texts in KNOWN.items() for t in texts)
    digests = ", ".join(f"('{k}', '{d}')" for k, found in KNOWN_DIGESTS.items() for d in found)
    return f"""
WITH texts(license_id, text) AS (VALUES {values}),
long(license_id, d) AS (VALUES {digests}),
known AS (SELECT d, min(license_id) AS license_id FROM (SELECT sha256({_sql_normalised("text")}) AS d, license_id FROM texts UNION ALL SELECT d, license_id FROM long) GROUP BY 1),
whole AS (SELECT doc_id, coalesce(text, '') AS text, sha256({_sql_normalised("coalesce(text, '')")}) AS digest FROM documents),
lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM whole),
found AS (
  SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT DISTINCT doc_id, license_id FROM lines JOIN known ON sha256({_sql_normalised("line")}) = d) GROUP BY 1
)
SELECT w.doc_id, w.digest, k.license_id, coalesce(f.notices, '') AS notices
FROM whole w LEFT JOIN known k ON w.digest = k.d LEFT JOIN found f ON w.doc_id = f.doc_id
"""
