"""Licences by canonical digest: a whole text, or a whole line, is looked up among known licence texts.

Canonical form: lower case, no copyright lines, no title lines and no list marks, nothing but letters and digits
between single spaces, and one spelling of words that licences spell in two ways. List marks (a number, a letter or a
Roman number with a dot or bracket, opening a line) go from texts that speak of licences, permission or warranty.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that count as equal, the second standing for both.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("copyright holders", "copyright owners"),
    ("copyright holder", "copyright owner"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "wilfull"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("http", "https"),
]

# Known licence texts and notices.
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN_TEXTS = [
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
        + _AS_IS,
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
"""
        + _AS_IS,
    ),
    ("BSD-2-Clause", f"{_BSD_CONDITIONS}\n{_BSD_DISCLAIMER}"),
    (
        "BSD-3-Clause",
        f"""{_BSD_CONDITIONS}
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
{_BSD_DISCLAIMER}""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "BSL-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to
whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction
and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative
works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in
perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org/>""",
    ),
    (
        "Apache-2.0 header",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    ),
    *[
        (
            f"{short}-{version}.0-or-later header",
            f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU
{name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any
later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
        )
        for short, name in [("GPL", "General Public License"), ("AGPL", "Affero General Public License")]
        for version in ([2, 3] if short == "GPL" else [3])
    ],
    (
        "MPL-2.0 header",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("MIT notice", "Released under the MIT License."),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
]

COPYRIGHT_LINE = (
    r"(^|\n)[^\p{L}\p{N}\n]*(copyright\s*(\(c\)|©|[0-9]{4}|[\[<])|\(c\)\s*[0-9]{4}|©|all rights reserved)[^\n]*"
)

#: Lines of nothing but the name of a licence, as files of it open with.
TITLE_LINE = (
    r"(^|\n)[^\p{L}\p{N}\n]*(the\s+)?(mit|expat|isc|x11|zlib|unlicense|boost software"
    r"|((new|modified|revised|simplified)\s+)?bsd([ -][0-9][ -]clause)?(\s+zero[ -]clause)?|[0-9][ -]clause\s+bsd|0bsd)"
    r"(\s+licen[cs]e)?([\s,-]+version\s+[0-9.]+|\s+[0-9.]+)?(\s*\([^)\n]*\))?[^\p{L}\p{N}\n]*(\n|\z)"
)
LIST_MARK = r"(^|\n)[ \t]*\(?([0-9]{1,2}|[a-z]|[ivx]{1,4})[.)][ \t]+"
#: Words of which a text has one if its list marks go.
LICENCE_WORDS = ["licen", "permi", "warrant"]


def _variants() -> str:
    return "|".join(a.replace(" ", "  ") for a, _ in SPELLINGS)


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty for null and for texts without letters and digits."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    plain = F.when(
        lower.rlike(r"copyright|\(c\)|©|all rights reserved"), F.regexp_replace(lower, COPYRIGHT_LINE, "$1")
    ).otherwise(lower)
    terms = reduce(or_, [F.contains(lower, F.lit(w)) for w in LICENCE_WORDS])
    untitled = F.regexp_replace(F.regexp_replace(plain, TITLE_LINE, "\n"), LIST_MARK, "$1")
    plain = F.when(terms, untitled).otherwise(plain)
    wide = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))
    spelled = wide
    for a, b in SPELLINGS:
        spelled = F.replace(spelled, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    one = F.when(wide.rlike(_variants()), spelled).otherwise(wide)
    return F.trim(F.replace(one, F.lit("  "), F.lit(" ")))


def canonical_sql(text: str) -> str:
    """The same in DuckDB SQL."""
    lower = f"lower(coalesce({text}, ''))"
    plain = rf"regexp_replace({lower}, '{COPYRIGHT_LINE}', '\1', 'g')"
    terms = " OR ".join(f"contains({lower}, '{w}')" for w in LICENCE_WORDS)
    untitled = rf"regexp_replace(regexp_replace({plain}, '{TITLE_LINE}', chr(10), 'g'), '{LIST_MARK}', '\1', 'g')"
    plain = f"CASE WHEN {terms} THEN {untitled} ELSE {plain} END"
    wide = rf"' ' || trim(regexp_replace({plain}, '[^\p{{L}}\p{{N}}]+', '  ', 'g')) || ' '"
    for a, b in SPELLINGS:
        wide = f"replace({wide}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    return f"trim(replace({wide}, '  ', ' '))"


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN_TEXTS) -> DataFrame:
    """`license`, `digest`: one row for each known text."""
    return spark.createDataFrame(texts, "license string, text string").select("license", digest(F.col("text")).alias("digest"))


def _opening(spark: SparkSession, texts: list[tuple[str, str]]) -> str:
    """A pattern for lower-case lines that open with a word some known text opens with, in any spelling."""
    known = spark.createDataFrame(texts, "license string, text string")
    opened = known.select(F.split(canonical(F.col("text")), " ")[0].alias("word")).distinct().collect()
    words = {r.word for r in opened if r.word}  # of a fixed list
    while more := {a.split()[0] for a, b in SPELLINGS if b.split()[0] in words} - words:
        words |= more
    mark = LIST_MARK.replace(r"(^|\n)", "")
    return rf"^(?:{mark})?[^\p{{L}}\p{{N}}]*(?:{'|'.join(sorted(words))})(?![\p{{L}}\p{{N}}])"


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", texts: list[tuple[str, str]] = KNOWN_TEXTS
) -> DataFrame:
    """For every row key, `digest` of the whole text, `license` if it is a known one, and `line_licenses`, the
    known licences that single lines of it are, sorted, once each, joined by commas (empty without).

    Texts that are null or without letters and digits, and those of title and copyright lines alone, have the
    digest of the empty text and no licence; equal
    texts get equal results and repeated rows stay. The known texts, a fixed list, are the broadcast side of
    both joins, so a text or line that a third of all rows have is no hot key. A line whose first word opens no
    known text in any spelling can be none of them and goes before its canonical form is made.
    """
    known = F.broadcast(known_licenses(docs.sparkSession, texts))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    whole = rows.select("_key", F.xxhash64("_text").alias("_hash"), digest(F.col("_text")).alias("digest"))
    whole = whole.join(known, "digest", "left")
    lines = rows.select("_key", F.xxhash64("_text").alias("_hash"), F.explode(F.split("_text", "\n")).alias("_line"))
    lines = lines.where(F.lower("_line").rlike(_opening(docs.sparkSession, texts)))
    found = lines.select("_key", "_hash", digest(F.col("_line")).alias("digest")).join(known, "digest")
    per_text = found.groupBy("_key", "_hash").agg(F.collect_set("license").alias("_found"))
    per_text = per_text.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "_found")
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))
    return whole.join(per_text, same, "left").select(
        F.col("_key").alias(key),
        "digest",
        "license",
        F.coalesce(F.array_join(F.array_sort("_found"), ","), F.lit("")).alias("line_licenses"),
    )
