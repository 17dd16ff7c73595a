"""License scans: canonical digests of entire texts, hash-joined to the digests of known licenses.

A text's canonical form has ASCII lower case, one spelling of each word that licenses spell in several ways, no punctuation, one
blank between words, and no copyright lines: those that begin with the word or mark, unless a word follows that licenses use in
their own sentences (``copyright notice``). A text is a license if its canonical form's SHA-256 is one. Each of its lines is
looked up as an entire text too, so that notices are found in longer texts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.operators.dimensions import literal_dim

# Spellings that count as one, applied in this order to lower-case text.
SPELLINGS = [
    ("©", "copyright "), ("copyright (c)", "copyright "), ("(c) 1", "copyright 1"), ("(c) 2", "copyright 2"),
    ("(c)1", "copyright 1"), ("(c)2", "copyright 2"), ("licence", "license"), ("licencing", "licensing"), ("licencor", "licensor"),
    ("sub-license", "sublicense"), ("non-infringement", "noninfringement"), ("non-commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("behaviour", "behavior"), ("organisation", "organization"),
    ("organised", "organized"), ("authorised", "authorized"), ("recognised", "recognized"), ("merchantibility", "merchantability"),
    ("judgement", "judgment"), ("fulfilment", "fulfillment"), ("per cent", "percent"), ("https:", "http:"), ("&", " and "),
]
NOT_WORDS = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"
RESERVED = "all rights reserved"
# Words after "copyright" in a license's own sentences.
BODY_WORDS = [
    "and", "disclaimer", "holder", "holders", "in", "interest", "interests", "law", "laws", "license", "licenses", "notice", "notices",
    "on", "or", "owner", "owners", "protection", "rights", "statement", "statements", "to",
]
NOTICE_LINE, BODY_LINE = "^copyright( |$)", f"^copyright s? ?({'|'.join(BODY_WORDS)})( |$)"

# Known licenses, as notices and as whole texts.
LICENSES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate
any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large
and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin
of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must
be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or
altered from any source distribution."""),
]
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: {}Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. {}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_NAMES = """{}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT {} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# The two usual BSD licenses, their items with numbers or bullets, and with either word for the holder.
for _holder in ("HOLDER OR CONTRIBUTORS", "OWNER OR CONTRIBUTORS"):
    for _marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* ")):
        _start, _end = _BSD_GRANT.format(*_marks[:2]), _BSD_END.format(_holder)
        LICENSES += [("BSD-2-Clause", _start + _end), ("BSD-3-Clause", _start + _BSD_NAMES.format(_marks[2]) + _end)]
# Lines that whole texts may begin with.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"], "Zlib": ["zlib License", "The zlib License"],
    "Unlicense": ["The Unlicense"],
}
# a notice is one short line, and has no title
LICENSES += [(name, f"{title}\n{text}") for name, text in LICENSES if len(text) > 100 for title in TITLES.get(name, [])]

# Digests of the canonical forms of longer licenses as Linux distributions ship them, whole, and up to the line
# "END OF TERMS AND CONDITIONS" with it and without it, where they have one (tests/llm/test_licenses.py works them out anew).
DIGESTS = [
    ("Apache-2.0", "6fb8411669deea22294b6190fad00b8e39899d0b7b6c5cf97a3b15b47e129c38"),
    ("Apache-2.0", "75acde0fb516a7ba4597dfc23680cf78281f7fae7f3b74a78e06ef83c1c375c6"),
    ("Apache-2.0", "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "80188d2eb86384574b90534ba98aa2e4373d868aeb5f6323b35189e4b2b5d318"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "fca9d0597eee5ef85465916ba61b41fd1ec4ba0a53efd599baa65c1a5b426a9b"),
    ("GPL-3.0", "1d243e2f686217287f22005b96a11843e555353b8f4a92eea0ec5f532d924007"),
    ("GPL-3.0", "789cfdaa68e3e7b25001092df47b2616af9d2361910cd86a6291d51a6cef4c9f"),
    ("GPL-3.0", "92f86bbf16b3c7beaf4c1a82ea5d81b358634e9123c8790121ec9fe76310a506"),
    ("LGPL-2.0", "289c8b47fa0ec7e5f22cd33d32feaa06f015b0f2fdb9ad916979b1011ca8c015"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "5ddd6039d3b090c51328879800301dd19b1ad99e14d00f3c6f221ab45a32db57"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "95ca46e7caa592226577aa45fd8b27c4bf4bac63553c3e2549dcf780acb73d52"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]


def canonical_lines(text: Column) -> Column:
    """A text's canonical lines; none if it is null or has no words but copyright lines."""
    spelled = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    for one, other in SPELLINGS:
        spelled = F.replace(spelled, F.lit(one), F.lit(other))
    lines = F.transform(F.split(F.regexp_replace(spelled, NOT_WORDS, " "), "\n"), lambda line: F.trim(line))
    return F.filter(
        lines, lambda line: (line != "") & (line != RESERVED) & (~line.rlike(NOTICE_LINE) | line.rlike(BODY_LINE))
    )


def digest(lines: Column) -> Column:
    return F.sha2(F.array_join(lines, " ").cast("binary"), 256)


def known_licenses(spark: SparkSession, licenses: list[tuple[str, str]] = LICENSES) -> DataFrame:
    schema = T.StructType([T.StructField("license", T.StringType()), T.StructField("text", T.StringType())])
    return literal_dim(spark, licenses, schema)


def known_digests(spark: SparkSession, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    schema = T.StructType([T.StructField("license", T.StringType()), T.StructField("digest", T.StringType())])
    return literal_dim(spark, digests, schema)


def scan(
    docs: DataFrame, licenses: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    license_column: str = "license", license_text_column: str = "text", digests: DataFrame | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``digest``, ``license``, ``n_notices``, ``notices``.

    ``license`` is that of the entire text, else null. ``notices`` are the distinct licenses of lines that are an entire known
    text, in alphabetic order. If several licenses have one canonical text, the first by name counts; known texts without words
    count as none. ``digests`` (``license``, ``digest``) are canonical forms known by their SHA-256 alone. Null and empty texts have the empty text's digest and no license. Rows equal in id and digest are counted, and
    come out as often. An empty table gives an empty one. Other columns are ignored.
    """
    known = licenses.select(
        F.col(license_column).alias("found"), canonical_lines(F.col(license_text_column)).alias("lines")
    ).where(F.size("lines") > 0).select("found", digest(F.col("lines")).alias("known"))
    if digests is not None:
        known = known.union(digests.select("license", "digest"))
    known = known.groupBy("known").agg(F.min("found").alias("found"))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), canonical_lines(F.col(text_column)).alias("lines")
    ).select("doc_id", digest(F.col("lines")).alias("digest"), "lines")
    # a text's lines, after the text itself
    texts = rows.select("doc_id", "digest", F.posexplode(F.concat(F.array("digest"), F.transform(
        "lines", lambda line: F.sha2(line.cast("binary"), 256)
    ))).alias("place", "looked_up"))
    matched = texts.join(known, F.col("looked_up") == F.col("known"), "left").where("place = 0 or found is not null")
    grouped = matched.groupBy("doc_id", "digest").agg(
        F.count(F.when(F.col("place") == 0, 1)).cast("int").alias("copies"),
        F.max(F.when(F.col("place") == 0, F.col("found"))).alias("license"),
        F.sort_array(F.collect_set(F.when(F.col("place") > 0, F.col("found")))).alias("notices"),
    )
    return grouped.select(
        "doc_id", "digest", "license", F.size("notices").cast("long").alias("n_notices"),
        F.array_join("notices", ",").alias("notices"), F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    ).drop("copy")


def result(docs: DataFrame) -> DataFrame:
    return scan(docs, known_licenses(docs.sparkSession), digests=known_digests(docs.sparkSession))


def oracle() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def lines(text: str) -> str:
        spelled = f"translate(coalesce({text}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
        for one, other in SPELLINGS:
            spelled = f"replace({spelled}, {quoted(one)}, {quoted(other)})"
        spelled = f"regexp_replace({spelled}, '{NOT_WORDS}', ' ', 'g')"
        return f"""list_filter(list_transform(string_split({spelled}, chr(10)), lambda x: trim(x, ' ')),
            lambda x: x <> '' and x <> '{RESERVED}' and (not regexp_matches(x, '{NOTICE_LINE}') or regexp_matches(x, '{BODY_LINE}')))"""

    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in LICENSES)
    digests = ", ".join(f"('{name}', '{known}')" for name, known in DIGESTS)
    return rf"""
    with licenses(license, text) as (values {values}),
    known as (
        select known, min(license) as found from (
            select sha256(array_to_string(lines, ' ')) as known, license
            from (select license, {lines("text")} as lines from licenses) where len(lines) > 0
            union all select known, license from (values {digests}) as t(license, known)) group by known),
    rows_ as (select row_number() over () as row, doc_id, {lines("text")} as lines from documents),
    notices as (
        select row, count(distinct found) as n, string_agg(distinct found, ',' order by found) as notices
        from (select row, sha256(unnest(lines)) as line from rows_) join known on line = known group by row)
    select doc_id, sha256(array_to_string(lines, ' ')) as digest, found as license, coalesce(n, 0) as n_notices,
        coalesce(notices, '') as notices
    from rows_ left join known on sha256(array_to_string(lines, ' ')) = known left join notices using (row)"""
