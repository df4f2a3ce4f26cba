"""Licence scan by canonical digests.

A text is brought to a canonical form: A-Z in lower case, copyright lines out, everything but letters,
digits and bytes beyond ASCII to single spaces, and equivalent spellings to one of them. Two texts that
differ in nothing else have equal digests, and licences are found by joining digests of entire texts to
a table of known ones. Units are the whole document and each of its lines (short notices), so a licence
file and a notice above other text are both found.

The steps are regular expressions that Java, RE2 and Python read alike.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Copyright lines carry a year, a (c) or a "by" after the word; the sign alone is enough.
COPYRIGHT_LINES = "(?m)^[ \\t#*/;>-]*(copyright[^\\n]*([0-9]{4}|\\(c\\)|©| by )|\\(c\\)|©)[^\\n]*$"
NOT_WORDS = "[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+"
#: Taken out of the words before anything else.
RESERVED = "all rights reserved"
#: (pattern, replacement) on words set apart by single spaces.
EQUIVALENTS = (
    ("licenc", "licens"),
    ("sub licens", "sublicens"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("programme", "program"),
    ("https", "http"),
    ("(organ|author|real|recogn|util|maxim|minim|custom)is(e|ing|ation)", "\\1iz\\2"),
    ("(behavi|fav|hon|lab|col)our", "\\1or"),
    ("(judg|acknowledg)ement", "\\1ment"),
    ("(ana|cata)logue", "\\1log"),
    ("version ([0-9])", "\\1"),
    ("gnu general public license", "gnu gpl"),
    ("creative commons attribution noncommercial", "cc by nc"),
)
SPACES = " +"

#: Licence identifiers, and the titles that notices call them by.
IDENTIFIERS = (
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-1.0-Perl", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0",
    "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GFDL-1.2-only", "GFDL-1.3-only", "GPL-1.0-only", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "NCSA", "OFL-1.1", "PSF-2.0", "PostgreSQL", "Python-2.0", "Unlicense",
    "WTFPL", "Zlib",
)
TITLES = (
    ("0BSD", "BSD Zero Clause License"), ("AGPL-3.0-only", "GNU Affero General Public License, version 3"), ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License 2.0"), ("Artistic-2.0", "Artistic License 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSL-1.0", "Boost Software License, Version 1.0"), ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"), ("CC0-1.0", "CC0 1.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"), ("GPL-2.0-only", "GNU General Public License, version 2"),
    ("GPL-3.0-only", "GNU General Public License, version 3"), ("ISC", "ISC License"), ("LGPL-2.1-only", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0-only", "GNU Lesser General Public License, version 3"), ("MIT", "MIT License"), ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("OFL-1.1", "SIL Open Font License, Version 1.1"), ("Unlicense", "Unlicense"), ("Zlib", "zlib License"),
)

#: Notices, as the whole of a document or of a line, follow from identifiers and titles.
NOTICES = tuple((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS) + tuple(
    (name, f"{verb} under {the}{title}.")
    for name, title in TITLES
    for verb in ("Licensed", "Released", "Distributed", "This work is licensed", "This software is licensed", "This project is licensed")
    for the in ("", "the ")
)

#: SHA-256 of the canonical form, licence, its characters and its first letters, of longer texts as they
#: are widely handed out.
FULL_TEXTS = (
    ("57e0f04b77c0b3fccb21dd87eb45573aa7f9f59db52958a593734a8aa9d332e0", "GPL-1.0-only", 11644, "gnu"),
    ("2b50b92178e36e02edc928c41a62b965bd0332022ff255808cb23e794de83c98", "GPL-2.0-only", 16977, "gnu"),
    ("69363b41aa00131ad715b6e6d99940870eabeb2a5706891feb5d5c8df36d084d", "GPL-3.0-only", 33117, "gnu"),
    ("420c1993976c66f4f85b5e7eb052a6522e1e37fc36efbca653d1ad059c5e4cf0", "LGPL-2.0-only", 23912, "gnu"),
    ("9ef802de954d9c30689daeab807edf3d22f808abccc54551096d1292e398e7b9", "LGPL-2.1-only", 24999, "gnu"),
    ("c15236b1a2318d6cdd819a5f6152950e890090bca8f0fed682a24765bb8b467a", "LGPL-3.0-only", 7034, "gnu"),
    ("787dd1d38d62953e60651e2fd45059be6b2c16b648335e4733abe000a678dcd0", "GFDL-1.2-only", 19516, "gnu"),
    ("33303147870e661537b500bab38b975c2a7477da807f1af8fe08c63b615bb8e1", "GFDL-1.3-only", 21951, "gnu"),
    ("098717a71bfb0ab35d9ee4e1fb96b9a0ae1a7e15eb9dba48edfdabc0ea1817d0", "MPL-1.1", 22287, "moz"),
    ("f6fc391d67185b0472ee197c6073766dbe07862da8f7f3ce6eae8904d73f94ac", "MPL-2.0", 14197, "moz"),
    ("28612f089fd6424ed448e41916e9b07fd505ea84a8662fdc5d3e49584f1f9354", "Apache-2.0", 9850, "apa"),
    ("edbf4eaff2ba49d1f352a0fc3eece51bfbe70f3403e225731a48cf68ece94098", "Apache-2.0", 8802, "apa"),
    ("0011e8f496cb698757f47b1b62db84746a61d096bac67f09d1df7df23ba840d9", "Apache-2.0", 8774, "apa"),
    ("2df6dd1bc44ede7d0176c925e86755e02917a1d0e04394be024fb17a93698ba3", "Apache-2.0", 493, "lic"),
    ("22d243c2fc90be48e05353a423c45b7c3be42e06805d8ad73eb2a4debe364967", "Artistic-1.0-Perl", 5825, "the"),
    ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "CC0-1.0", 6692, "cre"),
    ("21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651", "BSD-3-Clause", 1361, "red"),
)
WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + WARRANTY
)
PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
ISC = PERMISSION + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + DISCLAIMER
CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
THIRD_CLAUSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
HOLDERS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors "
    "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
    "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be "
    "an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
    + WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
    + "\n\nFor more information, please refer to <https://unlicense.org>"
)
#: Each may stand alone or below its title.
TEXTS = tuple(
    (name, title + text)
    for name, titles, text in (
        ("MIT", ("", "MIT License\n\n", "The MIT License\n\n", "The MIT License (MIT)\n\n"), MIT),
        ("ISC", ("", "ISC License\n\n", "The ISC License\n\n"), ISC),
        ("0BSD", ("", "BSD Zero Clause License\n\n", "Zero-Clause BSD\n\n"), PERMISSION + ".\n\n" + DISCLAIMER),
        ("BSD-2-Clause", ("", "BSD 2-Clause License\n\n", "The BSD 2-Clause License\n\n"), CLAUSES + HOLDERS),
        ("BSD-2-Clause", ("", "BSD 2-Clause License\n\n"), (CLAUSES + HOLDERS).replace("1. ", "* ").replace("2. ", "* ")),
        ("BSD-3-Clause", ("", "BSD 3-Clause License\n\n", "The BSD 3-Clause License\n\n"), CLAUSES + THIRD_CLAUSE + HOLDERS),
        ("BSD-3-Clause", ("", "BSD 3-Clause License\n\n"), (CLAUSES + THIRD_CLAUSE + HOLDERS).replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")),
        ("Unlicense", ("",), UNLICENSE),
    )
    for title in titles
)


def canonical_text(text: str) -> str:
    """The canonical form, for the table of known licences."""
    text = re.sub(COPYRIGHT_LINES, "", text.translate(str.maketrans(UPPER, LOWER)))
    text = " " + re.sub(NOT_WORDS, " ", text).replace(RESERVED, "") + " "
    for pattern, to in EQUIVALENTS:
        text = re.sub(pattern, to, text)
    return re.sub(SPACES, " ", text).strip(" ")


#: So many first letters of the canonical form are looked at before the whole is made.
HEAD = 3
#: Equivalents that change them: first letters before, and what the canonical form may begin with.
HEADS = (("ver", "0123456789"), ("cre", "cc"))

Known = tuple[str, str, int, str]


def known_digests(known: tuple[tuple[str, str], ...] = NOTICES + TEXTS, full: tuple[Known, ...] = FULL_TEXTS) -> list[Known]:
    """(digest, licence, characters and first letters of the canonical form), each digest once."""
    found = {digest: tuple(more) for digest, *more in full}
    for name, text in known:
        canonical = canonical_text(text)
        found[hashlib.sha256(canonical.encode()).hexdigest()] = (name, len(canonical), canonical[:HEAD].strip(" "))
    return [(digest, *more) for digest, more in sorted(found.items())]


def heads(known: list[Known]) -> list[str]:
    """First letters of words that may become the canonical form of a known text."""
    first = {head for _, _, _, head in known}
    return sorted(first | {before for before, after in HEADS if any(head[:1] in after if before == "ver" else head == after for head in first)})


#: No equivalent spelling is shorter than a sixth of what it stands for.
SHRINKS = 6


def words_only(text: Column) -> Column:
    folded = F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT_LINES, "")
    words = F.replace(F.regexp_replace(folded, NOT_WORDS, " "), F.lit(RESERVED), F.lit(""))
    return F.concat(F.lit(" "), words, F.lit(" "))


def may_be_known(words: Column, known: list[Known]) -> Column:
    """False only for words whose canonical form is none of the known: cheap, and looks at few of them."""
    head = F.substring(F.ltrim(words), 1, HEAD)
    return F.trim(head).isin(heads(known)) | F.contains(head, F.lit("  "))


def digest(words: Column, known: list[Known]) -> Column:
    """Digest of the canonical form; NULL if by length or beginning it is sure to be none of the known."""
    longest = max([n for _, _, n, _ in known], default=0)
    text = words
    for pattern, to in EQUIVALENTS:
        text = F.regexp_replace(text, pattern, to.replace("\\", "$"))
    canonical = F.trim(F.regexp_replace(text, SPACES, " "))
    fits = F.char_length(F.regexp_replace(words, SPACES, " ")) <= SHRINKS * longest + 2
    return F.when(may_be_known(words, known) & fits, F.sha2(canonical, 256))


def scan(docs: DataFrame, known: list[Known], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with license (of the whole text), line_licenses (sorted), n_license_lines.

    A text that is NULL or empty has no licence: NULL, an empty array, and 0. Rows that repeat are looked
    up each. Columns of ``keep`` with the names of outputs give way.
    """
    keep = [c for c in keep if c not in ("license", "line_licenses", "n_license_lines")]
    table = docs.sparkSession.createDataFrame([x[:2] for x in known], "_digest string, _name string")
    rows = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_text", F.col("text").cast("string"))
    whole = F.array(F.struct(words_only(F.col("_text")).alias("words"), F.lit(False).alias("is_line")))
    lines = F.transform(F.split("_text", "\n"), lambda line: F.struct(words_only(line).alias("words"), F.lit(True).alias("is_line")))
    lines = F.filter(lines, lambda unit: may_be_known(unit["words"], known))
    units = rows.select("_row", *keep, F.explode(F.concat(whole, F.coalesce(lines, F.array_repeat(whole[0], 0)))).alias("_unit"))
    units = units.select("_row", *keep, digest(F.col("_unit.words"), known).alias("_digest"), F.col("_unit.is_line").alias("_is_line")).join(table, "_digest", "left")
    # A row's units are in one task, so a row is what each leaves for the shuffle.
    found = units.groupBy("_row").agg(
        *(F.first(c).alias(c) for c in keep),
        F.max(F.when(~F.col("_is_line"), F.col("_name"))).alias("license"),
        F.sort_array(F.collect_set(F.when(F.col("_is_line"), F.col("_name")))).alias("line_licenses"),
        F.count(F.when(F.col("_is_line"), F.col("_name"))).alias("n_license_lines"),
    )
    return found.drop("_row")


def oracle_sql(known: list[Known]) -> str:
    """The scan of ``documents`` in DuckDB's SQL, as rows (doc_id, license, line_licenses, n_license_lines)."""

    def canonical(text: str) -> str:
        out = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '{COPYRIGHT_LINES}', '', 'g')"
        out = f"(' ' || replace(regexp_replace({out}, '{NOT_WORDS}', ' ', 'g'), '{RESERVED}', '') || ' ')"
        for pattern, to in (*EQUIVALENTS, (SPACES, " ")):
            out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
        return f"sha256(trim({out}, ' '))"

    values = ", ".join(f"('{digest}', '{name}')" for digest, name, *_ in known)
    return f"""
WITH known(digest, name) AS (VALUES {values}),
units AS (
  SELECT doc_id, {canonical("text")} AS digest, false AS is_line FROM documents
  UNION ALL
  SELECT doc_id, {canonical("line")}, true FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
found AS (SELECT u.doc_id, u.is_line, k.name FROM units u JOIN known k USING (digest))
SELECT d.doc_id, max(name) FILTER (NOT is_line) AS license,
  array_to_string(coalesce(list_sort(list_distinct(list(name) FILTER (is_line))), []), ',') AS line_licenses,
  count(name) FILTER (is_line) AS n_license_lines
FROM documents d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id"""
