"""Licence texts, recognised by the digest of their canonical form.

A text is lower-cased, its copyright lines are dropped, everything but letters and digits
becomes one blank, equivalent spellings become one, and the whole is hashed. Documents
are hash-joined to the digests of known licence texts, each in its usual guises (with and
without title, with other list markers); single lines are looked up among the short
notices. Spark's own functions only; no row leaves its task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from functools import cache, reduce
from pathlib import Path

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import small_frame

# Public licence texts, without their titles, and usual short notices. Longer
# texts, with their titles, are the files of FOLDER, named by licence.
FOLDER = Path(__file__).parent / "license_texts"
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,'
    " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
    " PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_AUTHOR = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD'
    " TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN"
    " NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
    " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
    " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,"
    " ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list"
    " of conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution.\n"
)
_HOLDERS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY'
    " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES"
    " OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
    " SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,"
    " INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED"
    " TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR"
    " BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN"
    " CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY"
    " WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of"
    ' this software and associated documentation files (the "Software"), to deal in the'
    " Software without restriction, including without limitation the rights to use, copy,"
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
    " and to permit persons to whom the Software is furnished to do so, subject to the"
    " following conditions:\n\nThe above copyright notice and this permission notice shall"
    " be included in all copies or substantial portions of the Software.\n\n"
    + _AS_IS
    + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES"
    " OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
    " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose"
    " with or without fee is hereby granted, provided that the above copyright notice and"
    " this permission notice appear in all copies.\n\n" + _AUTHOR,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose"
    " with or without fee is hereby granted.\n\n" + _AUTHOR,
    "BSD-2-Clause": _REDISTRIBUTION + "\n" + _HOLDERS,
    "BSD-3-Clause": _REDISTRIBUTION
    + "3. Neither the name of the copyright holder nor the names of its contributors may be"
    " used to endorse or promote products derived from this software without specific prior"
    " written permission.\n\n" + _HOLDERS,
}
# Titles that may stand above a text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "0BSD": (
        "BSD Zero Clause License",
        "Zero-Clause BSD",
        "BSD Zero Clause License (0BSD)",
        "Zero-Clause BSD (0BSD)",
        "0BSD",
    ),
    "BSD-2-Clause": (
        "BSD 2-Clause License",
        "The BSD 2-Clause License",
        "The 2-Clause BSD License",
        'BSD 2-Clause "Simplified" License',
        "Simplified BSD License",
        "FreeBSD License",
        "BSD License",
        "The BSD License",
        "BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        "The BSD 3-Clause License",
        "The 3-Clause BSD License",
        'BSD 3-Clause "New" or "Revised" License',
        "New BSD License",
        "The New BSD License",
        "Modified BSD License",
        "BSD License",
        "The BSD License",
        "BSD-3-Clause",
    ),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "Zlib"),
    "Unlicense": ("The Unlicense", "Unlicense", "The Unlicense (Unlicense)"),
}
MARKER = re.compile(r"(?m)^[ \t]*([1-9])\. ")
# What a text's numbered items may begin with instead.
MARKERS = ("{n}. ", "* ", "{letter}. ", "{roman}. ")
# Passages that some copies have in other words.
WORDINGS = (
    ("permission notice shall", "permission notice (including the next paragraph) shall"),
    ("modify, and/or distribute", "modify, and distribute"),
    ("http://", "https://"),
    ("https://", "http://"),
)
# Appendices after this line are often left out.
END = "END OF TERMS AND CONDITIONS"
SPDX = (
    "0BSD AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0"
    " CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later"
    " GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later"
    " LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib"
).split()
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    # first lines, or those with the version, of the headers that licences recommend
    'Licensed under the Apache License, Version 2.0 (the "License");': "Apache-2.0",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not': "Apache-2.0",
    "License, v. 2.0. If a copy of the MPL was not distributed with this": "MPL-2.0",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.":
        "CC-BY-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
    " License.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
    " License.": "CC-BY-NC-4.0",
    "Licensed under the ISC License.": "ISC",
    "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
    "Licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "Licensed under the BSD 2-Clause License.": "BSD-2-Clause",
    "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
} | {f"SPDX-License-Identifier: {name}": name for name in SPDX}
# Spellings made one after normalising; every notice holds HINT, whatever its spelling.
SPELLINGS = {
    "licence": "license",
    "licenced": "licensed",
    "sub license": "sublicense",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "favour": "favor",
    "copyright owner": "copyright holder",
}
HINT = "licen"
OWNER_LINE = r"(?i)(^|\n)[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
NO_WORD = r"[^\p{L}\p{N}]+"
_KNOWN = T.StructType(
    [T.StructField("digest", T.StringType()), T.StructField("license", T.StringType())]
)


def canonical(text: Column) -> Column:
    """The canonical form of a text; NULL stays NULL."""
    plain = F.regexp_replace(text, OWNER_LINE, "\n")
    plain = F.trim(F.regexp_replace(F.lower(plain), NO_WORD, " "))
    return reduce(
        lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), SPELLINGS.items(), plain
    )


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def digest_of(text: str) -> str:
    """The same of one known text, without a plan that holds it."""
    plain = re.sub(OWNER_LINE, "\n", text)
    plain = regex.sub(NO_WORD, " ", plain.lower()).strip(" ")
    for old, new in SPELLINGS.items():
        plain = plain.replace(old, new)
    return hashlib.sha256(plain.encode()).hexdigest()


def known_digests(spark: SparkSession, texts: Mapping[str, str]) -> DataFrame:
    """(digest, license): a row per known text, as many as the caller names.

    Digests are taken beforehand, so that plans hold them and not the texts.
    """
    return small_frame(spark, list(digests_of(texts).items()), _KNOWN)


def digests_of(texts: Mapping[str, str]) -> dict[str, str]:
    """Licences by digest; of a form that several have, the first by name."""
    found: dict[str, str] = {}
    for body, name in texts.items():
        key = digest_of(body)
        found[key] = min(name, found.get(key, name))
    return found


def guises(name: str, body: str) -> Iterator[str]:
    """The forms in which a licence text usually comes."""
    forms = [body, *(body.replace(a, b) for a, b in WORDINGS if a in body)]
    forms += [f[: f.index(END)] + cut for f in forms if END in f for cut in ("", END)]
    # in one line per paragraph no line begins with "copyright" by chance
    forms.append(re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", body))
    for form in forms:
        for kind in MARKERS if MARKER.search(form) and name in TITLES else MARKERS[:1]:
            marked = MARKER.sub(
                lambda m: kind.format(n=m[1], letter=chr(96 + int(m[1])), roman="i" * int(m[1])),
                form,
            )
            yield marked
            for title in TITLES.get(name, ()):
                yield f"{title}\n\n{marked}"


@cache
def usual_digests() -> dict[str, str]:
    """``known_texts`` by digest: the same for every call of a program."""
    return digests_of(known_texts())


@cache
def known_texts() -> dict[str, str]:
    """Every guise of the known texts, and the notices, to the licence."""
    files = {f.stem: f.read_text("utf-8") for f in sorted(FOLDER.glob("*.txt"))}
    out = {g: name for name, body in (TEXTS | files).items() for g in guises(name, body)}
    return out | NOTICES


def scan(docs: DataFrame, texts: Mapping[str, str] | None = None) -> DataFrame:
    """Licences of every row of ``docs`` (doc_id, text).

    ``license`` is that of the whole text, ``line_licenses`` those of single lines, each
    once, in order and joined by commas (empty if there is none). A NULL text has a NULL
    digest and no licence; a text without letters or digits has the digest of the empty
    text. ``texts`` replaces the known texts; it comes from the caller's program, so
    its size is no matter of the data.
    """
    spark = docs.sparkSession
    if texts is None:
        known = small_frame(spark, list(usual_digests().items()), _KNOWN)
    else:
        known = known_digests(spark, texts)
    lines = F.filter(F.split("text", "\n"), lambda x: F.lower(x).contains(HINT))
    notices = F.create_map(
        *(x for body, name in NOTICES.items() for x in (F.lit(digest_of(body)), F.lit(name)))
    )
    found = F.filter(
        F.transform(lines, lambda x: F.try_element_at(notices, digest(x))),
        lambda x: x.isNotNull(),
    )
    found = F.coalesce(found, F.array().cast("array<string>"))
    return (
        docs.select(
            "doc_id", digest(F.col("text")).alias("digest"), found.alias("found")
        )
        .join(F.broadcast(known), "digest", "left")
        .select(
            "doc_id",
            F.col("digest").alias("text_digest"),
            "license",
            F.size("found").cast("long").alias("n_license_lines"),
            F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("line_licenses"),
        )
    )


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace({text}, '{OWNER_LINE}', chr(10), 'g')".replace(r"\n", "\\n")
    out = f"trim(regexp_replace(lower({out}), '{NO_WORD}', ' ', 'g'))"
    for a, b in SPELLINGS.items():
        out = f"replace({out}, '{a}', '{b}')"
    return out


def sql() -> str:
    """The same for documents, in another engine's words."""

    def rows(texts: Mapping[str, str]) -> str:
        quoted = [(b.replace("'", "''"), n) for b, n in texts.items()]
        return ", ".join(f"('{b}', '{n}')" for b, n in quoted)

    def table(name: str, texts: Mapping[str, str]) -> str:
        return (
            f"{name} AS (SELECT sha256({_sql_canonical('body')}) AS digest,"
            f" min(license) AS license FROM (VALUES {rows(texts)}) t(body, license) GROUP BY 1)"
        )

    return (
        f"WITH {table('known', known_texts())}, {table('notice', NOTICES)},"
        f" lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),"
        f" hits AS (SELECT doc_id, n.license FROM lines JOIN notice n"
        f" ON sha256({_sql_canonical('line')}) = n.digest WHERE lower(line) LIKE '%{HINT}%'),"
        " per AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ','"
        " ORDER BY license) AS found FROM hits GROUP BY doc_id)"
        f" SELECT d.doc_id, d.digest AS text_digest, k.license,"
        " coalesce(p.n, 0) AS n_license_lines, coalesce(p.found, '') AS line_licenses"
        f" FROM (SELECT doc_id, sha256({_sql_canonical('text')}) AS digest FROM documents) d"
        " LEFT JOIN known k ON k.digest = d.digest LEFT JOIN per p ON p.doc_id = d.doc_id"
    )
