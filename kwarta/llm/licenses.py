"""Licence scan by canonical digests.

A text is brought to a canonical form: case, copyright lines, equivalent spellings, punctuation and white space
no longer count. Its digest is then joined to the digests of known licences and licence notices. Whole texts,
their paragraphs and their lines are looked up, each as an entire text; the members of an expression of identifiers;
and wherever the first words of a licence in full stand, as much text as that licence has. The known digests are a fixed list and are broadcast; only what matches
is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kwarta.llm.shared import written

#: Pattern and replacement, with $1 for groups, applied in this order to lower-case text. Lines stay.
CANONICAL = (
    (r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*\n?", ""),
    (r"licenc", "licens"),
    (r"https://", "http://"),
    (r"\b(organi|authori|recogni|utili|initiali)s(e|es|ed|ing|ation)\b", "$1z$2"),
    (r"\b(favo|behavio|colo|hono)ur", "$1r"),
    (r"acknowledgement", "acknowledgment"),
    (r"non-?commercial", "noncommercial"),
    (r"sub-license", "sublicense"),
    (r"[^\p{L}\p{N}\n]+", " "),
)
#: What separates paragraphs of a text in that form, and what counts as one space at last.
PARAGRAPH, SPACE = r" *\n *\n[ \n]*", r"[ \n]+"
#: Lines of a text in that form that go with its copyright lines when it is looked up.
RIGHTS, RIGHTS_LINE = "all rights reserved", r"(?m)^ *all rights reserved *(?:\n|\z)"
#: Words that a licence in full is looked for by.
FIRST_WORDS = 12

#: Names that notices use, by licence identifier.
NAMES = {
    "MIT": ("MIT License", "MIT", "Expat License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0", "CC0-1.0", "Creative Commons Zero 1.0"),
    **{
        f"CC-{kind}-4.0": (f"CC {kind} 4.0", f"CC-{kind}-4.0", f"Creative Commons {words} 4.0 International License")
        for kind, words in {
            "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
        }.items()
    },
}
#: What may follow the identifier of a licence of GNU.
VERSIONS = ("-only", "-or-later", "+")
#: Line that holds an expression of identifiers, and what stands between these, in canonical form.
EXPRESSION, BETWEEN = "spdx license identifier ", r" (?:or|and|with) "
#: What notices say of a name; an article before the name is optional.
NOTICES = (
    "{}", "Licensed under {}", "Released under {}", "Distributed under {}", "Available under {}",
    "This work is licensed under {}", "This software is licensed under {}", "This file is licensed under {}",
    "This project is licensed under {}", "This program is licensed under {}", "License: {}", "SPDX-License-Identifier: {}",
    "Licensed under the terms of {}", "Distributed under the terms of {}", "Released under the terms of {}",
)
#: The notice at the head of a file under a licence of GNU: identifier, name, version; and what it calls the file.
GNU_NOTICE = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
GNU_LICENSES = (
    ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
    ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
    ("AGPL-3.0", "Affero General Public License", "3"),
)
GNU_WORKS = ("program", "library", "file", "software")

#: Licences in full.
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS)
_NO_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_FREELY = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n")
_APACHE_HEAD = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.")
TEXTS = {
    "MIT": (_MIT, "MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT),
    "ISC": (
        f"{_FREELY}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_NO_WARRANTY}",
        f"ISC License\n\n{_FREELY}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_NO_WARRANTY}"),
    "0BSD": (f"{_FREELY}.\n\n{_NO_WARRANTY}",),
    "BSD-2-Clause": (_BSD_TERMS + _BSD_END, "BSD 2-Clause License\n\n" + _BSD_TERMS + _BSD_END),
    "BSD-3-Clause": (_BSD_TERMS + _BSD_THIRD + _BSD_END, "BSD 3-Clause License\n\n" + _BSD_TERMS + _BSD_THIRD + _BSD_END),
    "Apache-2.0": (_APACHE_HEAD,),
}

#: Long licences in full, as their canonical form's first words, length and digest. Of those with an
#: appendix on how to apply them, also what ends before it.
FULL = (
    ("Apache-2.0", "apache license version 2 0 january 2004 http www apache org licenses", 9701,
     "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100"),
    ("Apache-2.0", "apache license version 2 0 january 2004 http www apache org licenses", 8685,
     "e9dbf930ca0f1e090ec68da9a37b657d11bc9e43b30643455d6a96dbf73116ca"),
    ("CC0-1.0", "creative commons legal code cc0 1 0 universal creative commons corporation is", 6692,
     "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GPL-2.0", "gnu general public license version 2 june 1991 51 franklin street fifth", 17053,
     "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-2.0", "gnu general public license version 2 june 1991 51 franklin street fifth", 14419,
     "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999"),
    ("GPL-3.0", "gnu general public license version 3 29 june 2007 everyone is permitted", 33274,
     "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f"),
    ("GPL-3.0", "gnu general public license version 3 29 june 2007 everyone is permitted", 30836,
     "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b"),
    ("LGPL-3.0", "gnu lesser general public license version 3 29 june 2007 everyone is", 7104,
     "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "mozilla public license version 2 0 1 definitions 1 1 contributor means", 14271,
     "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
    ("Artistic-1.0-Perl", "the artistic license preamble the intent of this document is to state", 5683,
     "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304"),
    ("BSD-3-Clause", "redistribution and use in source and binary forms with or without modification", 1361,
     "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("GFDL-1.2", "gnu free documentation license version 1 2 november 2002 51 franklin st", 19509,
     "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f"),
    ("GFDL-1.3", "gnu free documentation license version 1 3 3 november 2008 http fsf", 21877,
     "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480"),
    ("GPL-1.0", "gnu general public license version 1 february 1989 51 franklin st fifth", 11765,
     "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("LGPL-2.0", "gnu library general public license version 2 june 1991 51 franklin street", 23937,
     "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3"),
    ("LGPL-2.1", "gnu lesser general public license version 2 1 february 1999 51 franklin", 25024,
     "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"),
    ("MPL-1.1", "mozilla public license version 1 1 1 definitions 1 0 1 commercial", 22319,
     "fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61"),
    ("Unlicense", "this is free and unencumbered software released into the public domain anyone", 1170,
     "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229"),
)


def known_texts() -> Iterator[tuple[str, str]]:
    """(licence, text): full texts, the notices of GNU, and each notice with each name."""
    for license_id, texts in TEXTS.items():
        yield from ((license_id, text) for text in texts)
    for license_id, name, version in GNU_LICENSES:
        yield from ((license_id, GNU_NOTICE.format(what=what, name=name, version=version)) for what in GNU_WORKS)
    for license_id, names in NAMES.items():
        gnu = license_id.startswith(("GPL", "LGPL", "AGPL"))
        for name in (*names, *(license_id + v for v in VERSIONS if gnu)):
            for notice in NOTICES:
                yield license_id, notice.format(name)
                yield license_id, notice.format("the " + name)


def lines(text: Column) -> Column:
    """The text with everything made equal that does not tell licences apart, still in lines."""
    out = F.lower(text)
    for pattern, replacement in CANONICAL:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def flat(form: Column) -> Column:
    """A text in that form on one line."""
    return F.trim(F.regexp_replace(form, SPACE, " "))


def digest(form: Column) -> Column:
    """SHA-256 of a text in that form, on one line."""
    return F.sha2(flat(form).cast("binary"), 256)


def known_runs(spark: SparkSession) -> dict[str, list[int]]:
    """First words of licences in full, and the lengths of the texts that begin with them."""
    texts = [(t,) for texts in TEXTS.values() for t in texts]
    forms = [r[0] for r in spark.createDataFrame(texts, "t string").select(flat(lines(F.col("t")))).collect()]
    # of a text with its heading and without, the latter is part of the former
    forms = [f for f in forms if not any(f != g and f.endswith(g) for g in forms)]
    found: dict[str, set[int]] = {}
    for words, size in [(" ".join(f.split(" ")[:FIRST_WORDS]), len(f)) for f in forms] + [(words, size) for _, words, size, _ in FULL]:
        found.setdefault(words, set()).add(size)
    return {words: sorted(sizes) for words, sizes in found.items()}


def runs(line: Column, known: dict[str, list[int]]) -> Column:
    """From each place in a text on one line where the first words of a licence stand, text of its length.

    No licence repeats its first words, so each run ends before they stand again.
    """
    padded = F.concat(F.lit(" "), line, F.lit(" "))
    none = F.array().cast("array<string>")

    def cut(after: Column, words: str, size: int) -> Column:
        rest = size - len(words) - 1
        ends = F.filter(after, lambda x: F.substring(x, rest + 1, 1).isin("", " "))
        return F.transform(ends, lambda x: F.concat(F.lit(f"{words} "), F.substring(x, 1, rest)))

    found = []
    for words, sizes in known.items():
        after = F.slice(F.split(padded, f" {words} "), 2, 2**30)
        some = F.contains(padded, F.lit(f" {words} "))
        found.append(F.when(some, F.concat(*(cut(after, words, n) for n in sizes))).otherwise(none))
    return F.concat(*found)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row: doc_id, licenses, n_licenses, whole_license, canonical_sha256.

    licenses: identifiers found in the text, sorted, comma-joined (empty if none); whole_license: the licence
    whose text the whole is, else null (of several, the first in order). Lines that reserve all rights do not count
    for either, but for the digest. Null and empty texts hold none.
    Repeated rows give repeated results, null ids stay null. Empty table: no rows.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(sorted(set(known_texts())), "license string, known string")
    known = known.select("license", digest(lines(F.col("known"))).alias("digest"))
    full = spark.createDataFrame([(license_id, sha) for license_id, _, _, sha in FULL], "license string, digest string")
    known = known.unionByName(full).distinct()
    whole = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    rows = docs.select(docs[f"`{doc_id}`"].alias("id"), lines(whole).alias("form"), F.sha2(whole.cast("binary"), 256).alias("key"))
    by_line = F.split("form", r"\n")
    tagged = F.filter(by_line, lambda x: F.contains(x, F.lit(EXPRESSION)))
    named = F.when(F.contains("form", F.lit(EXPRESSION)), F.flatten(F.transform(
        tagged, lambda x: F.split(F.trim(F.substring_index(x, EXPRESSION, -1)), BETWEEN)))).otherwise(F.array().cast("array<string>"))
    pieces = F.concat(by_line, F.split("form", PARAGRAPH), runs(F.col("line"), known_runs(spark)), named)
    bare = F.when(F.contains("form", F.lit(RIGHTS)), F.regexp_replace("form", RIGHTS_LINE, "")).otherwise(F.col("form"))
    parts = F.concat(
        F.array(F.struct(F.lit(None).cast("boolean").alias("whole"), F.col("line").alias("part")), F.struct(F.lit(True).alias("whole"), bare.alias("part"))),
        F.transform(pieces, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("part"))))
    # One pass over the forms: what matches goes on, and of each row the digest of all, marked by no answer to "whole".
    each = rows.withColumn("line", flat(F.col("form"))).select("id", "key", F.explode(parts).alias("p")).select(
        "id", "key", "p.whole", digest(F.col("p.part")).alias("digest"))
    found, _ = written(
        each.join(F.broadcast(known.withColumnRenamed("digest", "known")), F.when(F.col("whole").isNotNull(), F.col("digest")) == F.col("known"), "left")
        .where("whole IS NULL OR license IS NOT NULL").drop("known"), "license-hits")
    hits = found.where("whole IS NOT NULL").select("key", "license", "whole").distinct()
    listed = hits.groupBy("key").agg(
        F.array_sort(F.collect_set("license")).alias("found"), F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_license"))
    return found.where("whole IS NULL").select("id", "key", F.col("digest").alias("canonical_sha256")).join(listed, "key", "left").select(
        F.col("id").alias(doc_id), F.coalesce(F.array_join("found", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_licenses"), "whole_license", "canonical_sha256")
