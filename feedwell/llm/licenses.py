"""Known licence texts and notices in documents, by digest of their canonical form.

The canonical form folds case, drops copyright lines and punctuation, joins words by one space and
spells alike what is spelt in two ways. A document's whole text and each of its lines are looked up.

``license_texts.jsonl`` beside this module holds public texts, standard headers, names and SPDX ids;
titles of texts are optional, and notices are the names in common wordings.
"""

from __future__ import annotations

import json
import pkgutil
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines that name a holder or a year, and "all rights reserved" on its own; they differ from copy to copy.
COPYRIGHT = (
    r"(^|\n)[ \t*#/;]*(copyright|\(c\)|©)[^\n]*([12][0-9][0-9][0-9]|\(c\)|©|<year>|\[year\])[^\n]*"
    r"|(^|\n)[ \t*#/;]*all rights reserved\.?[ \t]*"
)
#: Spellings that count as one, as rules over words: British and American forms, hyphens.
SPELLINGS = (
    (r"licen[cs]", "licens"), (r"is(e|ed|es|ing|ation|ations) ", "iz$1 "), (r"our(s|ed|ing|able|)? ", "or$1 "),
    (r"ll(ed|ing) ", "l$1 "), (r"(judg|acknowledg)ement", "$1ment"), (r"sub licens", "sublicens"),
    (r"non commercial", "noncommercial"), (r"copyright owner", "copyright holder"),
)
#: Wordings of notices around a licence's name: subject, verb, article, name, end (fixed values).
SUBJECTS = (
    "", "This project is", "This software is", "This work is", "This program is", "This code is", "This file is",
    "This library is", "This document is", "This content is",
)
VERBS = (
    "licensed under", "released under", "distributed under", "available under", "made available under",
    "licensed under the terms of", "released under the terms of", "distributed under the terms of",
)
ENDS = ("", "see LICENSE for details", "see the LICENSE file for details")
#: Wordings around an SPDX id or a name.
TAGS = ("SPDX-License-Identifier:", "License:")
#: Short notices (fixed values): what files and documents carry instead of a licence's text.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
#: Whole licence texts (fixed values, public).
TEXTS = {
    "MIT": (
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _AS_IS
    ),
}


def canonical(text: Column) -> Column:
    """The canonical form, line by line: words between single spaces, a space at both ends of each line."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    bare = F.regexp_replace(folded, COPYRIGHT, "\n")
    words = F.regexp_replace(F.concat(F.lit(" "), bare, F.lit(" ")), r"[^\p{L}\p{N}\n]+", " ")
    words = F.regexp_replace(words, r" ?\n ?", " \n ")
    for pattern, instead in SPELLINGS:
        words = F.regexp_replace(words, pattern, instead)
    return words


def joined(lines: Column) -> Column:
    """The words of all lines between single spaces."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(known: DataFrame, name: str = "license", text: str = "text") -> DataFrame:
    """license, digest of each known text; texts that are null or empty in canonical form are left out."""
    whole = joined(canonical(F.col(text)))
    return known.select(F.col(name).alias("license"), whole.alias("_whole")).filter("_whole <> ''").select(
        "license", F.md5("_whole").alias("digest")).distinct()


def scan_licenses(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Places whose canonical form is a known text: doc_id, line_no (from 1; 0: the whole text), license.

    A text of one line counts as whole text only. Null and empty texts match nothing; repeated rows
    each match; a text known under two names gives two rows; empty tables give no rows; other
    columns take no part. Spark broadcasts the digests where they are small, and shuffles otherwise.
    """
    lines = docs.select(F.col(doc_id).alias("doc_id"), canonical(F.col(text)).alias("_lines"))
    parts = F.transform(F.split("_lines", "\n"), lambda s: F.trim(s))
    parts = F.concat(F.array(joined(F.col("_lines"))), F.when(F.instr("_lines", "\n") > 0, parts).otherwise(F.array()))
    units = lines.select("doc_id", F.posexplode(parts).alias("line_no", "_unit")).filter("_unit <> ''")
    units = units.select("doc_id", "line_no", F.md5("_unit").alias("digest"))
    return units.join(known_digests(known), "digest").select("doc_id", "line_no", "license")


def shipped() -> list[dict]:
    """The rows of the data file, read where the job is planned, so that executors need no copy of it.

    A row has a license and a text with its optional titles, names for notices, or an SPDX id.
    """
    raw = pkgutil.get_data(__package__, "license_texts.jsonl").decode("utf-8")
    return [json.loads(line) for line in raw.split("\n") if line]


def known_texts(spark) -> DataFrame:
    """The notices and texts above and those of the data file as a table; operators take any other of the same form."""
    rows = [*NOTICES.items(), *TEXTS.items()]
    names, tagged = [], []
    for row in shipped():
        name = row["license"]
        if "text" in row:
            rows += [(name, row["text"]), *((name, f"{title}\n\n{row['text']}") for title in row["titles"])]
        for own in row.get("names", ()):
            article = "a" if own.startswith("Creative Commons") else "the"
            names += [(name, own), (name, f"{article} {own}")]
            tagged.append((name, own))
        if "id" in row:
            tagged.append((name, row["id"]))
    known = "license string, text string"
    worded = F.array(*(F.lit(f"{a} {b} {{}} {c}") for a in SUBJECTS for b in VERBS for c in ENDS))
    tags = F.array(*(F.lit(f"{a} {{}}") for a in TAGS))
    tables = [spark.createDataFrame(rows, known)]
    for forms, of in ((worded, names), (tags, tagged)):
        spread = spark.createDataFrame(of, known).select("license", "text", F.explode(forms).alias("_form"))
        tables.append(spread.select("license", F.replace("_form", F.lit("{}"), F.col("text")).alias("text")))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])
