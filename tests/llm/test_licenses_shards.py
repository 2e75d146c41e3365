"""Licence texts and shards against small plain versions."""

import hashlib

import pytest

from feedwell.llm import sharding
from feedwell.llm.licenses import NOTICES, TEXTS, known_digests, known_texts, scan_licenses
from feedwell.llm.sharding import assign_shards


def places(spark, docs, known=None):
    found = scan_licenses(docs, known_texts(spark) if known is None else known)
    return sorted(tuple(r) for r in found.collect())


def test_whole_texts_and_lines(spark, make_docs):
    mit, isc = TEXTS["MIT"], TEXTS["ISC"]
    notice = NOTICES["Apache-2.0"]
    rows = [
        mit, "Copyright (c) 2021 Some One\nAll rights reserved.\n\n" + mit.upper().replace("\n", "\n  ") + "\n",
        mit.replace("MIT License", "MIT Licence").replace("sublicense", "sub-license").replace(", ", " ,  "), mit + " extra",
        f"text\n  *{notice.upper()}*\nmore", notice, isc.replace(" ", "\n"), None, "", "\n\n", "Copyright 2020 x", "é\n" + notice + "\n" + notice,
    ]
    found = places(spark, make_docs(rows))
    assert found == [(0, 0, "MIT"), (1, 0, "MIT"), (2, 0, "MIT"), (4, 2, "Apache-2.0"), (5, 0, "Apache-2.0"), (6, 0, "ISC"),
                     (11, 2, "Apache-2.0"), (11, 3, "Apache-2.0")]


def test_known_texts_are_a_parameter(spark, make_docs):
    known = spark.createDataFrame([("A", "One, two."), ("B", "one two"), ("C", None), ("D", "!"), ("A", "one two!")], "license string, text string")
    rows = [(1, "ONE two"), (None, "one - two"), (1, "ONE two"), (2, "one two three"), (3, "one two " + "\nx" * 50000)]
    found = scan_licenses(make_docs(rows), known).collect()
    assert sorted(((r.doc_id, r.line_no, r.license) for r in found), key=repr) == sorted(
        [(i, 0, n) for i in (1, 1, None) for n in "AB"] + [(3, 1, "A"), (3, 1, "B")], key=repr)
    assert scan_licenses(make_docs([]), known).count() == 0 and scan_licenses(make_docs(rows), known.limit(0)).count() == 0


def test_public_texts_headers_and_wordings(spark, make_docs):
    from feedwell.llm.licenses import shipped

    own = {}
    for r in shipped():
        if len(r.get("text", "")) > 250:
            own.setdefault(r["license"], r)
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense",
            "CC0-1.0", "CC-BY-SA-4.0", "Zlib", "BSL-1.0"} <= set(own)
    names = sorted(own)
    whole = [own[n]["text"] for n in names]
    titled = [f"{r['titles'][0]}\n\nCopyright (c) 2020 Some One\n\n{r['text']}" for n in names if (r := own[n])["titles"]]
    found = {i: l for i, line, l in places(spark, make_docs(whole + titled)) if line == 0}
    assert [found.get(i) for i in range(len(whole) + len(titled))] == names + [n for n in names if own[n]["titles"]]

    mit = TEXTS["MIT"].split("\n\n", 1)[1]
    rows = [mit, "The MIT License (MIT)\n\nCopyright (c) 2015 A B\n\n" + mit, "code\n# SPDX-License-Identifier: BSD-3-Clause\ncode",
            "x\nThis project is licensed under the MIT License - see the LICENSE file for details.\ny", "Licensed under the MIT license",
            '// Licensed under the Apache License, Version 2.0 (the "License");\n// more', "License: MPL-2.0",
            "Available under a Creative Commons Attribution 4.0 International License.", "Released under the terms of the GPLv3", "MIT", "a license"]
    assert places(spark, make_docs(rows)) == [
        (0, 0, "MIT"), (1, 0, "MIT"), (2, 2, "BSD-3-Clause"), (3, 2, "MIT"), (4, 0, "MIT"), (5, 1, "Apache-2.0"), (6, 0, "MPL-2.0"),
        (7, 0, "CC-BY-4.0"), (8, 0, "GPL-3.0")]


def test_known_texts_name_one_license_each(spark):
    from feedwell.llm.licenses import known_digests

    digests = known_digests(known_texts(spark))
    assert digests.groupBy("digest").count().filter("count > 1").count() == 0


def plain_shards(rows, limit):
    """Recursive splits on the bits of the key's md5."""
    keyed = [(k, len((t or "").encode()), bin(int(hashlib.md5(str(k if k is not None else "").encode()).hexdigest()[:14], 16))[2:].zfill(56)) for k, t in rows]
    out = []

    def split(part, prefix):
        if sum(b for _, b, _ in part) <= limit or len(part) <= 1 or len(prefix) == 56:
            out.extend((k, b, prefix or "all", len(prefix)) for k, b, _ in part)
            return
        for bit in "01":
            split([r for r in part if r[2].startswith(prefix + bit)], prefix + bit)

    split(keyed, "")
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit,step", [(10**9, 12), (900, 12), (60, 12), (60, 2), (700, 1)])
def test_buckets_split_only_where_they_must(make_docs, monkeypatch, limit, step):
    monkeypatch.setattr(sharding, "STEP_BITS", step)
    rows = [(n, "é" * (n % 23)) for n in range(300)] + [(None, "x"), (1000, None)]
    found = sorted((tuple(r) for r in assign_shards(make_docs(rows), limit).collect()), key=repr)
    assert found == plain_shards(rows, limit)


def test_equal_keys_get_overflow_pages_within_the_limit(make_docs):
    rows = [(5, "x" * (10 + n % 7)) for n in range(200)] + [(5, "y" * 500), (6, "z")]
    found = assign_shards(make_docs(rows), 100).collect()
    assert len(found) == 202
    sizes = {}
    for r in found:
        sizes.setdefault(r.shard, []).append(r.bytes)
    assert all(sum(v) <= 100 or len(v) == 1 for v in sizes.values())
    assert any("+" in s for s in sizes) and len(sizes) <= 60


def test_no_rows(make_docs):
    assert assign_shards(make_docs([]), 10).count() == 0


def test_sql_knows_the_same_texts(spark):
    import duckdb

    from feedwell.llm.queries import ORACLE_SQL

    known = ORACLE_SQL["op9_licenses"].split("lined as (")[0].rstrip().rstrip(",")
    expected = duckdb.execute(f"{known} select license, md5(whole) from known where whole <> ''").fetchall()
    found = [tuple(r) for r in known_digests(known_texts(spark)).select("license", "digest").collect()]
    assert len(found) > 100_000 and sorted(found) == sorted(expected)
