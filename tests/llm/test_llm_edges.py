"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import random

import brute
import public_tokenizers
import pytest

import corpus_pipeline
from tidemark.llm import (
    components,
    decontaminate,
    huffman,
    language,
    licenses,
    line_dedup,
    packing,
    quality,
    simhash,
    toxicity,
    warc,
)
from tidemark.llm.shared import settle

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CLASHING = (
    "key", "fp", "found", "scan", "item", "n_words", "component_id", "root", "runs", "id", "k",
    "text_key", "length", "part", "score", "labels", "first", "_key", "_found", "_runs",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASHING
)
WORDS = [f"w{i}" for i in range(400)]


def passage(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


LONG = "\n".join(passage(f"long{i}", 20) for i in range(3000))
SHARED = passage("shared", 60)
ITEM = passage("item", 20)
TEXTS = [
    (5, passage(5, 80) + "\n" + SHARED, "en"),
    (3, SHARED + "\n" + passage(3, 70), "en"),
    (None, "x\n" + SHARED, None),
    (7, None, "de"),
    (8, "", None),
    (None, None, None),
    (9, " \n\t ", "en"),
    (10, "123 %%% ..", None),
    (11, LONG, "en"),
    (12, passage(12, 30) + " " + ITEM + " " + passage(13, 30), "en"),
    (12, "another text of the same id", "en"),
    (13, passage(5, 80) + "\n" + SHARED, "en"),  # the text of 5
    (14, "Licensed under the MIT License, or: Apache License, Version 2.0!", "en"),
    (15, "tab\tand é…ß\n\n\nİ x", "fr"),
]
REPEATED = (16, passage("again", 90), "en")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "s", len(r[1] or ""), *CLASHING) for r in [*TEXTS, REPEATED, REPEATED]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def order(rows):
    return sorted(rows, key=repr)


def all_texts():
    return [(d, t) for d, t, _ in [*TEXTS, REPEATED, REPEATED]]


def test_contamination(spark, docs, none):
    items = [(1, ITEM), (2, None), (None, passage("long7", 20)), (4, "123"), (5, ITEM), (6, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [
        (r.doc_id, r.n_words, r.n_hit, tuple(r["items"]))
        for r in decontaminate.contamination(docs, benchmark).collect()
    ]
    assert order(got) == order(brute.contamination(all_texts(), items))
    assert any(r[3] == ("1", "5") for r in got) and any(r[0] == 11 and r[2] == 20 for r in got)
    assert decontaminate.contamination(none, benchmark).count() == 0
    empty = decontaminate.contamination(docs, benchmark.limit(0)).collect()
    assert len(empty) == 16 and all(r.n_hit == 0 for r in empty)
    kept = decontaminate.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(
        d or 0 for d, n, hit, _ in brute.contamination(all_texts(), items) if not (hit and 20 * hit >= n)
    )


def test_packing_and_token_files(docs, none):
    ids = brute.token_ids([t for _, t in all_texts()])
    rows = packing.pack_documents(docs, TOKENIZER, 1).collect()
    want = [
        (d, n, at, len(x[at : at + 4096]), brute.crc(x[at : at + 4096]))
        for (d, _), x in zip(all_texts(), ids, strict=True)
        for n, at in enumerate(range(0, len(x), 4096))
    ]
    assert order((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == order(want)
    taken = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, at, n), (s2, at2, _) in zip(taken, taken[1:], strict=False):
        assert at2 == (at + n if s == s2 else 0)
    assert packing.pack_documents(none, TOKENIZER, 1).count() == 0

    got = huffman.read(huffman.write(docs, TOKENIZER, 1, block_ids=3000)).collect()
    assert order((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == order(
        (d, len(x), brute.crc(x)) for (d, _), x in zip(all_texts(), ids, strict=True)
    )
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda d: -1 if d is None else d)
    assert huffman.read(huffman.write(none, TOKENIZER, 1)).count() == 0


def test_archives(spark):
    rows = [(4, "u4", "<p>a</p>"), (2, None, "<p>a</p>"), (None, "n", "<p>a</p>"), (3, "u3", None),
            (1, "u1", ""), (None, None, "<b>ß</b>"), (6, "r", "same"), (6, "r", "same"), (7, "", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sum string")
    got = warc.read(warc.write(pages, archive_bytes=200)).collect()
    first = {}
    for page_id, _, html in rows:
        known = first.get(html or "")
        first[html or ""] = min([x for x in (known, page_id) if x is not None], default=None)
    want = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        again = page_id != first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page_id, url, "revisit" if again else "response", first[html or ""] if again else None, len(data), digest))
    fields = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")
    assert order(tuple(r[f] for f in fields) for r in got) == order(want)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_line_dedup(docs, none):
    got = line_dedup.deduplicated(docs, counted=("was", "gone"))
    assert got.columns == [*docs.columns, "was", "gone"]
    rows = got.collect()
    # In order of id, nulls last; equal rows are one place.
    unique = {(d, t) for d, t in all_texts()}
    ordered = sorted(unique, key=lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or ""))
    short = [(i, t) for i, (_, t) in enumerate(ordered) if t != LONG]
    want = {ordered[i]: t for i, t in brute.without_later_runs(short, 50)}
    want[11, LONG] = LONG
    assert order((r.doc_id, r.text) for r in rows) == order((d, want[d, t]) for d, t in all_texts())
    for r in rows:
        if r.gone:
            assert r.n_chars == len(r.text)
    assert sum(r.gone > 0 for r in rows) == 3
    assert line_dedup.deduplicated(none).count() == 0
    assert line_dedup.deduplicated(none).columns == none.columns


def test_long_runs_are_removed_whole(spark):
    lines = [passage(f"l{i}", 9) for i in range(40)]
    texts = [(1, "\n".join(lines)), (2, "\n".join(["own", *lines[3:30], "other"])), (3, "\n".join([*lines[5:9], "x", *lines[20:26], *lines[20:26]]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert got == dict(brute.without_later_runs(texts, 50))
    assert got[2] == "own\nother"
    assert got[3] == "\n".join([*lines[5:9], "x"])


def test_blank_lines_around_a_run(spark):
    run, blank = "\n".join(passage(f"b{i}", 10) for i in range(5)), "\n" * 200_000
    texts = [blank + run + blank, "own" + blank + run + "\n\nother", run]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.deduplicated(docs, counted=("was", "gone")).collect()}
    # Blank lines beside a repeated run go as far as they repeat.
    assert [got[i].text for i in range(3)] == [texts[0], "own\nother", ""]
    assert [got[i].was for i in range(3)] == [400_005, 200_007, 5]
    assert [got[i].gone for i in range(3)] == [0, 200_005, 5]
    short = [(i, t.replace(blank, "\n\n\n")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert got == dict(brute.without_later_runs(short, 50))


@pytest.mark.parametrize("paired", [2, 64])
def test_near_duplicates(spark, docs, none, paired, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rows = all_texts()
    prints = [brute.fingerprint(t) for _, t in rows]
    group = brute.linked(prints)
    least = {}
    for (d, _), g in zip(rows, group, strict=True):
        least[g] = min([x for x in (least.get(g), d) if x is not None], default=None)
    got = simhash.groups(docs).collect()
    assert order((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == order(
        (d, p, least[g]) for (d, _), p, g in zip(rows, prints, group, strict=True)
    )
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group))
    assert simhash.groups(none).count() == 0
    assert simhash.deduplicated(none).count() == 0


@pytest.mark.parametrize("paired", [2, 64])
def test_links_connect_all_close_fingerprints(spark, paired, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    make = random.Random(5)
    prints = set()
    for _ in range(6):
        seed = make.getrandbits(64)
        for _ in range(60):
            p = seed
            for b in make.sample(range(64), make.choice([1, 2, 3, 6])):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    table = settle(spark.createDataFrame(signed, "fp long"), "prints")
    roots = {r.node % 2**64: r.root % 2**64 for r in components.components(simhash.links(table)).collect()}
    group = brute.linked(prints)
    for i, p in enumerate(prints):
        for j, q in enumerate(prints):
            assert (group[i] == group[j]) == (roots.get(p, p) == roots.get(q, q))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)]
    random.Random(1).shuffle(edges)
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == {
        **{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 50)}
    }


def test_licenses(docs, none):
    rules = licenses.rules()
    assert len(rules) > 200
    got = [tuple(r) for r in licenses.scan(docs).collect()]
    assert order(got) == order((d, *brute.license_scan(t, rules)) for d, t in all_texts())
    assert licenses.scan(none).count() == 0


def test_licenses_contain_and_outrank(spark):
    rules = licenses.rules()
    texts = [
        "cc by nc sa 4.0 license. CC BY-NC cc by nc, under the MIT license under-the-mit-license",
        "SPDX-License-Identifier: GPL-3.0-or-later; licensed under the gpl v3 license",
        "under the mit\nlicense " * 200,
        "Creative Commons Attribution-NonCommercial 4.0 license; all rights reserved, copyright (c) 2020",
        "apache license version 2 0 " + "apache license version 2",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in licenses.scan(docs).collect()}
    assert got == {i: brute.license_scan(t, rules) for i, t in enumerate(texts)}
    assert got[2][1] == 200 and "cc-by-nc-sa" in got[0][5]


GNU = "it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
CC = "This work is licensed under a Creative Commons {} 4.0 International License."
NOTICES = [
    (GNU.format("General Public License", 3), "gpl-3"),
    (GNU.format("General Public License", 2), "gpl-2"),
    (GNU.format("Lesser General Public License", 2.1), "lgpl-2.1"),
    (GNU.format("Lesser General Public License", 3), "lgpl-3"),
    (GNU.format("Affero General Public License", 3), "agpl-3"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", "gpl-2"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "gpl-3"),
    ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "lgpl-2.1"),
    ("GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991", "lgpl-2"),
    ("under version 2 of the GNU General Public License", "gpl-2"),
    (CC.format("Attribution"), "cc-by"),
    (CC.format("Attribution-ShareAlike"), "cc-by-sa"),
    (CC.format("Attribution-NonCommercial"), "cc-by-nc"),
    (CC.format("Attribution-NoDerivatives"), "cc-by-nd"),
    (CC.format("Attribution-NonCommercial-ShareAlike"), "cc-by-nc-sa"),
    (CC.format("Attribution-NonCommercial-NoDerivatives"), "cc-by-nc-nd"),
    ("available under the Creative Commons Attribution-ShareAlike 3.0 Unported license", "cc-by-sa"),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "apache-2"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS", "apache-2"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "bsd-3"),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement", "bsd-4"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.", "zlib"),
    ("Distributed under the Boost Software License, Version 1.0.", "boost"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", "ofl"),
    ("it is free software; the same terms apply: under the same terms as Perl itself", "perl"),
    ("CC0 1.0 Universal", "cc0"),
    ("SPDX-License-Identifier: PSF-2.0", "python"),
    ("MIT-licensed, or GPL-3.0-or-later", "gpl-3,mit"),
    ("the general public may license its version of a permit, in 2 parts", ""),
]


def test_standard_license_notices(spark):
    rules = licenses.rules()
    texts = [(i, t) for i, (t, _) in enumerate(NOTICES)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert {t: got[i].labels for i, t in texts} == dict(NOTICES)
    assert {i: tuple(got[i])[1:] for i, _ in texts} == {i: brute.license_scan(t, rules) for i, t in texts}


def test_models(spark, docs, none):
    labels = spark.createDataFrame([(5, 1, 0), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for table in (docs, none):
        n = table.count()
        for some in (labels, labels.limit(0)):
            model = toxicity.learn(table, some)
            scores = table.select(toxicity.scored(table["text"], model, spark).alias("s")).collect()
            assert len(scores) == n and all(0 <= r.s <= 1 for r in scores)
            judge = quality.learn(table, some)
            counts = table.select(quality.assessed(table["text"], judge, spark).alias("q")).collect()
            assert len(counts) == n
        model = language.learn(table)
        found = table.select("text", language.identified(table["text"], model, spark).alias("f")).collect()
        assert len(found) == n
        for r in found:
            if not any(c.isalpha() for c in r.text or ""):
                assert r.f.lang_pred == "und" and r.f.score == 0
            else:
                assert r.f.lang_pred in {"en", "de", "fr"}


def test_quality_counts(spark, docs):
    got = docs.select("doc_id", "text", quality.assessed(docs["text"], None, spark).alias("q")).collect()
    for r in got:
        assert tuple(r.q)[:5] == brute.base_counts(r.text)


def test_stages(spark, docs, none):
    directory = "/root/testdata/sf0.001"
    for table in (docs, none):
        rows = table
        for name, stage in corpus_pipeline.STAGES:
            before = rows.count()
            rows = settle(stage(spark, rows, directory), name.replace(" ", "-"))
            if name != "packing":
                assert rows.columns == docs.columns
                assert rows.count() <= before
        assert (rows.count() > 0) == (table is docs)


def test_first_stage_without_languages(spark, docs):
    plain = docs.withColumn("lang", docs["lang"].substr(1, 0)).where("text is not null")
    plain = plain.selectExpr("doc_id", "text", "cast(null as string) as lang")
    kept = corpus_pipeline.identify_language(spark, plain, "").collect()
    assert len(kept) == sum(any(c.isalpha() for c in t or "") for _, t in all_texts())
