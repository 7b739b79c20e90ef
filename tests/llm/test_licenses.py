import re
from collections import Counter

import odd
import pytest

from snapstats.llm import licenses
from snapstats.llm.queries import QUERIES

#: The notices that occur in the tables, by plain patterns.
PLAIN = {
    "Apache-2.0": r"^Licensed under the Apache License, Version 2\.0\.?$",
    "CC-BY-NC": r"^Licensed under CC BY-NC 4\.0\.?$",
    "GPL": r"^This work is licensed under the GNU General Public License, version 3\.?$",
}


def test_documents_match_plain_patterns(spark, sf_dir, documents):
    got = {r["doc_id"]: r["families"] for r in QUERIES["op10_licenses"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for d, text in documents:
        want = {f for f, p in PLAIN.items() if re.search(p, text or "", re.MULTILINE)}
        assert want <= set(filter(None, got[d].split(","))), (d, got[d])
        if not re.search("licen[cs]e|rights|permission|mit ", (text or "").lower()):
            assert got[d] == ""


ISC = ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
       "provided that the above copyright notice and this permission notice appear in all copies.")
BSD = ("Copyright (c) 2019, The Authors. All rights reserved.\nRedistribution and use in source and binary forms, with or without "
       "modification, are permitted provided that the following conditions are met:\n1. The list stays.")
LONG = " ".join(["the wind over the hill went on"] * 300)
#: Texts that are no templates, and the licence they name.
OTHERS = {
    ISC: "ISC", BSD: "BSD", "This is free and unencumbered software released into the public domain.\nEnjoy.": "Unlicense",
    "All of this is made available under the terms of the Eclipse Public License 2.0.": "EPL",
    "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: GPL-3.0-or-later": "GPL",
    f"{LONG} Licensed under the Apache License, Version 2.0. {LONG}": "Apache-2.0", LONG: None,
    "All rights reserved.": "Proprietary",
}


def test_windows_cover_long_lines(spark):
    for n in (0, 1, 119, 120, 121, 180, 181, 240, 1001):
        got = spark.range(1).select(licenses.windows(licenses.F.expr(f"transform(slice(sequence(0, {n}), 2, {n}), x -> string(x))"))).first()[0]
        assert all(len(w) <= 120 for w in got) and {x for w in got for x in w} == {str(x) for x in range(1, n + 1)}
        for start in range(1, n - 58):  # any 60 words in a row are whole in a window
            assert any({str(start), str(start + 59)} <= set(w) for w in got)


@pytest.fixture(scope="module")
def judged(spark, sf_dir):
    texts = [t for own in licenses.TEMPLATES.values() for t in own] + [
        "Hello.\nlicensed under the apache license version 2.0", "Some text, licensed under the GNU GPL of Bremen, was lost.",
        *OTHERS, *licenses.REMARKS, None, "", "The cat sat on the mat and the dog did not mind it at all",
        "This program is licensed under the terms of the GNU General Public License, version 3.", "licensed under the MIT license"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(texts)] + [(10**6, texts[0])], "doc_id long, text string"))
    rows = [r for r in licenses.scan(docs).collect() if r["doc_id"] >= 10**6]
    return texts, rows


def test_templates_variants_and_remarks(judged):
    texts, rows = judged
    got = {texts[r["doc_id"] - 10**6]: r["license"] for r in rows}
    for family, own in licenses.TEMPLATES.items():
        assert all(got[t] == family for t in own), (family, [got[t] for t in own])
    assert got["Hello.\nlicensed under the apache license version 2.0"] == "Apache-2.0"
    assert got["licensed under the MIT license"] == "MIT"
    assert got["This program is licensed under the terms of the GNU General Public License, version 3."] == "GPL"
    for t in (*licenses.REMARKS, None, "", "The cat sat on the mat and the dog did not mind it at all"):
        assert got[t] is None, t


def test_other_notices_tags_headers_and_long_lines(judged):
    texts, rows = judged
    got = {texts[r["doc_id"] - 10**6]: r["license"] for r in rows}
    assert {t[:60]: got[t] for t in OTHERS} == {t[:60]: want for t, want in OTHERS.items()}


def test_repeated_rows_are_reported_each(judged):
    _, rows = judged
    assert [(r["n_paragraphs"], r["license"]) for r in rows if r["doc_id"] == 10**6] == [(1, "Apache-2.0")] * 2


def test_odd_and_empty_tables(odd_docs):
    got = licenses.scan(odd_docs)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in odd.rows())
    assert licenses.scan(odd_docs.where("false")).count() == 0


def test_the_background_is_every_paragraph_that_may_be_scored(spark):
    texts = [f"the price number{n} rose to the level of the other day" for n in range(4000)] + ["no words in common"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    rows = licenses.training_rows(licenses.able_paragraphs(docs)).where("label = 0 and exists(words, w -> w like 'number%')")
    assert rows.select("words").distinct().count() == rows.count() == 4000
    assert 0 < rows.where("tune").count() < 4000


def test_similarity_and_has_any_are_those_of_sets(spark):
    known = licenses._known(spark)
    texts = [t for _, t in licenses.notices()] + [t[:n] for _, t in licenses.notices() for n in (12, 30, 60)] + [*licenses.REMARKS, "", "of", "the the the of the"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(licenses.words_of(licenses.F.col("text")).alias("words"))
    grams = licenses.F.array_distinct(licenses.two_grams(licenses.F.col("words")))
    got = rows.select("words", licenses.similarity(grams, known).alias("alike"),
                      licenses.has_any(licenses.F.col("words"), licenses._every(known)).alias("any")).collect()
    for r in got:
        own = {f"{a} {b}" for a, b in zip(r["words"], r["words"][1:])}
        want = [max(len(own & set(t)) / max(min(len(own), len(t)), 1) for t in ts) for ts in known.values()]
        assert r["alike"] == want and r["any"] == any(own & set(t) for ts in known.values() for t in ts)


def test_paragraphs_are_hashed_once_and_only_similar_ones_are_scored(spark, monkeypatch):
    hashed, scored = [], []
    featured, transform = licenses._featured, licenses.LogisticRegressionModel.transform
    monkeypatch.setattr(licenses, "_featured", lambda rows: hashed.append(rows) or featured(rows))
    monkeypatch.setattr(licenses.LogisticRegressionModel, "transform", lambda self, rows: scored.append(rows) or transform(self, rows))
    texts = ["licensed under the MIT license"] + [f"the price number{n} rose to the level of the other day" for n in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.classified(docs)
    assert len(hashed) == 2 and not any("license-" in f for rows in hashed for f in rows.inputFiles())  # documents, templates: never staged rows
    assert [rows.count() for rows in scored[1:]] == [1] and scored[0].count() > 0
    assert [r["family"] for r in got.collect()] == ["MIT"]


def test_the_estimator_meets_small_blocks_in_few_tasks(spark, monkeypatch):
    seen = []
    fit = licenses.LogisticRegression.fit
    monkeypatch.setattr(licenses.LogisticRegression, "fit", lambda self, rows: seen.append((self.getMaxBlockSizeInMB(), rows)) or fit(self, rows))
    texts = [f"the price number{n} rose to the level of the other day" for n in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    able = licenses.stage(licenses.able_paragraphs(docs).drop("words"), "able")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        licenses.fit(able)
        (size, rows), = seen
        wide = spark.read.schema(rows.schema).parquet(*rows.inputFiles()).where("not tune")
        assert wide.rdd.getNumPartitions() > 16 and rows.rdd.getNumPartitions() <= max(4, wide.rdd.getNumPartitions() // 2)
        assert rows.count() == wide.count()  # merged, none left out
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert size < 1  # megabyte: what stays in a core's cache


@pytest.mark.parametrize("text", ["a-b.c", "a.-b", "1.2.3.", "-x-", "é.ü-ß..z", "a--b", "x.", "", "...", "A1-Б2 v2.0, (3-Clause)"])
def test_words_are_those_of_the_plain_pattern(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(licenses.words_of(licenses.F.col("t"))).first()[0]
    want = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())
    assert got == want
