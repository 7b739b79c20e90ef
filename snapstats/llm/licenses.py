"""Licence scans: a paragraph classifier confirmed by templates, in DataFrame operations and Spark's own estimators.

Every paragraph (line with a word; a line of more than ``WINDOW`` words is read in windows of that many, each half
over the one before) becomes hashed word one- and two-grams; a sparse multinomial logistic regression
tells licence families from the class ``unknown``.  It is fitted on variants of the templates (words left out, parts
cut) against remarks that only sound like licences and every distinct paragraph of all documents that may be scored,
half of which calibrate: a family must be at least as likely as the strictest ``1 - FALSE_RATE`` of those paragraphs.
A prediction then counts only if the paragraph shares at least ``OVERLAP`` of its two-grams (or of the template's, if
that is shorter) with a template of that family.  Paragraphs without any two-gram of a template cannot be confirmed: they
are neither scored nor learned from.

Null and empty texts have no paragraphs.  Rows equal in id and text are scanned once and reported each.  Documents
that hold a licence stand among the background; those paragraphs are recognised by the templates and left out.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.llm.common import row_key, stage, text_of
from snapstats.llm.decontaminate import let

FEATURES, FALSE_RATE, OVERLAP = 1 << 14, 0.001, 0.6
VARIANTS = 24
WINDOW = 120
#: Rows meet the estimator in blocks, each read once per family: small enough that it and the gradients it adds to stay in a core's cache.
BLOCK_MB = 0.125
#: So many tasks of the scan are one of the estimator: each moves a gradient of all features and families once per iteration.
MERGED = 4
#: A reservation of rights stands in the header of most licences: it names the licence only if nothing else does.
WEAK = "Proprietary"

#: Notices by which works name their licence.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
    ),
    "MIT": (
        "Licensed under the MIT License.",
        "This software is released under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation.",
        "Licensed under the GPL version 2 or later.",
        "This program is licensed under the terms of the GNU General Public License, version 3.",
    ),
    "LGPL": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This work is licensed under the terms of the GNU Affero General Public License.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
    ),
    "MPL": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This software is released under the Unlicense.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, Version 2.0.",
    ),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",),
    "Proprietary": ("All rights reserved.", "This document is confidential and may not be reproduced without prior written permission of the owner."),
}
#: Identifiers of the families in a line ``SPDX-License-Identifier: <identifier>``.
IDENTIFIERS = {
    "Apache-2.0": ("Apache-2.0",), "MIT": ("MIT",), "ISC": ("ISC",), "Unlicense": ("Unlicense",), "EPL": ("EPL-1.0", "EPL-2.0"),
    "GPL": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "AGPL": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "BSD": ("BSD-2-Clause", "BSD-3-Clause"), "MPL": ("MPL-2.0",),
    "CC-BY": ("CC-BY-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",), "CC-BY-NC": ("CC-BY-NC-4.0",), "CC0": ("CC0-1.0",),
}
#: Remarks of the class ``unknown`` that share words with notices.
REMARKS = (
    "The driver must show a valid license and proof of insurance.", "Version 2.0 of the report is due on Friday.",
    "The work is done under the terms of the contract.", "Permission to enter was granted by the guard.",
    "The public library is free and open to any person.", "The software may be used with or without a network.",
    "Copies of the following documents are provided.", "The commons were open to the public.", "MIT is a university in Cambridge.",
    "An Apache helicopter landed on the field.", "All rights of way are marked on the map.", "He was licensed to sell the general store.",
)


def words_of(paragraph: Column) -> Column:
    """Lower-case words; versions and hyphenated names stay whole.  No word could end earlier, so nothing is kept to go back to."""
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]++(?:[.-][\p{L}\p{N}]++)*+"), F.lit(0))


def two_grams(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                                                lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))


def notices() -> list[tuple[str, str]]:
    """Family and text of every template, identifiers included."""
    tags = [(family, f"SPDX-License-Identifier: {name}") for family, names in IDENTIFIERS.items() for name in names]
    return [(family, text) for family, texts in TEMPLATES.items() for text in texts] + tags


def templates(spark: SparkSession) -> DataFrame:
    """family, template, and its distinct two-grams."""
    return spark.createDataFrame(notices(), "family string, template string").withColumn(
        "grams", F.array_distinct(two_grams(words_of(F.col("template")))))


def similarity(grams: Column, families: dict[str, list[list[str]]]) -> Column:
    """By family: the largest share of the (distinct) two-grams in common with one of its templates."""
    def share(met: Column, own: list[str]) -> Column:
        return F.size(F.filter(met, lambda g: g.isin(own))) / F.greatest(F.least(F.size(grams), F.lit(len(own))), F.lit(1))

    return let(F.filter(grams, lambda g: g.isin(_every(families))), lambda met: F.array(
        *[F.greatest(*[share(met, own) for own in texts], F.lit(0.0)) for texts in families.values()]))


def _every(families: dict[str, list[list[str]]]) -> list[str]:
    return sorted({g for texts in families.values() for own in texts for g in own})


def has_any(words: Column, grams: list[str]) -> Column:
    """Whether two neighbouring words are one of the two-grams, which are built only of words that stand in some."""
    first, second = (sorted({g.split(" ")[i] for g in grams}) for i in (0, 1))
    n = F.greatest(F.size(words) - 1, F.lit(0))
    met = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n),
                     lambda a, b: a.isin(first) & b.isin(second) & F.concat(a, F.lit(" "), b).isin(grams))
    return F.exists(met, lambda x: x)


def _known(spark: SparkSession) -> dict[str, list[list[str]]]:
    out: dict[str, list[list[str]]] = {}
    for r in templates(spark).collect():  # the templates above, nothing of the documents
        out.setdefault(r["family"], []).append(r["grams"])
    return {family: out[family] for family in TEMPLATES}


def _featured(rows: DataFrame) -> DataFrame:
    """``features`` of the array column ``words`` and of ``grams``, its two-grams."""
    none = F.array().cast("array<string>")  # the optimizer may move the estimator before a filter of nulls
    terms = rows.withColumn("terms", F.coalesce(F.concat("words", "grams"), none)).drop("grams")
    return HashingTF(inputCol="terms", outputCol="features", numFeatures=FEATURES, binary=True).transform(terms).drop("terms")


def windows(words: Column) -> Column:
    """The words as one array, or as half-overlapping windows of ``WINDOW`` words that cover them all."""
    half = WINDOW // 2
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(words) / half).cast("int") - 2, F.lit(0)))
    return F.when(F.size(words) <= WINDOW, F.array(words)).otherwise(
        F.transform(starts, lambda n: F.slice(words, n * half + 1, F.lit(WINDOW))))


def paragraphs(docs: DataFrame, wanted=None) -> DataFrame:
    """Row key and words of each line (or window of a line) that has any, or of those whose words are ``wanted``."""
    worded = F.transform(F.split(text_of(), "\n"), words_of)  # lines without a word go with ``wanted``
    lines = F.filter(F.flatten(F.transform(worded, windows)), wanted or (lambda w: F.size(w) > 0))
    rows = docs.select(*row_key(), lines.alias("lines"))  # keys first: rows of a line carry no text
    return rows.select("_k1", "_k2", F.explode_outer("lines").alias("words")).where(F.col("words").isNotNull())


def able_paragraphs(docs: DataFrame) -> DataFrame:
    """Those that hold a two-gram of a template, without which they cannot be confirmed: their ``features``, a hash ``h``
    of their words, and ``alike``, by family the similarity to its templates."""
    known = _known(docs.sparkSession)
    rows = paragraphs(docs, lambda words: has_any(words, _every(known)))
    alike = let(F.col("grams"), lambda grams: similarity(grams, known))
    # the distinct two-grams are made once, for the similarity and for the features
    return _featured(rows.withColumn("grams", F.array_distinct(two_grams(F.col("words")))).select(
        "_k1", "_k2", "words", "grams", F.xxhash64("words").alias("h"), alike.alias("alike")))


def training_rows(able: DataFrame, content: str = "words") -> DataFrame:
    """label (0 unknown, else the place of the family), words (or ``features``), and ``tune`` for the half that calibrates."""
    spark = able.sparkSession
    place = {family: i + 1 for i, family in enumerate(TEMPLATES)}
    base = spark.createDataFrame(
        [(float(place[f]), t) for f, t in notices()] + [(0.0, t) for t in REMARKS], "label double, text string")
    words = base.select("label", words_of(F.col("text")).alias("all"), F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"))
    # variant 0 is whole; others lose about one word in eight, or all behind a place in the second half
    thinned = F.filter("all", lambda w: F.pmod(F.xxhash64(w, F.col("v")), F.lit(8)) > 0)
    cut = F.slice("all", 1, F.greatest(F.lit(2), F.size("all") - F.pmod("v", F.floor(F.size("all") / 2) + 1).cast("int")))
    varied = words.select("label", F.when(F.col("v") == 0, F.col("all")).when(F.col("v") % 2 == 1, thinned).otherwise(cut).alias("words"),
                          F.lit(False).alias("tune"))
    foreign = able.where(F.array_max("alike") < 0.5).select(content, "h").dropDuplicates(["h"])
    background = foreign.select(F.lit(0.0).alias("label"), content, (F.pmod("h", F.lit(2)) == 0).alias("tune"))
    own = _featured(varied.withColumn("grams", two_grams(F.col("words"))))
    return own.select("label", content, "tune").unionByName(background)


def fewer(rows: DataFrame) -> DataFrame:
    """The rows of a scan in a ``MERGED``-th as many tasks, but no fewer than the cores (if it has so many)."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.rdd.getNumPartitions() // MERGED)))


def fit(able: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """The model, and the least probability of a family that counts, of all paragraphs that may be scored."""
    rows = stage(training_rows(able, "features"), "license-training")
    seen = fewer(rows.where("not tune"))
    model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, maxBlockSizeInMB=BLOCK_MB,
                               probabilityCol="chance").fit(seen)
    best = F.array_max(F.slice(_chances(), 2, len(TEMPLATES)))
    strict = model.transform(rows.where("tune")).agg(F.percentile_approx(best, 1 - FALSE_RATE, 1_000_000)).first()[0]
    return model, max(0.5, strict or 0.0)


def _chances() -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col("chance"))


def classified(docs: DataFrame) -> DataFrame:
    """Row key, family, chance and similarity of every confirmed paragraph."""
    able = stage(able_paragraphs(docs).drop("words"), "license-able")  # texts are read and hashed once for learning and scoring
    model, least = fit(able)
    # a prediction must be as similar as this to a template of its family, so paragraphs below it for all give no row
    scored = model.transform(able.where(F.array_max("alike") >= OVERLAP)).select("_k1", "_k2", "alike", _chances().alias("chances"))
    families = F.slice("chances", 2, len(TEMPLATES))
    best = F.array_max(families)
    named = scored.select("_k1", "_k2", "alike", best.alias("chance"), (F.array_position(families, best) - 1).cast("int").alias("place"))
    likely = named.where(F.col("chance") >= least)
    names = F.array(*map(F.lit, TEMPLATES))
    return likely.select("_k1", "_k2", F.get(names, F.col("place")).alias("family"), "chance",
                         F.get("alike", F.col("place")).alias("similarity")).where(F.col("similarity") >= OVERLAP)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the families found (sorted), the likeliest one (null: unknown), its chance and similarity, and how many paragraphs or windows."""
    found = stage(classified(docs), "license-paragraphs").groupBy("_k1", "_k2").agg(
        F.array_sort(F.collect_set("family")).alias("families"), F.count("*").alias("n"),
        F.max(F.struct(F.col("family") != WEAK, "chance", "similarity", "family")).alias("best"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key())
    copies = rows.groupBy("_k1", "_k2", "doc_id").count()
    met = copies.join(found, ["_k1", "_k2"], "left").select(
        "doc_id", F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"), F.col("best.family").alias("license"),
        F.col("best.chance").alias("chance"), F.col("best.similarity").alias("similarity"),
        (F.coalesce("n", F.lit(0)) / F.col("count")).cast("long").alias("n_paragraphs"), "count")
    return met.withColumn("_", F.explode(F.sequence(F.lit(1), "count"))).drop("_", "count")
