"""Licence notices in texts: a trained paragraph classifier, confirmed by templates.

A sparse multinomial logistic regression over word n-grams tells licence families and an
unknown class apart; its cut for calling a paragraph known is taken from held-out unknown
paragraphs, and a template of the family must agree. Training is a bounded job of Spark's
ML; scoring is built-in functions over each row, without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.llm.base import landed

# Usual short notices of public licences, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under Apache-2.0.",
        "Dual MIT/Apache-2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Distributed under the GNU GPL version 2 or later license.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "bsd": [
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This file is subject to the terms of the MPL, v. 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "Available under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution ShareAlike License CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.",
        "Available under the CC BY-NC-SA 4.0 license for noncommercial use.",
    ],
    "public-domain": [
        "This work is released into the public domain under CC0 1.0 Universal.",
        "Released under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain license.",
    ],
}
# Paragraphs with words of notices that are no notice.
NO_NOTICES = [
    "He lost his driver's license on the way to the office.",
    "The city will issue a fishing license to every person who asks.",
    "Their license to sell alcohol expired in version two of the form.",
    "All rights reserved, copyright by the authors.",
    "The court heard a copyright case about a song.",
    "She asked for permission to use the room free of charge.",
    "The warranty of the car ended after two years of use.",
    "Licensed doctors work under the terms of the hospital.",
    "A member of the public may inspect the source of the river.",
    "The general said the foundation was published in binary code.",
    "An Apache helicopter landed with permission from the tower.",
    "Poetic license, under the circumstances, was the work of the editor.",
]
UNKNOWN = "unknown"
#: Documents and, of these, paragraphs that the unknown class learns from, at most.
SAMPLE_DOCS, SAMPLE_ROWS = 300, 1500
#: The least cut, the share of held-out unknown paragraphs below it, and the least overlap
#: with a template (shared n-grams over those of the shorter of the two).
LEAST_CUT, BELOW, LEAST_OVERLAP = 0.5, 0.995, 0.6
#: Temperatures tried in calibration: from sharper to much softer than fitted.
TEMPERATURES = [round(1.15**i, 4) for i in range(-10, 26)]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*"), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often it stands in the result."""
    return F.transform(F.array(value), use)[0]


def grams_of(words: Column) -> Column:
    """Distinct words, pairs and triples of words."""

    def made(w: Column) -> Column:
        def runs(n: int) -> Column:
            def run(i: Column) -> Column:
                return F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)])

            return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), run)).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.concat(w, runs(2), runs(3)))

    return bound(words, made)


def matches(template: Column, grams: Column) -> Column:
    """Whether the n-grams of a paragraph and of a template overlap enough."""
    return F.size(F.array_intersect(template, grams)) >= F.least(F.size(template), F.size(grams)) * LEAST_OVERLAP


def _lessons(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(family, grams, held) of templates, cut shorter at either end, and unknown paragraphs."""
    known = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, text string")
    words = known.select("family", words_of(F.col("text")).alias("w"))
    cuts = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda i: F.slice("w", i.bitwiseAND(1) + 1, F.size("w") - i.bitwiseAND(1) - F.shiftright(i, 1)),
    )
    notices = words.select("family", F.posexplode(cuts).alias("cut", "w")).filter(F.size("w") >= 3)
    fixed = spark.createDataFrame([(t,) for t in NO_NOTICES], "text string").select(words_of(F.col("text")).alias("w"))
    some = docs.select(F.xxhash64("doc_id", "text").alias("order"), "text").orderBy("order", "text").limit(SAMPLE_DOCS)
    lines = some.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    sample = lines.distinct().orderBy(F.xxhash64("line"), "line").limit(SAMPLE_ROWS).select(words_of(F.col("line")).alias("w"))
    # all lines are scored, so all may be drawn, but those that a template matches are notices
    shown = [r.grams for r in known.select(grams_of(words_of(F.col("text"))).alias("grams")).collect()]
    templates = F.from_json(F.lit(json.dumps(shown)), "array<array<string>>")
    sample = sample.filter(bound(grams_of(F.col("w")), lambda grams: ~F.exists(templates, lambda t: matches(t, grams))))
    unknown = fixed.unionByName(sample).filter(F.size("w") > 0).select(F.lit(UNKNOWN).alias("family"), F.lit(1).alias("cut"), "w")
    held = (F.col("cut") > 0) & (F.pmod(F.xxhash64("w"), F.lit(3)) == 0)
    return notices.unionByName(unknown).select("family", grams_of(F.col("w")).alias("grams"), held.alias("held"))


def softened(scores: Column, temperature: Column) -> Column:
    """Probabilities of the classes out of an array of scores."""

    def shares(powers: Column) -> Column:
        return bound(F.aggregate(powers, F.lit(0.0), lambda a, x: a + x), lambda mass: F.transform(powers, lambda x: x / mass))

    return bound(F.array_max(scores), lambda top: bound(F.transform(scores, lambda x: F.exp((x - top) / temperature)), shares))


def _calibrated(held: DataFrame) -> dict:
    """Temperature, cut and error rates, of held-out rows (scores, label, weight).

    The temperature makes the held-out paragraphs most likely; the cut is the probability that
    only a share of 1 - BELOW of the unknown ones exceed. Both are aggregates over the bounded sample.
    """
    tried = held.crossJoin(held.sparkSession.createDataFrame([(t,) for t in TEMPERATURES], "t double"))
    loss = F.sum(-F.col("weight") * F.log(F.greatest(F.get(softened(F.col("scores"), F.col("t")), F.col("label").cast("int")), F.lit(1e-300))))
    temperature = tried.groupBy("t").agg(loss.alias("loss")).orderBy("loss", "t").first()
    temperature = temperature.t if temperature else 1.0
    shares = held.select("label", softened(F.col("scores"), F.lit(temperature)).alias("p"))
    unknown = F.col("label") == len(TEMPLATES)
    likely = F.array_max(F.slice("p", 1, len(TEMPLATES)))
    cut = shares.agg(F.percentile(F.when(unknown, likely), F.lit(BELOW))).first()[0]
    cut = max(LEAST_CUT, float(cut or 0))
    right = F.get("p", F.col("label").cast("int")) >= cut
    rates = shares.agg(
        F.count_if(~unknown).alias("notices"),
        F.count_if(~unknown & ~right).alias("missed"),
        F.count_if(unknown).alias("unknown"),
        F.count_if(unknown & (likely >= cut)).alias("false"),
    ).first()
    return {"temperature": temperature, "cut": cut, "held_out": rates.asDict()}


def train(docs: DataFrame) -> dict:
    """The model: classes, weights of each n-gram of a notice, constants, temperature, cut and
    what the cut does to held-out paragraphs.

    Learns from the templates and at most SAMPLE_ROWS paragraphs of SAMPLE_DOCS documents, the
    first by a hash; what comes back to the driver has a size fixed by the templates. A third
    of the shortened notices and of the unknown paragraphs is held out, for calibration.
    """
    spark = docs.sparkSession
    classes = [*TEMPLATES, UNKNOWN]
    rows = _lessons(spark, docs).withColumn("label", (F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1).cast("double"))
    rows = landed(rows.withColumn("weight", F.when(F.col("family") == UNKNOWN, 1.0).otherwise(5.0)), "licence-lessons")
    vocabulary = [r[0] for r in rows.filter(F.col("family") != UNKNOWN).select(F.explode("grams")).distinct().orderBy(F.lit(1)).collect()]
    vectors = CountVectorizerModel.from_vocabulary(sorted(vocabulary), inputCol="grams", outputCol="features", binary=True)
    counted = vectors.transform(rows)
    regression = LogisticRegression(
        family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=60, standardization=False, weightCol="weight"
    )
    fitted = regression.fit(counted.filter(~F.col("held")))
    scored = fitted.transform(counted.filter("held")).select(vector_to_array("rawPrediction").alias("scores"), "label", "weight")
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: [round(float(x), 6) for x in matrix[:, i]] for i, g in enumerate(vectors.vocabulary) if matrix[:, i].any()}
    often = rows.filter(F.col("family") == UNKNOWN).select(F.explode("grams").alias("g")).filter(~F.col("g").contains(" "))
    often = often.filter(F.col("g").isin(*{w for g in weights for w in g.split(" ")})).groupBy("g").count().collect()
    return {
        "classes": classes,
        "constants": [float(x) for x in fitted.interceptVector],
        "weights": weights,
        "often": {r.g: r["count"] for r in often},
        **_calibrated(landed(scored, "licence-held")),
    }


def gate(model: dict) -> str | None:
    """A pattern that every lower-case paragraph has which the model can call known; None if it can be any.

    The cut is at least a half, so a family has to outweigh the unknown class: the n-grams of the
    paragraph must make up for the lead of its constant. Words that ordinary paragraphs often
    have are left out of the pattern, from the most frequent one on, as long as the n-grams made of
    such words alone cannot make up for it, all taken together. So a known paragraph has an
    n-gram with another word, and that word (the rarest of the n-gram) is in the pattern.
    """
    *families, unknown = range(len(model["classes"]))
    constants, often = model["constants"], model["often"]
    lead = [constants[unknown] - constants[f] for f in families]
    if model["cut"] < 0.5 or min(lead) <= 0:
        return None
    margins = {g: [max(w[f] - w[unknown], 0.0) for f in families] for g, w in model["weights"].items()}
    margins = {g: m for g, m in margins.items() if any(m)}
    words = sorted({w for g in margins for w in g.split(" ")}, key=lambda w: (-often.get(w, 0), w))
    common: set[str] = set()
    for word in words:
        inside = [m for g, m in margins.items() if set(g.split(" ")) <= common | {word}]
        if often.get(word, 0) and all(sum(m[f] for m in inside) < lead[f] - 1e-6 for f in families):
            common.add(word)
    needed = set()
    for gram in margins:
        if rest := [w for w in gram.split(" ") if w not in common]:
            needed.add(min(rest, key=lambda w: (often.get(w, 0), -len(w), w)))
    # words hold nothing but a-z, 0-9 and the three signs inside them
    return "(?<![a-z0-9])(?:" + "|".join(w.replace(".", "[.]") for w in sorted(needed)) + ")(?![a-z0-9])" if needed else "(?!)"


def _judged(line: Column, model: dict, templates: Column, weights: Column) -> Column:
    """family and probability of a paragraph, or null."""
    classes = F.array(*map(F.lit, model["classes"]))
    start = F.array(*map(F.lit, model["constants"]))

    def judged(grams: Column) -> Column:
        known = F.array_intersect(grams, F.map_keys(weights))
        sums = F.aggregate(known, start, lambda a, g: F.zip_with(a, F.element_at(weights, g), lambda x, y: x + y))
        return bound(sums, lambda s: bound(softened(s, F.lit(model["temperature"])), lambda p: rated(grams, p)))

    def rated(grams: Column, shares: Column) -> Column:
        def named(top: Column) -> Column:
            family = F.element_at(classes, F.array_position(shares, top).cast("int"))
            near = F.exists(F.element_at(templates, family), lambda t: matches(t, grams))
            fits = (family != UNKNOWN) & (top >= model["cut"]) & F.coalesce(near, F.lit(False))
            return F.when(fits, F.struct(family.alias("family"), F.round(top, 6).alias("probability")))

        return bound(F.array_max(shares), named)

    return bound(grams_of(words_of(line)), judged)


def with_licences(docs: DataFrame, model: dict, keep: list[Column]) -> DataFrame:
    """``keep`` columns, n_paragraphs, licences (paragraph, family, probability) and families.

    A paragraph is a line, and n_paragraphs counts lines. Lines between two blank ones are
    also judged together: a notice wrapped over them has the number of the first. It is left
    out if a line of the block has the same family. Null texts have no paragraph, empty ones
    one without words; every row of the input gives one row, an empty table none. The work is linear in a text.
    """
    spark = docs.sparkSession
    shown = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, text string")
    lists: dict[str, list] = {UNKNOWN: []}
    for r in shown.select("family", grams_of(words_of(F.col("text"))).alias("grams")).collect():
        lists.setdefault(r.family, []).append(r.grams)
    # constants of the plan: their size is that of the templates
    templates = F.from_json(F.lit(json.dumps(lists)), "map<string,array<array<string>>>")
    weights = F.from_json(F.lit(json.dumps(model["weights"])), "map<string,array<double>>")
    pattern = gate(model)
    licence = "struct<paragraph:int,family:string,probability:double>"

    def opened(text: Column) -> Column:
        return F.lower(text).rlike(pattern) if pattern else F.lit(True)

    def verdict(text: Column) -> Column:
        return F.when(opened(text), _judged(text, model, templates, weights))

    def located(place: Column, found: Column) -> Column:
        return F.struct(place.cast("int").alias("paragraph"), found.family.alias("family"), found.probability.alias("probability"))

    def alone(own: Column) -> Column:
        """What single lines are, of one verdict a line."""
        each = F.transform(own, lambda v, i: F.when(v.isNotNull(), located(i, v)))
        return F.filter(each, lambda s: s.isNotNull())

    def together(lines: Column, own: Column) -> Column:
        """What blocks of several lines are that none of their lines is."""
        full = F.transform(lines, lambda x: x.rlike(r"\S"))
        edges = bound(full, lambda f: F.filter(F.transform(f, lambda x, i: F.when(x & ~F.coalesce(F.get(f, i - 1), F.lit(False)), i)), lambda i: i.isNotNull()))
        ends = bound(full, lambda f: F.filter(F.transform(f, lambda x, i: F.when(x & ~F.coalesce(F.get(f, i + 1), F.lit(False)), i)), lambda i: i.isNotNull()))
        blocks = F.filter(F.split(F.col("text"), r"\n\s*\n"), lambda b: b.rlike(r"\S"))
        ranges = F.zip_with(edges, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last")))

        def known(r: Column, v: Column) -> Column:
            same = F.exists(F.sequence(r["first"], r["last"]), lambda j: F.get(own, j).family == v.family)
            return F.when(v.isNotNull() & ~F.coalesce(same, F.lit(False)), located(r["first"], v))

        each = F.zip_with(ranges, blocks, lambda r, b: bound(F.when(r["last"] > r["first"], verdict(b)), lambda v: known(r, v)))
        return F.filter(each, lambda s: s.isNotNull())

    def found(lines: Column) -> Column:
        return bound(F.transform(lines, verdict), lambda own: F.concat(alone(own), together(lines, own)))

    lines = F.split(F.col("text"), "\n")
    kept = docs.select(
        F.struct(*keep).alias("kept"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_paragraphs"),
        F.when(opened(F.col("text")), F.array_sort(bound(lines, found))).alias("licences"),
    )
    return kept.select(
        "kept.*",
        "n_paragraphs",
        F.coalesce("licences", F.array().cast(f"array<{licence}>")).alias("licences"),
    ).withColumn("families", F.array_sort(F.array_distinct("licences.family")))
