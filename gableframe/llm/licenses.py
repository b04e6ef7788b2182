"""Licence notices in documents, by a trained paragraph classifier.

A logistic regression over word n-grams (one to three words, present or not) gives
a paragraph's family, with a class of its own for text that is no notice. It is
trained on the notices below, on parts of them, on sentences that only sound like
them, and on a bounded sample of the corpus. Its probabilities are softened by a
temperature fitted on held-out parts. A family that is found is confirmed by
comparing the paragraph with that family's notices.

Every n-gram of the notices counts. In each paragraph the n-grams that are in the
vocabulary are found by set membership, and a bound of what they can say for any
family decides exactly which paragraphs can be more than unknown; the corpus has no
part in it. Only those are scored, once however many documents repeat them. The main
path is DataFrame operations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

UNKNOWN = "unknown"
FOLDS = 4
LEVELS = 8  # sets of n-grams of like gain, for the bound

# Customary notices of licence families.
NOTICES = {
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the software.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL, version 2 or later.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright by the authors. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This software is proprietary and confidential.",
    ],
}
NO_NOTICES = [
    "He lost his driving license on the way to the office.",
    "The license plate of the car was not readable.",
    "She studied physics at MIT and moved to Boston.",
    "The apache helicopter landed behind the hill.",
    "Public opinion in general turned against the version they had published.",
    "The right to vote is reserved for citizens.",
    "All rooms were reserved for the guests.",
    "The program is free of charge for students.",
    "Copyright law was the subject of the lecture.",
    "The gnu is an antelope of the open plains.",
    "They asked for permission to use the library.",
    "The foundation published its terms and conditions for grants.",
]
# A line with one of these may be a notice, so it never stands for text that is none.
LICENCE_WORDS = (
    "agpl apache bsd by cc cc0 commons confidential copyright copyrighted creative domain gnu gpl lgpl licence licences "
    "licensed license licenses licensing mit mozilla mpl nc permission permissions proprietary redistribute redistribution "
    "reserved rights sa unencumbered unlicense warranties warranty"
).split()


@dataclass(frozen=True)
class Settings:
    """``sample``: documents whose paragraphs stand for text that is no notice, at
    most.
    ``accept``: calibrated probability from which a family is named.
    ``confirm``: share of common word pairs, of the shorter of paragraph and notice,
    that confirms it."""

    sample: int = 400
    accept: float = 0.5
    confirm: float = 0.5
    penalty: float = 0.003


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def ngrams(tokens: Column, least: int, most: int) -> Column:
    """Different runs of ``least`` to ``most`` words."""

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(tokens) - size + 1)
        found = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, size), " "))
        return F.when(F.size(tokens) >= size, found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(runs, range(least, most + 1))))


def paragraphs(text: Column) -> Column:
    """Non-empty lines, trimmed."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"[\r\n]+"), lambda x: F.trim(x))
    return F.array_remove(lines, "")


def parts_of(notice: str) -> list[str]:
    """A notice, and its runs of at least four words and three fifths of it."""
    split = notice.split()
    shortest = max(4, math.ceil(0.6 * len(split)))
    runs = {" ".join(split[i:j]) for i in range(len(split)) for j in range(i + shortest, len(split) + 1)}
    return sorted(runs | {notice})


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]  # the last one is unknown
    weights: tuple[tuple[str, tuple[float, ...]], ...]  # n-gram, weight per family
    intercepts: tuple[float, ...]
    triggers: tuple[str, ...]  # all words of the notices; every n-gram holds one


def fit(docs: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text") -> Model:
    """Trains on the notices and a sample of the corpus; the sample is by hash of the
    key, and only its paragraphs without licence words stand for text that is no
    notice. Which paragraphs are scored does not depend on the corpus."""
    spark = docs.sparkSession
    chosen = docs.select(F.col(key).alias("__key")).where("__key IS NOT NULL").distinct().orderBy(F.xxhash64("__key"), "__key").limit(cfg.sample)
    chosen = materialize(chosen, "license-sample")
    sampled = docs.join(F.broadcast(chosen), docs[key] == chosen["__key"]).select(F.explode(paragraphs(F.col(text))).alias("p")).distinct()
    notices = [(family, part) for family, texts in NOTICES.items() for notice in texts for part in parts_of(notice)]
    notices += [(UNKNOWN, part) for part in NO_NOTICES]
    known = spark.createDataFrame(notices, "family string, p string")
    licence_words = known.where(F.col("family") != UNKNOWN).select(F.explode(words(F.col("p"))).alias("w")).distinct()
    triggers = sorted(r["w"] for r in licence_words.collect())
    # lines that may be notices must not teach that notices are ordinary
    clear = sampled.where(~F.arrays_overlap(words(F.col("p")), F.array(*map(F.lit, LICENCE_WORDS))))
    negatives = clear.select(F.lit(UNKNOWN).alias("family"), "p").orderBy(F.xxhash64("p")).limit(4 * cfg.sample)
    table = known.union(negatives).select("family", "p", words(F.col("p")).alias("ws")).select("family", "p", ngrams(F.col("ws"), 1, 3).alias("grams"))
    table = materialize(table.withColumn("fold", F.pmod(F.xxhash64("p"), F.lit(FOLDS))), "license-train")
    families = (*NOTICES, UNKNOWN)
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    vectors = CountVectorizer(inputCol="grams", outputCol="v", binary=True, minDF=1.0).fit(table.where(F.col("family") != UNKNOWN))
    rows = vectors.transform(table.withColumn("y", number)).coalesce(1)  # a few thousand rows: one task a step
    learn = LogisticRegression(featuresCol="v", labelCol="y", regParam=cfg.penalty, family="multinomial", maxIter=100)
    held_out = learn.fit(rows.where("fold <> 0")).transform(rows.where("fold = 0")).select("rawPrediction", "y").collect()
    heat = temperature(np.array([r[0].toArray() for r in held_out]), np.array([int(r[1]) for r in held_out]))
    model = learn.fit(rows)
    matrix = model.coefficientMatrix.toArray() / heat
    weights = tuple((g, tuple(map(float, matrix[:, i]))) for i, g in enumerate(vectors.vocabulary))
    return Model(families, weights, tuple(float(x) / heat for x in model.interceptVector), tuple(triggers))


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """By which scores are divided so that held-out probabilities fit best."""
    if not len(scores):
        return 1.0

    def loss(heat: float) -> float:
        z = scores / heat
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]))

    return min(np.geomspace(0.25, 8, 41).tolist(), key=loss)


def _runs(known: Column, size: int, vocabulary: list[str]) -> Column:
    """Runs of ``size`` words that are in the vocabulary; a null breaks a run."""
    if not vocabulary:
        return F.array().cast("array<string>")

    def joined(i: Column) -> Column:
        return F.concat(known[i - 1], *(part for j in range(1, size) for part in (F.lit(" "), known[i - 1 + j])))

    runs = F.transform(F.sequence(F.lit(1), F.size(known) - size + 1), joined)
    return F.when(F.size(known) >= size, F.filter(runs, lambda g: g.isin(vocabulary))).otherwise(F.array().cast("array<string>"))


def possible(texts: DataFrame, model: Model) -> DataFrame:
    """The columns of ``texts``, which has ``p``, with ``grams``, the different n-grams
    of ``p`` in the vocabulary, and ``possible``: false where unknown is certainly the
    likeliest class.

    An n-gram favours no family over unknown by more than its gain, and gains are
    rounded up to the greatest of their level, so their sum is an upper bound.
    """
    by_size: dict[int, list[str]] = {1: [], 2: [], 3: []}
    gains: dict[str, float] = {}
    for gram, w in model.weights:
        by_size[gram.count(" ") + 1].append(gram)
        gains[gram] = max(w[:-1]) - w[-1]
    order = sorted(gains, key=gains.get)
    levels = [part.tolist() for part in np.array_split(np.array(order, dtype=object), LEVELS) if len(part)]
    kept = texts.columns

    def once(value: Column) -> Column:
        # a condition on the row's number, always true, keeps filters and later steps from repeating the work
        return F.when(F.monotonically_increasing_id() >= 0, value)

    known = F.transform(words(F.col("p")), lambda w: F.when(w.isin(by_size[1]), w))
    split = texts.select("*", once(known).alias("__known"))
    runs = [F.filter("__known", lambda w: w.isNotNull()), *(_runs(F.col("__known"), n, by_size[n]) for n in (2, 3))]
    found = split.select(*kept, once(F.array_distinct(F.concat(*runs))).alias("grams"))

    def gain(level: list[str]) -> Column:
        return F.size(F.filter("grams", lambda g: g.isin(level))) * F.lit(gains[level[-1]])

    bound = sum(map(gain, levels), F.lit(max(model.intercepts[:-1]) - model.intercepts[-1] + 1e-6))
    return found.select(*kept, "grams", once(F.col("p").isNotNull() & (F.size("grams") > 0) & (bound > 0)).alias("possible"))


def classify(texts: DataFrame, model: Model, cfg: Settings = Settings()) -> DataFrame:
    """``(p, family, probability, likeness)`` for each different paragraph ``p`` of
    ``texts(p, grams)``; paragraphs without a family that is likely enough are absent."""
    spark = texts.sparkSession
    k = len(model.families)
    # vocabulary and notices come from the fixed list above, so their size is fixed
    weights = F.broadcast(spark.createDataFrame(list(model.weights), "gram string, w array<double>"))
    grams = texts.dropDuplicates(["p"]).select("p", F.explode("grams").alias("gram")).join(weights, "gram")
    sums = grams.groupBy("p").agg(F.array(*(F.sum(F.col("w")[i]) for i in range(k))).alias("z"))
    z = F.transform(F.zip_with("z", F.array(*map(F.lit, model.intercepts)), lambda a, b: a + b), lambda x: x)
    top = sums.withColumn("z", z).withColumn("top", F.array_max("z"))
    shares = F.transform("z", lambda x: F.exp(x - F.col("top")))
    total = F.aggregate("shares", F.lit(0.0), lambda a, b: a + b)
    best = F.array_position("z", F.col("top")).cast("int")
    scored = top.withColumn("shares", shares).select(
        "p", F.element_at(F.array(*map(F.lit, model.families)), best).alias("family"), (F.lit(1.0) / total).alias("probability")
    )
    named = (F.col("family") != UNKNOWN) & (F.col("probability") >= cfg.accept)
    notices = F.broadcast(
        spark.createDataFrame([(f, n) for f, texts_ in NOTICES.items() for n in texts_], "family string, notice string")
        .select("family", ngrams(words(F.col("notice")), 2, 2).alias("pairs"))
        .groupBy("family").agg(F.collect_list("pairs").alias("notices"))
    )
    own = ngrams(words(F.col("p")), 2, 2)
    like = F.array_max(
        F.transform(
            "notices",
            lambda n: F.size(F.array_intersect(n, F.col("own"))) / F.greatest(F.least(F.size(n), F.size("own")), F.lit(1)),
        )
    )
    checked = scored.where(named).withColumn("own", own).join(notices, "family", "left").withColumn("likeness", like)
    return checked.select("p", "family", "probability", "likeness")


def scan(docs: DataFrame, model: Model, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``license`` (family of its likeliest notice, or
    unknown), ``probability``, ``likeness``, ``confirmed``, ``n_notices``.

    Null and empty texts are unknown, as are documents without a notice: their
    probability and likeness are null, and nothing is confirmed. Repeated rows stay
    repeated, null keys are kept, other columns are not read. Ties go to the better
    likeness, then to the first family by name.
    """
    numbered = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    rows = numbered.select("key", "row", F.posexplode_outer(paragraphs(F.col("text"))).alias("pos", "p"))
    found = possible(rows.select("key", "row", F.coalesce("pos", F.lit(0)).alias("pos"), "p"), model)
    # the first paragraph stands for its document, also where there is none
    found = materialize(found.where("possible OR pos = 0").withColumn("p", F.expr("IF(possible, p, NULL)")), "license-candidates")
    single = found.where("possible")
    verdicts = materialize(classify(single.select("p", "grams"), model, cfg), "license-verdicts")
    rank = F.struct("probability", "likeness", F.transform(F.split("family", ""), lambda c: -F.ascii(c)))
    best = single.join(verdicts, "p").groupBy("row").agg(
        F.max_by(F.struct("family", "probability", "likeness"), rank).alias("v"), F.count("*").alias("n")
    )
    best = materialize(best, "license-best")
    out = found.where("pos = 0").select("row", "key").join(best, "row", "left")
    return out.select(
        F.col("key").alias(key),
        F.coalesce("v.family", F.lit(UNKNOWN)).alias("license"),
        F.col("v.probability").alias("probability"),
        F.col("v.likeness").alias("likeness"),
        F.coalesce(F.col("v.likeness") >= cfg.confirm, F.lit(False)).alias("confirmed"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_notices"),
    )


def find(spark: SparkSession, docs: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    return scan(docs, fit(docs, cfg, key, text), cfg, key, text)
