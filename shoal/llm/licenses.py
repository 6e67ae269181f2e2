"""Licence notices found by a trained paragraph classifier.

A text is read by its lines, in overlapping windows of ``WINDOW`` words where they are longer,
and in such windows that run over line ends, for notices that are wrapped. Hashed word 1- and 2-grams of every window feed a multinomial logistic
regression (Spark ML) over licence families and ordinary prose. It is trained
on notices made from ``TEMPLATES`` (windows of them, some with prose around) and on a
bounded sample of the corpus's own paragraphs (``SAMPLE`` of those of
``SAMPLE_TEXTS`` texts, without those that hold a template). On the held-out part of both a temperature
calibrates the probabilities, and the threshold for a family is the least value
that at most ``FALSE_RATE`` of held-out prose reaches. A paragraph that the
classifier takes for a licence, but whose best family stays below the threshold or
whose words hold none of the family's templates, is of family ``unknown``.

Every window is scored, most of them without the model itself: each word and word
pair of a text is hashed once, and a window's distinct codes are summed over the
largest lead that any family's coefficient has over prose's. Where that sum keeps
every family so far behind that prose has 0.5 or more, which is a bound and no
estimate, the window is done; the others are scored by the model.

All steps are JVM-side DataFrame and Spark ML operations; only the model, and counts
per class, reach the driver. Documents are read in one pass and not shuffled.

Defined results: null and empty texts have no paragraph and no row. Repeated rows
give repeated results. An empty table gives an empty result (the model then knows
the templates alone). Columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoal.llm.common import bounded_sample, checkpointed

WINDOW = 40
FEATURES = 1 << 13
SAMPLE_TEXTS = 2_000
SAMPLE = 10_000
FALSE_RATE = 0.001
HELD = 0.8  # share of a template's word pairs that confirms it
PROSE, UNKNOWN = "none", "unknown"

# Customary wordings of licence notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0."),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "Proprietary": (
        "All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher."),
}


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _pairs(tokens: Column) -> Column:
    """Word pairs, with a mark before the first and after the last word left out."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def _codes(words: Column, last: bool = False) -> Column:
    """Feature codes of words and pairs by turns: word, pair with the next, next word...
    The codes of ``n`` words from the i-th on are the 2n - 1 from place 2i on. With
    ``last`` the list ends with the null of the last word's pair."""
    word = lambda a: F.pmod(F.hash(a), F.lit(FEATURES))
    pair = lambda a, b: F.when(b.isNotNull(), F.pmod(F.hash(F.lit(1), a, b), F.lit(FEATURES)) + FEATURES)
    after = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    both = F.flatten(F.zip_with(words, after, lambda a, b: F.array(word(a), pair(a, b))))
    return both if last else F.filter(both, lambda x: x.isNotNull())


def _once(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with its columns computed before, not inside, what uses them: no
    projection or filter passes a generator."""
    return df.select(F.inline(F.array(F.struct(*(cols or df.columns)))))


def _starts(n: Column) -> Column:
    half = WINDOW // 2
    return F.sequence(F.lit(0), F.greatest(F.lit(0), n - half - 1), F.lit(half))


def paragraphs(documents: DataFrame, wanted=None) -> DataFrame:
    """(doc_id, line, at, words, lines): the windows of all lines that hold a word, and
    those of the whole text that hold words of several lines (``at`` counts from its
    start then). ``lines`` has the line of each word. ``wanted``: a condition on the
    codes of a window's words, which the others lack."""
    split = _once(documents.select("doc_id", F.transform(F.split("text", "\n", -1), _tokens).alias("_l")))
    flat = split.select("doc_id", F.flatten("_l").alias("_w"),
                        F.flatten(F.transform("_l", lambda w, i: F.array_repeat(i, F.size(w)))).alias("_i"),
                        F.filter(F.transform("_l", lambda w: F.size(w)), lambda n: n > 0).alias("_n"))
    flat = _once(flat.filter(F.size("_w") > 0))
    heads = F.filter(F.sequence(F.lit(0), F.size("_w") - 1),
                     lambda j: (j == 0) | (F.get("_i", j) != F.get("_i", F.greatest(j - 1, F.lit(0)))))
    codes = [_codes(F.col("_w"), last=True).alias("_c")] if wanted is not None else []
    flat = _once(flat.select("doc_id", "_w", "_i", "_n", heads.alias("_h"), *codes))
    window = lambda first, at, n: F.struct(first.alias("s"), at.alias("at"), F.least(F.lit(WINDOW), n).alias("n"))
    own = F.flatten(F.zip_with("_h", "_n", lambda h, n: F.transform(_starts(n), lambda j: window(h + j, j, n - j))))
    over = F.filter(F.transform(_starts(F.size("_w")), lambda j: window(j, j, F.size("_w") - j)),
                    lambda x: F.get("_i", x["s"]) < F.get("_i", x["s"] + x["n"] - 1))
    some = F.concat(own, over)
    if wanted is not None:
        some = F.filter(some, lambda x: wanted(F.slice("_c", 2 * x["s"] + 1, 2 * x["n"] - 1)))
    cut = F.transform(some, lambda x: F.struct(
        x["at"].alias("at"), F.slice("_w", x["s"] + 1, x["n"]).alias("words"), F.slice("_i", x["s"] + 1, x["n"]).alias("lines")))
    return (flat.select("doc_id", F.explode(cut).alias("_win"))
            .select("doc_id", F.get("_win.lines", F.lit(0)).alias("line"), "_win.at", "_win.words", "_win.lines"))


def _with_pairs(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pairs", _pairs(F.col("words")))


def _with_features(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_f", _codes(F.col("words")).cast("array<string>"))


def templates(spark: SparkSession) -> DataFrame:
    """(family, template, t_words, t_pairs)."""
    rows = [(f, i, t) for f, ts in TEMPLATES.items() for i, t in enumerate(ts)]
    return (spark.createDataFrame(rows, "family string, template int, _t string")
            .withColumn("t_words", _tokens(F.col("_t"))).withColumn("t_pairs", F.array_distinct(_pairs(F.col("t_words")))).drop("_t"))


def _held(pairs: Column, t_pairs: Column) -> Column:
    return F.size(F.array_intersect(pairs, t_pairs)) / F.size(t_pairs)


def training_rows(documents: DataFrame) -> DataFrame:
    """(family, template, words, pairs, held_out): notices cut from the templates at every
    start and end that leave three quarters, alone (never held out) and with
    corpus prose before or behind, and the sample of prose itself."""
    spark = documents.sparkSession
    known = templates(spark)
    texts = bounded_sample(documents.select("doc_id", "text"), SAMPLE_TEXTS)
    sample = checkpointed(_with_pairs(bounded_sample(paragraphs(texts).select("words"), SAMPLE)))
    every = F.array(*[F.array(*[F.lit(p) for p in r["t_pairs"]]) for r in known.select("t_pairs").collect()])
    prose = sample.filter(~F.exists(every, lambda t: _held(F.col("pairs"), t) >= HELD)).withColumn("n", F.xxhash64("words"))
    n = F.size("t_words")
    cuts = (known.withColumn("_from", F.explode(F.sequence(F.lit(0), F.floor(n / 8).cast("int"))))
            .withColumn("_to", F.explode(F.sequence(F.greatest(F.ceil(n * 0.75).cast("int"), F.col("_from") + 2), n)))
            .select("family", "template", F.slice("t_words", F.col("_from") + 1, F.col("_to") - F.col("_from")).alias("words")).distinct())
    # each cut alone and at the start, middle and end of a few pieces of prose
    some = [r["p"] for r in prose.orderBy("n").limit(24).select(F.slice("words", 1, 20).alias("p")).collect()]
    pieces = F.array(*[F.array(*[F.lit(w) for w in p]) for p in some]).cast("array<array<string>>")
    around = cuts.withColumn("p", F.explode(pieces))
    half = F.ceil(F.size("p") / 2).cast("int")
    mixed = (around.select("family", "template", F.concat("words", F.slice("p", F.lit(1), half)).alias("words"))
             .unionByName(around.select("family", "template", F.concat("p", "words").alias("words"))))
    cuts = cuts.withColumn("alone", F.lit(True))
    notices = _with_pairs(cuts.unionByName(mixed.withColumn("alone", F.lit(False))))
    both = notices.unionByName(prose.select(
        F.lit(PROSE).alias("family"), F.lit(0).alias("template"), "words", "pairs", F.lit(False).alias("alone")))
    return both.withColumn("held_out", ~F.col("alone") & (F.pmod(F.xxhash64("words"), F.lit(4)) == 0)).drop("alone")


class LicenceModel:
    """The fitted pipeline, its classes, temperature and family threshold."""

    def __init__(self, pipeline: PipelineModel, classes: list[str], temperature: float = 1.0, threshold: float = 0.5):
        self.pipeline, self.classes, self.temperature, self.threshold = pipeline, classes, temperature, threshold

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` (words, pairs) with array _p of calibrated probabilities."""
        return self._calibrated(self._scored(rows))

    def bound(self):
        """A condition on the codes of a window: not shown to be prose with 0.5 or
        more. That holds where prose leads every family by T ln(families), and
        the largest lead of any family's coefficient is summed for all of them."""
        lr = self.pipeline.stages[-1]
        weights, intercepts = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
        own = self.classes.index(PROSE)
        rest = np.delete(np.arange(len(self.classes)), own)
        ahead = F.lit((weights[rest] - weights[own]).max(axis=0))
        least = -float((intercepts[rest] - intercepts[own]).max()) - self.temperature * math.log(len(rest)) - 1e-6

        def wanted(codes: Column) -> Column:
            def lead(c: Column) -> Column:
                return F.aggregate(c, F.lit(0.0), lambda a, x: a + F.get(ahead, x)) / F.sqrt(F.size(c).cast("double"))
            return F.get(F.transform(F.array(F.array_distinct(codes)), lead), F.lit(0)) > least

        return wanted

    def notices(self, rows: DataFrame) -> DataFrame:
        """Those of ``rows`` (words, pairs), with _p, that are prose with less than 0.5."""
        return _once(self._calibrated(_once(self._scored(rows)))).filter(self.prose() < 0.5)

    def _scored(self, rows: DataFrame) -> DataFrame:
        return (self.pipeline.transform(_with_features(rows)).withColumn("_r", vector_to_array("_raw"))
                .drop("_f", "_tf", "_x", "_raw"))

    def _calibrated(self, scored: DataFrame) -> DataFrame:
        exp = F.transform("_r", lambda x: F.exp((x - F.array_max("_r")) / self.temperature))
        return (scored.withColumn("_e", exp)
                .withColumn("_p", F.transform("_e", lambda x: x / F.aggregate("_e", F.lit(0.0), lambda a, b: a + b)))
                .drop("_r", "_e"))

    def best(self) -> tuple[Column, Column]:
        """The likeliest family, and its probability."""
        names = F.array(*[F.lit(c) for c in self.classes])
        scored = F.transform(F.col("_p"), lambda p, i: F.struct(p.alias("p"), F.get(names, i).alias("family")))
        top = F.array_max(F.filter(scored, lambda x: x["family"] != PROSE))
        return top["family"], top["p"]

    def prose(self) -> Column:
        return F.get("_p", self.classes.index(PROSE)) if PROSE in self.classes else F.lit(0.0)


def fit(documents: DataFrame) -> LicenceModel:
    rows = checkpointed(training_rows(documents))
    classes = sorted([*TEMPLATES, *([] if rows.filter(F.col("family") == PROSE).isEmpty() else [PROSE])])
    names = F.array(*[F.lit(c) for c in classes])
    rows = rows.withColumn("label", (F.array_position(names, F.col("family")) - 1).cast("double"))
    sizes = rows.groupBy("family", "template").count()
    # prose counts half; the templates, long or short, share the other half
    share = F.when(F.col("family") == PROSE, F.lit(0.5)).otherwise(F.lit(0.5 / sum(map(len, TEMPLATES.values()))))
    weights = sizes.select("family", "template", (share * F.sum("count").over(Window.partitionBy()) / F.col("count")).alias("weight"))
    rows = rows.join(F.broadcast(weights), ["family", "template"])  # a row per template
    train = rows.filter("not held_out").coalesce(8)  # a bounded sample: every pass sends a gradient from each part
    pipeline = Pipeline(stages=[
        CountVectorizerModel.from_vocabulary([str(i) for i in range(2 * FEATURES)], "_f", "_tf", binary=True),
        Normalizer(inputCol="_tf", outputCol="_x"),
        LogisticRegression(featuresCol="_x", labelCol="label", weightCol="weight", family="multinomial", rawPredictionCol="_raw",
                           probabilityCol="", predictionCol="", regParam=1e-5, maxIter=25, standardization=False),
    ]).fit(_with_features(train))
    model = LicenceModel(pipeline, classes)
    held = rows.filter("held_out")
    raw = checkpointed(pipeline.transform(_with_features(held)).select("label", "weight", vector_to_array("_raw").alias("r")))
    at = [0.25 * 2 ** (i / 2) for i in range(9)]
    own = F.get("r", F.col("label").cast("int"))
    loss = [F.sum(F.col("weight") * (F.log(F.aggregate("r", F.lit(0.0), lambda a, x: a + F.exp((x - F.array_max("r")) / t)))
                                     - (own - F.array_max("r")) / t)) for t in at]
    losses = raw.agg(*loss).first()
    model.temperature = min(zip([x if x is not None else 0.0 for x in losses], at))[1]
    prose = model.probabilities(held.filter(F.col("family") == PROSE)).select(model.best()[1].alias("p"))
    reached = prose.agg(F.percentile("p", F.lit(1 - FALSE_RATE))).first()[0]
    model.threshold = min(0.95, max(0.5, reached or 0.0))
    return model


def _span(pairs: Column, t: Column) -> Column:
    """(held, from) of template pairs ``t`` in a window: the share that is held, and its first
    word, the latest from which on as many are held."""
    at = F.transform(F.array_intersect(t, pairs), lambda p: F.array_max(F.transform(pairs, lambda x, i: F.when(x == p, i))))
    return F.struct(_held(pairs, t).alias("held"), F.array_min(at).alias("from"))


def licences(documents: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """One row per window that reads as a licence notice: doc_id, line, at (first
    word), family (or unknown), probability, and held: the largest share of a
    template of the likeliest family that its words hold. A window over line ends
    of a known family has the line of the notice's first word."""
    model = model or fit(documents)
    family, p = model.best()
    rows = _with_pairs(paragraphs(documents, model.bound() if PROSE in model.classes else None))
    found = (model.notices(rows)
             .select("doc_id", "line", "at", "lines", "pairs", family.alias("_family"), p.alias("probability")))
    own = templates(documents.sparkSession).groupBy("family").agg(F.collect_list("t_pairs").alias("_ts")).withColumnRenamed("family", "_family")
    span = F.array_max(F.transform("_ts", lambda t: _span(F.col("pairs"), t)))
    sure = (F.col("probability") >= model.threshold) & (F.col("_span.held") >= HELD)
    return (found.join(F.broadcast(own), "_family").withColumn("_span", span)
            .select("doc_id", F.when(sure, F.get("lines", F.col("_span.from"))).otherwise(F.col("line")).alias("line"), "at",
                    F.when(sure, F.col("_family")).otherwise(F.lit(UNKNOWN)).alias("family"),
                    F.round("probability", 9).alias("probability"), F.round("_span.held", 6).alias("held")))
