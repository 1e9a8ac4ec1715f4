"""License scans: a trained paragraph classifier, an unknown class by calibration, templates to confirm.

DataFrame functions and Spark's own (JVM) logistic regression only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Notices of each family; the classifier's positive examples are made from them.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GPL version 2 or later.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Text is available under the Creative Commons Attribution ShareAlike License CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "proprietary": ("All rights reserved.", "Copyright, all rights reserved by the author.", "No part of this publication may be reproduced without prior written permission."),
}
FAMILIES = ("none", *sorted(TEMPLATES))

#: Made examples per notice; paragraphs of the corpus taken as examples of "none", at most about.
VARIANTS, NEGATIVES = 40, 4000
#: A feature may occur in at most this share of the "none" examples; false alarms allowed on held-out ones.
COMMON, FALSE_ALARMS = 0.005, 0.001
#: Stands for the names of a licence that is none of the families, and the share of such notices that may pass for one.
STRANGER, MISTAKEN = "acme", 0.05
#: Share of a template's words that a paragraph must hold to confirm its family.
LEAST_SIMILARITY = 0.6


@dataclass(frozen=True)
class Model:
    """Everything the scan needs; its size is bounded by the templates, not by the corpus."""

    features: list[str]
    weights: list[list[float]]  # by family, in the order of FAMILIES
    intercepts: list[float]
    least: float  # probability below which a licence text's family is unknown
    clue: str  # pattern that every paragraph with evidence for a licence matches


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+(?:[.-][a-z0-9]+)*)"), 1)


def grams(text: str) -> Column:
    """Words and pairs of neighbouring words of the column ``text`` of words."""
    pairs = F.zip_with(F.slice(text, 1, F.greatest(F.size(text) - 1, F.lit(0))), F.slice(text, 2, F.greatest(F.size(text) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(F.col(text), pairs)


def _examples(docs: DataFrame) -> DataFrame:
    """(label, held, words): variants of the notices with words left out, and paragraphs of the corpus as "none"."""
    spark = docs.sparkSession
    notices = spark.createDataFrame([(FAMILIES.index(f), t) for f in TEMPLATES for t in TEMPLATES[f]], "label int, text string").withColumn("words", words(F.col("text")))
    made = notices.select("label", "words", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"))
    # variant 0 is whole; of the others about one word in eight is missing
    left = F.filter("words", lambda w, i: (F.col("v") == 0) | (F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(8)) > 0))
    good = made.select("label", (F.col("v") % 5 == 4).alias("held"), left.alias("words"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    count = docs.count()
    share = min(1.0, NEGATIVES / 4 / count) if count else 1.0
    some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(share * 1_000_000) + 1)
    plain = some.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "paragraph")).filter(F.pmod(F.xxhash64("doc_id", "i"), F.lit(2)) == 0)
    plain = plain.select("doc_id", "i", words(F.col("paragraph")).alias("words")).filter("size(words) > 0")
    # corpus paragraphs that are themselves close to a notice are no examples of "none"
    close = F.exists(F.array(*[F.array(*map(F.lit, sorted(set(t)))) for (t,) in notices.select("words").collect()]), lambda t: F.size(F.array_intersect(t, F.col("words"))) >= LEAST_SIMILARITY * F.size(t))
    none = plain.filter(~close).select(F.lit(0).alias("label"), (F.pmod(F.xxhash64("doc_id", "i"), F.lit(5)) == 4).alias("held"), "words")
    return good.union(none)


def _strangers(spark: SparkSession) -> DataFrame:
    """(words) of the notices with the words of one family alone exchanged for ``STRANGER``: licence texts of no family.

    Notices that share few words with other families' are left out: without
    their own words little of them remains.
    """
    split = lambda t: re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())
    used = {f: {w for t in TEMPLATES[f] for w in split(t)} for f in TEMPLATES}
    rows = []
    for f in TEMPLATES:
        own = used[f] - set().union(*(used[g] for g in TEMPLATES if g != f))
        for t in TEMPLATES[f]:
            text = split(t)
            shared = [w for w in text if w not in own]
            if 2 * len(shared) >= len(text) > len(shared):
                rows.append(([STRANGER if w in own else w for w in text],))
                rows.append((shared,))
    return spark.createDataFrame(rows, "words array<string>")


def fit(docs: DataFrame) -> Model:
    """Train on variants of the notices and a bounded sample of the corpus' paragraphs.

    Features are the notices' words and word pairs that are rare in the
    sample; L1 keeps the weights sparse. The probability from which a family
    is named is the least one that lets through at most ``FALSE_ALARMS`` of
    the held-out paragraphs and ``MISTAKEN`` of the notices of a licence of
    another name, and no less than half.
    """
    examples = _examples(docs).withColumn("grams", grams("words")).cache()
    plain = examples.filter("label = 0")
    counts = examples.select("label", F.explode(F.array_distinct("grams")).alias("g")).groupBy("g").agg(F.sum((F.col("label") == 0).cast("long")).alias("plain"), F.max("label").alias("label"))
    total = plain.count()
    features = sorted(r.g for r in counts.filter((F.col("label") > 0) & (F.col("plain") <= COMMON * total)).collect())
    vectors = CountVectorizerModel.from_vocabulary(features, inputCol="grams", outputCol="x", minTF=0)
    vectors.setBinary(True)
    shown = vectors.transform(examples).withColumn("weight", F.when(F.col("label") == 0, 1.0).otherwise(2.0))
    regression = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", family="multinomial", regParam=2e-4, elasticNetParam=0.5, maxIter=80, standardization=False)
    trained = regression.fit(shown.filter("NOT held"))
    weights, intercepts = trained.coefficientMatrix.toArray().tolist(), list(trained.interceptVector)
    p = vector_to_array("probability")
    held = trained.transform(shown.filter("held AND label = 0")).select(F.array_max(F.slice(p, 2, len(FAMILIES) - 1)).alias("p"))
    alarm = held.agg(F.percentile("p", 1 - FALSE_ALARMS)).first()[0]
    others = trained.transform(vectors.transform(_strangers(docs.sparkSession).withColumn("grams", grams("words"))))
    mistaken = others.filter(F.element_at(p, 1) < 0.5).agg(F.percentile(F.array_max(F.slice(p, 2, len(FAMILIES) - 1)), 1 - MISTAKEN)).first()[0]
    examples.unpersist()
    # a paragraph without a feature that speaks for some family against "none" is "none"
    useful = [g for k, g in enumerate(features) if any(row[k] > weights[0][k] + 1e-9 for row in weights[1:])]
    single = {g for g in useful if " " not in g}
    pairs = [g for g in useful if " " in g and not single & set(g.split())]
    clue = "|".join([rf"(?:{'|'.join(x.replace('.', '[.]') for x in sorted(single))})"] * bool(single) + [g.replace(".", "[.]").replace(" ", "[^a-z0-9]+") for g in pairs])
    return Model(features, weights, intercepts, max(0.5, alarm or 0.0, mistaken or 0.0), rf"(?<![a-z0-9])(?:{clue})(?![a-z0-9])")


def _text_key() -> list[Column]:
    """Equal texts, equal keys: what a text holds is found once for all rows that repeat it."""
    return [F.xxhash64("text").alias("text_hash"), F.length("text").alias("text_length")]


def paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """(text_hash, text_length, paragraph, family, p, similarity): every paragraph that the classifier takes for a licence text.

    One row for each such paragraph of each distinct text. ``family`` is
    ``unknown`` where no family reaches the calibrated probability or no
    template of it confirms; ``similarity`` is the largest share of a
    template's words that the paragraph holds. Paragraphs are lines, counted
    from 0.
    """
    spark: SparkSession = docs.sparkSession
    lines = docs.select(F.col("text").cast("string").alias("text")).filter(F.lower("text").rlike(model.clue))
    lines = lines.select(*_text_key(), F.posexplode(F.split("text", "\n")).alias("paragraph", "line")).filter(F.lower("line").rlike(model.clue))
    # rows that repeat a text have the same lines
    lines = lines.groupBy("text_hash", "text_length", "paragraph").agg(F.first("line").alias("line"))
    lines = lines.withColumn("words", words(F.col("line")))
    lines = lines.withColumn("found", F.array_intersect(grams("words"), F.array(*map(F.lit, model.features)))).filter("size(found) > 0")
    table = [(g, [row[k] for row in model.weights]) for k, g in enumerate(model.features)]
    weights = spark.createDataFrame(table, "gram string, w array<double>")  # bounded by the templates
    hits = lines.select("text_hash", "text_length", "paragraph", "words", F.explode("found").alias("gram")).join(F.broadcast(weights), "gram")
    scored = hits.groupBy("text_hash", "text_length", "paragraph").agg(F.first("words").alias("words"), *[F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(FAMILIES))])
    z = F.array(*[F.col(f"z{k}") + b for k, b in enumerate(model.intercepts)])
    scored = scored.select("text_hash", "text_length", "paragraph", "words", z.alias("z")).withColumn("top", F.array_max("z"))
    scored = scored.withColumn("p", F.transform("z", lambda x: F.exp(x - F.col("top")))).withColumn("total", F.aggregate("p", F.lit(0.0), lambda a, x: a + x))
    best = F.array_max(F.slice("p", 2, len(FAMILIES) - 1))
    scored = scored.filter(F.element_at("p", 1) < 0.5 * F.col("total")).withColumns({"best": best, "k": F.array_position("p", best)})
    rows = [(f, t) for f in TEMPLATES for t in TEMPLATES[f]]
    known = spark.createDataFrame(rows, "guess string, template string").select("guess", F.array_distinct(words(F.col("template"))).alias("t")).groupBy("guess").agg(F.collect_list("t").alias("templates"))
    scored = scored.withColumn("guess", F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("k").cast("int"))).join(F.broadcast(known), "guess")
    similar = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("words"))) / F.size(t)))
    scored = scored.withColumns({"p": F.col("best") / F.col("total"), "similarity": similar})
    sure = (F.col("p") >= model.least) & (F.col("similarity") >= LEAST_SIMILARITY)
    return scored.select("text_hash", "text_length", F.col("paragraph").cast("long").alias("paragraph"), F.when(sure, F.col("guess")).otherwise("unknown").alias("family"), "p", "similarity")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, families), one row per row of ``docs``: its licence texts and their families.

    ``families`` lists the distinct families by name, comma-joined, and is
    empty where the document has no licence text; ``unknown`` stands for
    licence texts of no known family. Null and empty texts have none. Every
    row shows what its own text holds, whether or not it repeats a doc_id or
    has none. An empty table gives no rows. Other columns are ignored.
    """
    model = model or fit(docs)
    found = paragraphs(docs, model).groupBy("text_hash", "text_length").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", *_text_key())
    out = out.join(found, ["text_hash", "text_length"], "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families"))
