"""Licence scan: a trained paragraph classifier, confirmed against templates.

A paragraph is a line of a text, or a run of neighbouring lines over which a notice is wrapped. Only
a paragraph with a cue, a phrase of the licence vocabulary, can declare a licence; for a run the cue
may stand anywhere in its block, the lines between two lines without letters and digits. Runs are
found per template: from each line with a word pair of it, the shortest run that holds as many of its
pairs as any run up to twice as many lines as it has words, if that share is ``confirm`` or more.
A paragraph's features are its word n-grams of one to three words. Multinomial logistic regression over the hashed n-grams gives a probability for every
licence family and for the class "unknown". It is trained on the templates, cut at both ends in
many ways, against paragraphs of the corpus that have cues but little of any template, and against
sentences that only talk about licences.

The unknown class is calibrated: a paragraph counts as a family only if the family's probability
is above the level that at most ``leak`` of the unknown paragraphs set aside reach. Then the
prediction is confirmed by comparison: the share of the word pairs of the family's closest template
that the paragraph holds must be ``confirm`` or more. A confirmed run is one paragraph and its lines
are none, unless one of them declares a licence alone, which goes before; of confirmed runs that share
lines the closest stays.

Native: DataFrame functions and Spark's own regression only.

Edge cases: null and empty texts have no paragraphs; rows that share an id each get
the sums over all of them; an
empty table gives an empty result; other columns are left behind; very long lines are one
paragraph each and are compared whole.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.frames import texts
from tillmark.session import cut_lineage

UNKNOWN = "unknown"
BUCKETS = 1 << 14

# Notices by which licences are declared, one family per name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License v3.0."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Released under the BSD License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced without the prior permission of the publisher."),
]

# Sentences that use the vocabulary without declaring a licence.
MENTIONS = [
    "The driver's license was renewed last year.",
    "She works under license in the public sector.",
    "They released the software without a warranty.",
    "He lost his license and his copyright claim.",
    "Permission to enter was granted by the foundation.",
    "The general public was free to copy the source.",
    "Version 3 of the software was released today.",
    "The public domain is a common topic.",
    "Creative work is common in this domain.",
    "Rights and conditions are listed in the license file.",
    "The law on copyright changed in 2019.",
    "An international license fee applies to commercial use.",
    "Which license should a new project choose?",
]

# The phrases whose presence makes a paragraph worth scoring.
CUES = [
    "licen[sc]e[sd]?",
    "sublicen[sc]e",
    "unlicense",
    "copyright",
    "rights reserved",
    "permission is",
    "permission to",
    "redistribut(?:e|ion)",
    "warrant(?:y|ies)",
    "apache",
    "gnu",
    "l?gpl",
    "bsd",
    "mozilla",
    "cc by",
    "cc0",
    "creative commons",
    "public domain",
]
_CUE_PATTERN = r"(?i)\b(?:" + "|".join(CUES) + r")\b"
# The same where a phrase may go on in the next line, behind the marks of a comment.
_WRAPPED_CUE = _CUE_PATTERN.replace(" ", "[^a-z0-9]+")


def _words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[a-z0-9][a-z0-9.+]*[a-z0-9]|[a-z0-9]"), 0)


def _grams(words: Column, sizes: tuple[int, ...]) -> Column:
    """The word runs of these sizes."""

    def runs(n: int) -> Column:
        # The lambda takes one parameter: a second one, even with a default, would be the position.
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))),
            lambda i: F.array_join(F.slice(words, i, n), " "),
        )

    return F.concat(*map(runs, sizes))


def _features(words: Column) -> Column:
    return _grams(words, (1, 2, 3))


def _pairs(words: Column) -> Column:
    return F.array_distinct(_grams(words, (2,)))


def _template_pairs(spark: SparkSession) -> DataFrame:
    frame = spark.createDataFrame(TEMPLATES, "family string, template string")
    return frame.withColumn("words", _words(F.col("template")))


def _once(value: Column, use) -> Column:
    """use(value), with the value computed only once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(lines: Column) -> Column:
    """(start, lines) of the runs of lines with letters or digits."""

    def ends(filled: Column, step: int) -> Column:
        """Filled lines whose neighbour on that side is not."""
        return F.filter(
            F.transform(
                filled,
                lambda own, i: F.when(own & ~F.coalesce(F.get(filled, i + step), F.lit(False)), i),
            ),
            lambda i: i.isNotNull(),
        )

    def sliced(own: Column) -> Column:
        filled = F.transform(own, lambda p: p.rlike(r"[\p{L}\p{N}]"))
        return F.zip_with(
            _once(filled, lambda f: ends(f, -1)),
            _once(filled, lambda f: ends(f, 1)),
            lambda a, b: F.struct(a.alias("start"), F.slice(own, a + 1, b - a + 1).alias("lines")),
        )

    return _once(lines, sliced)


def _wrapped(words: Column, families, confirm: float) -> Column:
    """(first, size) of the runs of two and more lines that may be a wrapped template; ``words`` are
    those of each line of a block."""
    known = sorted({p for _, templates in families for own in templates for p in own})
    templates = F.array(
        *[F.array(*map(F.lit, own)) for _, templates in families for own in templates]
    )

    def line_pairs(lines: Column, own: Column) -> Column:
        return F.transform(lines, lambda w: F.array_intersect(_pairs(w), own))

    def of_template(own: Column, lines: Column) -> Column:
        inside = line_pairs(lines, own)
        none = F.array().cast("array<string>")
        following = F.transform(
            lines, lambda w, i: F.concat(w, F.slice(F.coalesce(F.get(lines, i + 1), none), 1, 1))
        )
        onward = line_pairs(following, own)

        def runs(inside: Column, onward: Column) -> Column:
            def best(i: Column) -> Column:
                most = F.least(2 * F.size(own) + 2, F.size(lines) - i)
                return F.array_max(
                    F.transform(
                        F.sequence(F.lit(1), most),
                        lambda k: F.struct(
                            F.size(
                                F.array_distinct(
                                    F.concat(
                                        F.flatten(F.slice(onward, i + 1, k - 1)),
                                        F.element_at(inside, i + k),
                                    )
                                )
                            ).alias("held"),
                            (-k).alias("fewer"),
                            i.alias("first"),
                        ),
                    )
                )

            starts = F.filter(
                F.transform(onward, lambda p, i: F.when(F.size(p) > 0, i)), lambda i: i.isNotNull()
            )
            return F.filter(
                F.transform(starts, best),
                lambda r: (r["fewer"] < -1) & (r["held"] >= confirm * F.size(own)),
            )

        return _once(inside, lambda x: _once(onward, lambda y: runs(x, y)))

    def of_block(lines: Column) -> Column:
        def near(pairs: Column) -> Column:
            likely = F.filter(
                templates,
                lambda own: F.size(F.array_intersect(own, pairs)) >= confirm * F.size(own),
            )
            return F.flatten(F.transform(likely, lambda own: of_template(own, lines)))

        held = F.array_intersect(_once(F.flatten(lines), _pairs), F.array(*map(F.lit, known)))
        return F.array_distinct(
            F.transform(
                _once(held, near),
                lambda r: F.struct(r["first"].alias("first"), (-r["fewer"]).alias("size")),
            )
        )

    return _once(words, of_block)


def paragraphs(docs: DataFrame, confirm: float = 0.6) -> DataFrame:
    """doc_id, text_id, number of the first and last line, paragraph, wrapped: the lines that hold a
    cue, and the runs of lines that may be a wrapped notice. ``wrapped``: a line within such a run.

    ``text_id`` tells rows with the same id apart.
    """
    families = _families(docs.sparkSession)
    blocks = F.explode(_blocks(F.transform(F.split("text", "\n"), F.trim)))
    # Most texts have no cue at all: they are left before their lines are.
    rows = (
        docs.filter(F.col("text").rlike(_WRAPPED_CUE))
        .select("doc_id", "text", F.monotonically_increasing_id().alias("text_id"))
        .select("doc_id", "text_id", blocks.alias("b"))
        .select("doc_id", "text_id", "b.start", "b.lines")
        .filter(F.array_join("lines", " ").rlike(_WRAPPED_CUE))
    )
    none = F.array().cast("array<struct<first:int,size:int>>")
    runs = F.when(
        F.size("lines") > 1, _wrapped(F.transform("lines", _words), families, confirm)
    ).otherwise(none)

    def units(runs: Column) -> Column:
        alone = F.filter(
            F.transform(
                "lines",
                lambda p, i: F.struct(
                    i.alias("first"),
                    F.lit(1).alias("size"),
                    p.alias("paragraph"),
                    F.exists(runs, lambda r: (r["first"] <= i) & (i < r["first"] + r["size"])).alias(
                        "wrapped"
                    ),
                ),
            ),
            lambda p: p["paragraph"].rlike(_CUE_PATTERN),
        )
        joined = F.transform(
            runs,
            lambda r: F.struct(
                r["first"].alias("first"),
                r["size"].alias("size"),
                F.array_join(F.slice("lines", r["first"] + 1, r["size"]), "\n").alias("paragraph"),
                F.lit(False).alias("wrapped"),
            ),
        )
        return F.concat(alone, joined)

    number = F.col("start") + F.col("p.first")
    return rows.select("doc_id", "text_id", "start", F.explode(_once(runs, units)).alias("p")).select(
        "doc_id",
        "text_id",
        number.alias("number"),
        (number + F.col("p.size") - 1).alias("last"),
        "p.paragraph",
        "p.wrapped",
    )


def _closeness(pairs: Column, templates: list[list[str]]) -> Column:
    """The largest share of a template's word pairs that a paragraph holds."""
    shares = [
        F.size(F.array_intersect(pairs, F.array(*map(F.lit, own)))) / float(len(own))
        for own in templates
    ]
    return F.greatest(*shares, F.lit(0.0))


def _families(spark: SparkSession) -> list[tuple[str, list[list[str]]]]:
    rows = _template_pairs(spark).select("family", _pairs(F.col("words")).alias("pairs")).collect()
    found: dict[str, list[list[str]]] = {}
    for family, pairs in rows:
        found.setdefault(family, []).append(pairs)
    return sorted(found.items())


def _examples(spark: SparkSession) -> DataFrame:
    """Templates cut at both ends, down to three quarters of their words, and the mentions."""
    cut = (
        _template_pairs(spark)
        .withColumn("spare", F.floor(F.size("words") / 4).cast("int"))
        .withColumn("front", F.explode(F.sequence(F.lit(0), F.least("spare", F.lit(6)))))
        .withColumn("rear", F.explode(F.sequence(F.lit(0), F.least("spare", F.lit(6)))))
        .filter("front + rear <= spare")
        .select("family", F.expr("slice(words, front + 1, size(words) - front - rear)").alias("words"))
    )
    mentions = spark.createDataFrame([(m,) for m in MENTIONS], "paragraph string").select(
        F.lit(UNKNOWN).alias("family"), _words(F.col("paragraph")).alias("words")
    )
    return cut.unionByName(mentions)


def learn(docs: DataFrame, leak: float = 0.01):
    """(fitted features and regression, names of the classes, least probability of a family).

    Every distinct line of the corpus with a cue stands for the unknown class, but no line of a run
    that holds half of a template; every fourth of them is set aside for the calibration.
    """
    spark = docs.sparkSession
    families = _families(spark)
    names = [family for family, _ in families] + [UNKNOWN]
    drawn = (
        paragraphs(texts(docs), 0.5)
        .filter((F.col("number") == F.col("last")) & ~F.col("wrapped"))
        .select("paragraph")
        .distinct()
        .select(F.lit(UNKNOWN).alias("family"), _words(F.col("paragraph")).alias("words"))
        .withColumn("pairs", _pairs(F.col("words")))
    )
    near = F.lit(False)
    for _, templates in families:
        near = near | (_closeness(F.col("pairs"), templates) >= 0.5)
    unknown = cut_lineage(drawn.filter(~near).drop("pairs"))
    aside = F.pmod(F.xxhash64("words", F.lit(1)), F.lit(4)) == 0
    label = F.array_position(F.array(*map(F.lit, names)), F.col("family")).cast("double") - 1
    rows = _examples(spark).unionByName(unknown.filter(~aside))
    train = rows.select(label.alias("label"), _features(F.col("words")).alias("grams"))
    weights = train.groupBy("label").agg((1.0 / F.count("*")).alias("weight"))
    train = _packed(cut_lineage(train.join(F.broadcast(weights), "label")))
    model = Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True),
            LogisticRegression(
                regParam=1e-4, maxIter=60, family="multinomial", weightCol="weight", tol=1e-5
            ),
        ]
    ).fit(train)
    held = cut_lineage(_scored(unknown.filter(aside), model, names).select("chance"))
    return model, names, max(0.5, min(0.99, _percentile(held, 1 - leak)))


def _packed(train: DataFrame, rows_at_once: int = 20_000) -> DataFrame:
    """The rows in as few tasks as hold them: in each step of the fit every task, even one without
    rows, sends a gradient of the model's size."""
    return train.coalesce(max(1, -(-train.count() // rows_at_once)))


def _percentile(held: DataFrame, share: float) -> float:
    """The exact percentile of the chances, between neighbours in proportion; 0 without any.

    Every step counts the chances in cells of equal width between the least and the greatest, and
    the next one looks into the cell that holds the place; the driver sees one line per cell.
    """
    chance, cells = F.col("chance"), 10_000
    spread = (F.count("chance").alias("rows"), F.min("chance").alias("low"), F.max("chance").alias("high"))
    whole = held.agg(*spread).first()
    if whole["rows"] == 0:
        return 0.0
    place = (whole["rows"] - 1) * share

    def value(position: int) -> float:
        inside, rows = whole, held
        while inside["high"] - inside["low"] > 1e-290:
            width = (inside["high"] - inside["low"]) / cells
            cell = F.floor((chance - inside["low"]) / width)
            for found in rows.groupBy(cell.alias("cell")).agg(*spread).orderBy("low").collect():
                if found["cell"] is not None and position < found["rows"]:
                    break
                position -= found["rows"]
            inside, rows = found, rows.filter(cell == found["cell"])
        return inside["low"]

    below = int(place)
    low = value(below)
    return low if place == below else low + (place - below) * (value(below + 1) - low)


def _scored(frame: DataFrame, model: PipelineModel, names: list[str]) -> DataFrame:
    """Adds the likeliest family and its chance; ``frame`` has words."""
    chances = F.slice(vector_to_array("probability"), 1, len(names) - 1)
    out = model.transform(frame.withColumn("grams", _features(F.col("words"))))
    return (
        out.withColumn("chances", chances)
        .withColumn("chance", F.array_max("chances"))
        .withColumn(
            "predicted",
            F.element_at(
                F.array(*map(F.lit, names)), F.array_position("chances", F.col("chance")).cast("int")
            ),
        )
        .drop("grams", "features", "rawPrediction", "probability", "prediction", "chances")
    )


def _chosen(runs: Column) -> Column:
    """Of declaring lines and runs, the lines, and the closest runs that share no line with others."""
    ordered = F.sort_array(
        F.transform(
            runs,
            lambda r: F.struct(
                (r["last"] > r["number"]).alias("wrapped"),
                (-r["closeness"]).alias("far"),
                (r["last"] - r["number"]).alias("more"),
                (-r["chance"]).alias("doubt"),
                r["number"].alias("number"),
                r["last"].alias("last"),
            ),
        )
    )
    kept = F.aggregate(
        F.transform(ordered, lambda r: F.struct(r["number"].alias("number"), r["last"].alias("last"))),
        F.array().cast("array<struct<number:int,last:int>>"),
        lambda kept, r: F.when(
            F.exists(kept, lambda k: (k["number"] <= r["last"]) & (r["number"] <= k["last"])), kept
        ).otherwise(F.concat(kept, F.array(r))),
    )
    return F.filter(kept, lambda k: k["last"] > k["number"])


def scan(docs: DataFrame, fitted, confirm: float = 0.6) -> DataFrame:
    """One row per paragraph with a cue: doc_id, number (of its first line), last, paragraph, family
    (or unknown), chance, closeness."""
    model, names, level = fitted
    families = _families(docs.sparkSession)
    rows = paragraphs(texts(docs), confirm).withColumn("words", _words(F.col("paragraph")))
    closeness = F.lit(0.0)
    for family, templates in families:
        own = _closeness(F.col("pairs"), templates)
        closeness = F.when(F.col("predicted") == family, own).otherwise(closeness)
    scored = _scored(rows.withColumn("pairs", _pairs(F.col("words"))), model, names).withColumn(
        "closeness", closeness
    )
    sure = (F.col("chance") > level) & (F.col("closeness") >= confirm)
    # Written once, as the text ids hold for one reading only.
    judged = cut_lineage(
        scored.select(
            "doc_id",
            "text_id",
            "number",
            "last",
            "paragraph",
            F.when(sure, F.col("predicted")).otherwise(UNKNOWN).alias("family"),
            "chance",
            "closeness",
        )
    )
    declared = judged.filter(F.col("family") != UNKNOWN)
    wrapped = declared.filter("last > number").select("text_id").distinct()
    chosen = (
        declared.join(wrapped, "text_id", "left_semi")
        .groupBy("text_id")
        .agg(_chosen(F.collect_list(F.struct("number", "last", "closeness", "chance"))).alias("runs"))
    )
    apart = F.forall(
        F.coalesce("runs", F.array().cast("array<struct<number:int,last:int>>")),
        lambda r: (F.col("last") < r["number"]) | (r["last"] < F.col("number")),
    )
    stays = F.array_contains("runs", F.struct("number", "last")) & (F.col("family") != UNKNOWN)
    return (
        judged.join(chosen, "text_id", "left")
        .filter(F.when(F.col("last") > F.col("number"), stays).otherwise(apart))
        .select("doc_id", "number", "last", "paragraph", "family", "chance", "closeness")
    )


def per_document(docs: DataFrame, fitted, confirm: float = 0.6) -> DataFrame:
    """Per row: doc_id, n_paragraphs, n_cued, n_licensed and families (sorted, comma-joined).

    n_paragraphs counts the lines that are not blank; in n_cued and n_licensed a wrapped notice
    counts as one. Cued paragraphs are few, so their sums are joined to the ids, not the texts.
    """
    own = texts(docs)
    found = (
        scan(docs, fitted, confirm)
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("cued"),
            F.count_if(F.col("family") != UNKNOWN).alias("licensed"),
            F.array_join(
                F.sort_array(
                    F.collect_set(F.when(F.col("family") != UNKNOWN, F.col("family")))
                ),
                ",",
            ).alias("named"),
        )
        .withColumnRenamed("doc_id", "_id")
    )
    filled = F.filter(F.split("text", "\n"), lambda p: F.trim(p) != "")
    counted = own.select("doc_id", F.size(filled).cast("long").alias("n_paragraphs"))
    return counted.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("cued", F.lit(0).cast("long")).alias("n_cued"),
        F.coalesce("licensed", F.lit(0).cast("long")).alias("n_licensed"),
        F.coalesce("named", F.lit("")).alias("families"),
    )
