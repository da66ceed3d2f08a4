"""Licence statements in documents: a trained paragraph classifier, confirmed by templates.

Column functions and Spark's own model classes only. A document is cut into paragraphs (runs of lines
that hold a word), the wrapped lines of each make one list of words, and overlapping windows
slide over it. Every window is classified by sparse multinomial logistic regression on word 1- to
3-grams into licence families, "unknown" (a statement of another licence) and "none".

Most windows are told to be "none" without building their n-grams: ``gate_words`` derives from the
model's weights a set of words without any of which no family can outweigh "none", whatever else
is in the window. This is a bound on the score, not a rule of its own, so no window is lost.

The training rows are made from the templates (words left out, running text
around them) and from windows of the documents with and without stray cue words:
a sample bounded by ``SAMPLE`` documents. The least probability for naming a
family is calibrated on held-back rows. A named family is confirmed when a
template's word pairs are found in the window, and is "unknown" otherwise.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.frames import stage, unit_hash

# Notices by licence family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under GPLv3.",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under GPLv2.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Released under the BSD License.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Available under MPL 2.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
        "this work to the public domain worldwide under CC0.",
        "Released under CC0 1.0 Universal.",
        "Dedicated to the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without written permission.",
        "Alle Rechte vorbehalten.",
        "Todos los derechos reservados.",
        "Tous droits réservés.",
    ),
}
# Statements of other licences, the training rows of "unknown".
OTHERS = (
    "Licensed under the Eclipse Public License, version 2.0.",
    "Licensed under the zlib License.",
    "Licensed under the European Union Public Licence.",
    "Released under the Artistic License.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Released under the Open Data Commons License.",
    "You may use this material for teaching only, with permission of the publisher.",
    "This dataset is licensed for research use only.",
    "Licensed under the terms of the community license agreement.",
    "Use, copying and distribution of this text require a commercial license.",
    "Released under the SIL Open Font License, Version 1.1.",
    "This content is made available under a custom license.",
)
# Words that the sampled windows of "none" must not hold, or hold one of, out of place.
CUES = tuple(
    "license licence licensed licenced licenses licences licensing copyright copyrighted permission permitted "
    "warranty redistribution redistribute reserved spdx gpl lgpl agpl apache mit bsd mozilla creative commons "
    "cc cc0 unlicense gnu".split()
)
NONE, UNKNOWN = "none", "unknown"
WINDOW, STRIDE = 48, 24
SAMPLE = 1_200
VARIANTS = 40
CONFIRMED = 0.6
WORD = r"[\p{L}\p{N}]+(?:\.\p{N}+)*"
# Rounding of a score is far below this.
MARGIN = 1e-6


def words_of(text: Column) -> Column:
    """Lower-case words; version numbers stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _grams(words: Column) -> Column:
    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
            F.array().cast("array<string>")
        )

    return F.concat(words, runs(2), runs(3))


def _pairs(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, 2), " ")))


def _notices(spark: SparkSession) -> DataFrame:
    pairs = [(f, t) for f, texts in TEMPLATES.items() for t in texts] + [(UNKNOWN, t) for t in OTHERS]
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(i).alias("number"), F.lit(t).alias("notice")) for i, (f, t) in enumerate(pairs)])
    listed = spark.range(1).select(F.explode(rows).alias("n")).select("n.*")
    return listed.withColumn("words", words_of(F.col("notice")))


def _backgrounds(docs: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """One window of words of each of about ``sample`` documents, numbered from 0, without cue words."""
    share = min(1.0, sample / max(1, docs.count()))
    drawn = docs.where(F.col(text_col).isNotNull() & (unit_hash(F.lit("license"), F.col(id_col)) < share))
    words = drawn.select(F.xxhash64(F.col(id_col)).alias("h"), words_of(F.col(text_col)).alias("all")).where("size(all) > 0")
    begin = (F.pmod("h", F.size("all")) + 1).cast("int")
    cut = words.select("h", F.slice("all", begin, WINDOW).alias("around")).where(~F.arrays_overlap("around", F.array(*map(F.lit, CUES))))
    return stage(cut.withColumn("place", F.row_number().over(Window.orderBy("h", "around")) - 1).drop("h"))


def _training(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """(family, words, held): variants of the notices, and windows of the documents."""
    around = _backgrounds(docs, id_col, text_col, sample)
    count = max(1, around.count())
    luck = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(1_000_003))
    variants = _notices(spark).select("family", "number", "words", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"))
    variants = variants.withColumn(
        "words",
        F.filter("words", lambda w, i: (F.col("v") < 2) | (luck(F.col("v"), F.col("number"), i) % 100 >= 10)),
    ).withColumn("place", (luck(F.lit("around"), "v", "number") % count).cast("int"))
    before, after = (luck(F.lit("before"), "v", "number") % 20).cast("int"), (luck(F.lit("after"), "v", "number") % 20).cast("int")
    dressed = variants.join(around, "place", "left").withColumn("around", F.coalesce("around", F.array().cast("array<string>")))
    inside = F.when(F.col("v") % 2 == 0, F.col("words")).otherwise(
        F.concat(F.slice("around", 1, before), F.col("words"), F.slice("around", 21, after))
    )
    positive = dressed.select("family", inside.alias("words"), (luck(F.lit("held"), "v", "number") % 4 == 0).alias("held"))
    cue = F.element_at(F.array(*map(F.lit, CUES)), (luck(F.lit("cue"), "place", "k") % len(CUES) + 1).cast("int"))
    stray = around.select("place", "around", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    mixed = F.when(F.col("k") == 0, F.col("around")).otherwise(F.concat(F.slice("around", 1, 12), F.array(cue), F.slice("around", 13, 20)))
    negative = stray.select(F.lit(NONE).alias("family"), mixed.alias("words"), (luck(F.lit("held"), "place") % 4 == 0).alias("held"))
    return stage(positive.unionByName(negative).where("size(words) > 0").withColumn("grams", _grams(F.col("words"))))


class LicenseModel:
    """Vocabulary, classifier, families by class number, and the least probability for a name."""

    def __init__(
        self, vectors: CountVectorizerModel, classifier: LogisticRegressionModel, families: list[str], least: float, usual: dict[str, int]
    ) -> None:
        self.vectors, self.classifier, self.families, self.least = vectors, classifier, families, least
        # In how many training windows of "none" a word is; only the choice of gate words depends on it.
        self.usual = usual

    def gate_words(self) -> list[str] | None:
        """Words without any of which a window is "none"; None if the weights give no such set.

        A family can outweigh "none" only if its lead over it is positive: the lead of the intercepts, plus that of
        the window's n-grams. A word is left out of the set while, for every family, the intercepts and all
        positive leads of n-grams made of left-out words alone still add up to no lead.
        """
        weights = self.classifier.coefficientMatrix.toArray()
        bias = self.classifier.interceptVector.toArray()
        none = self.families.index(NONE)
        lead = np.maximum(weights - weights[none], 0.0)
        total, others = bias - bias[none], np.arange(len(bias)) != none
        if (total[others] >= 0).any():
            return None
        grams = [g.split(" ") for g in self.vectors.vocabulary]
        of_word: dict[str, list[int]] = {}
        for i, words in enumerate(grams):
            if lead[:, i].any():
                for word in set(words):
                    of_word.setdefault(word, []).append(i)
        # The words of most windows are left out first, so that few windows hold a gate word.
        missing = {i: len(set(grams[i])) for own in of_word.values() for i in own}
        gate = []
        for word in sorted(of_word, key=lambda w: (-self.usual.get(w, 0), w)):
            closed = [i for i in of_word[word] if missing[i] == 1]
            more = total + lead[:, closed].sum(axis=1)
            if (more[others] < -MARGIN).all():
                total = more
                for i in of_word[word]:
                    missing[i] -= 1
            else:
                gate.append(word)
        return gate

    def classify(self, df: DataFrame) -> DataFrame:
        """Add ``best`` (a family, unknown or none) and ``probability`` to rows with ``grams``."""
        scored = self.classifier.transform(self.vectors.transform(df))
        p = vector_to_array("probability")
        names = F.array(*map(F.lit, self.families))
        return scored.withColumn("_p", p).select(
            *df.columns,
            F.element_at(names, (F.array_position("_p", F.array_max("_p"))).cast("int")).alias("best"),
            F.array_max("_p").alias("probability"),
        )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> LicenseModel:
    """Fit the classifier and calibrate the unknown class; runs on a bounded number of rows."""
    rows = _training(docs.sparkSession, docs, id_col, text_col, sample)
    families = sorted(r[0] for r in rows.select("family").distinct().collect())  # a fixed list
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    rows = rows.withColumn("label", number.cast("double"))
    # The features are the notices' own n-grams: the running text around them is no evidence of a licence.
    notices = _notices(docs.sparkSession).select(_grams(F.col("words")).alias("grams"))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=1 << 13).fit(notices)
    learner = LogisticRegression(family="multinomial", elasticNetParam=0.5, regParam=0.0005, maxIter=40)
    classifier = learner.fit(vectors.transform(rows.where("NOT held")).select("features", "label"))
    usual = (
        rows.where(F.col("family") == NONE)
        .select(F.explode(F.array_distinct("words")).alias("word"))
        .where(F.col("word").isin(vectors.vocabulary))
        .groupBy("word")
        .count()
        .collect()  # words of the vocabulary
    )
    model = LicenseModel(vectors, classifier, families, 0.0, {r["word"]: r["count"] for r in usual})
    held = model.classify(rows.where("held")).where(~F.col("best").isin(NONE, UNKNOWN))
    bins = held.groupBy(F.floor(F.col("probability") * 50).alias("bin")).agg(
        F.sum((F.col("family") == F.col("best")).cast("int")).alias("right"),
        F.sum((F.col("family") != F.col("best")).cast("int")).alias("wrong"),
    )
    counts = {r["bin"]: (r["right"], r["wrong"]) for r in bins.collect()}
    # The cut that gives most right names less wrong ones; of equal cuts the highest.
    gain, best, least = 0, -1, 0.5
    for b in sorted(counts, reverse=True):
        gain += counts[b][0] - 2 * counts[b][1]
        if gain > best:
            best, least = gain, b / 50
    model.least = least
    return model


def _paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, words, lines): the words of runs of lines that hold a word, and for each word the number of its line."""
    by_line = F.transform(F.split(F.col(text_col), "\n"), words_of)
    lines = docs.select(F.col(id_col), by_line.alias("_by_line"))
    number = F.sequence(F.lit(0), F.size("_by_line") - 1)
    full = lambda i: F.coalesce(F.size(F.get("_by_line", i)) > 0, F.lit(False))
    begins = F.filter(number, lambda i: full(i) & ~full(i - 1))
    ends = F.filter(number, lambda i: full(i) & ~full(i + 1))
    run = lambda r: F.struct(
        r["begin"].alias("line"), F.slice("_by_line", r["begin"] + 1, r["end"] - r["begin"] + 1).alias("by_line")
    )
    runs = lines.select(id_col, F.explode(F.transform(F.arrays_zip(begins.alias("begin"), ends.alias("end")), run)).alias("run"))
    numbers = F.flatten(F.transform("run.by_line", lambda w, i: F.array_repeat(F.col("run.line") + i, F.size(w))))
    return runs.select(id_col, F.flatten("run.by_line").alias("words"), numbers.alias("lines"))


def scan(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text", gated: bool = True) -> DataFrame:
    """One row per window that states a licence: id, line, window, license, predicted, probability, similarity, confirmed, passage.

    ``line`` counts from 0 and is that of the window's first word; ``window`` is the number of that word in
    its paragraph. ``license`` is the confirmed family, or that of a whole notice at the window's edge, or "unknown". Defined cases: NULL and empty texts give no rows;
    paragraphs of any length are scanned whole; repeated rows give repeated results; further
    columns are ignored; an empty table gives an empty result. ``gated=False`` gives the same rows, slower.
    """
    gate = model.gate_words() if gated else None
    some = F.array(*map(F.lit, gate)).cast("array<string>") if gate is not None else None
    holds = lambda words: F.arrays_overlap(words, some) if gate is not None else F.lit(True)
    parts = _paragraphs(docs, id_col, text_col).where(holds(F.col("words")))
    last = F.greatest(F.size("words") - (WINDOW - STRIDE), F.lit(1))
    # Cut before the rows are multiplied, so that no window carries its whole paragraph along.
    cut = F.transform(
        F.sequence(F.lit(0), last - 1, F.lit(STRIDE)),
        lambda i: F.struct(
            F.get("lines", i).alias("line"),
            i.alias("window"),
            F.slice("words", i + 1, WINDOW).alias("words"),
            F.slice("words", F.greatest(i - STRIDE, F.lit(0)) + 1, WINDOW + 2 * STRIDE).alias("context"),
        ),
    )
    windows = parts.select(id_col, F.explode(F.filter(cut, lambda w: holds(w["words"]))).alias("w")).select(id_col, "w.*")
    windows = windows.withColumn("grams", _grams(F.col("words")))
    found = model.classify(windows).where(F.col("best") != NONE)
    # The templates are a fixed list of a few rows: one value for all windows.
    listed = _notices(docs.sparkSession).where(F.col("family") != UNKNOWN).select("family", _pairs(F.col("words")).alias("pairs"))
    notices = listed.agg(F.collect_list(F.struct("family", "pairs")).alias("n")).scalar()
    # A notice that the window's edge cuts is compared as a whole.
    share = lambda n: F.size(F.array_intersect(n["pairs"], F.col("_pairs"))) / F.size(n["pairs"])
    compared = found.withColumn("_pairs", _pairs(F.col("context"))).withColumn("_notices", notices)
    compared = compared.withColumn("_like", F.transform("_notices", lambda n: F.struct(share(n).alias("share"), n["family"].alias("family"))))
    own = F.array_max(F.transform(F.filter("_like", lambda x: x["family"] == F.col("best")), lambda x: x["share"]))
    compared = compared.withColumn("similarity", F.coalesce(own, F.lit(0.0))).withColumn("_most", F.array_max("_like"))
    confirmed = (F.col("similarity") >= CONFIRMED) & (F.col("probability") >= model.least)
    # Not confirmed, but at the edge of a whole notice of another family: that one.
    edge = (F.col("similarity") < CONFIRMED) & (F.col("_most.share") >= CONFIRMED)
    return compared.select(
        id_col,
        "line",
        "window",
        F.when(confirmed, F.col("best")).when(edge, F.col("_most.family")).otherwise(UNKNOWN).alias("license"),
        F.col("best").alias("predicted"), "probability", "similarity", confirmed.alias("confirmed"),
        F.array_join("words", " ").alias("passage"),
    )
