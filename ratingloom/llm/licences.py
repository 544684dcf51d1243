"""Licence scan by a trained paragraph classifier.

A paragraph is a run of lines up to a blank line or the end of a sentence at the end
of a line; marks of comments are taken off and wrapped lines joined, so that a notice
is judged as a whole however it is set. Features are word n-grams of one to three
words, taken from public licence notices and from common forms of naming a licence;
the classifier is a multinomial logistic regression that is trained on variants of
both (words left out) against paragraphs of the corpus as the unknown class. A
second, one-dimensional regression turns the margin over the unknown class into a
calibrated probability; it rests on whole notices and forms that a first regression
has not seen. Below one half a paragraph stays unknown. What is predicted is compared
with the templates of its family and confirmed where enough of the n-grams agree.

Every n-gram of the notices is a feature, whatever words the background sample
holds; the regression weighs them. A paragraph without any word of the notices
has no feature and is unknown, which the scan tells without expanding it.
"""

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import durable

# Short notices of common licences, as their publishers give them.
TEMPLATES = (
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for full license information."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher."),
)
# Names of licences, and how texts refer to them by name.
NAMES = (
    ("Apache", "Apache License, Version 2.0"),
    ("Apache", "Apache License 2.0"),
    ("MIT", "MIT License"),
    ("BSD", "BSD 2-Clause License"),
    ("BSD", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("GPL", "GNU General Public License, version 3"),
    ("GPL", "GNU General Public License v2.0"),
    ("GPL", "GNU GPL v3"),
    ("LGPL", "GNU Lesser General Public License, version 2.1"),
    ("LGPL", "GNU Lesser General Public License v3.0"),
    ("LGPL", "GNU LGPL v3"),
    ("AGPL", "GNU Affero General Public License, version 3"),
    ("AGPL", "GNU Affero General Public License v3.0"),
    ("AGPL", "GNU AGPL v3"),
    ("MPL", "Mozilla Public License, version 2.0"),
    ("EPL", "Eclipse Public License 2.0"),
    ("CC-BY", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY", "CC BY 4.0"),
    ("CC-BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA", "CC BY-SA 4.0"),
    ("CC-BY-NC", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC", "CC BY-NC 4.0"),
    ("CC0", "CC0 1.0 Universal"),
    ("Unlicense", "Unlicense"),
)
FORMS = (
    "Released under the {}.",
    "Licensed under the {}.",
    "This project is licensed under the terms of the {}.",
    "Distributed under the {}. See the LICENSE file for details.",
    "This work is licensed under a {}.",
    "The code in this repository is available under the {}.",
)
NOTICES = TEMPLATES + tuple((family, form.format(name)) for form in FORMS for family, name in NAMES)
UNKNOWN = "unknown"
# Marks of comments before and behind the text of a line.
_OPENING = r"^[\s]*(?:(?://+|/\*+|\*+/?|#+|--+|;+|%+|<!--+|\\\\+|>+|dnl\b|REM\b)[\s]*)*"
_CLOSING = r"[\s]*(?:\*+/|--+>)[\s]*$"
# Bounds of the training sample: background documents (by hash of the id, about as many), variants of a notice.
BACKGROUND = 300
VARIANTS = 24
# Share of a notice's three-word n-grams from which a sampled paragraph is no background: below it are ordinary phrases.
NOTICE = 0.25
# Share of a paragraph's or a template's n-grams that must agree.
CONFIRM = 0.6


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _ngrams(words: str) -> Column:
    """N-grams of one to three words, each once; ``words`` names a column."""
    n = F.size(words)
    joined = {
        2: lambda p: F.concat_ws(" ", p["w0"], p["w1"]),
        3: lambda p: F.concat_ws(" ", p["w0"], p["w1"], p["w2"]),
    }
    grams = [F.col(words)]
    for size in (2, 3):
        count = F.greatest(n - size + 1, F.lit(0))
        parts = F.arrays_zip(*[F.slice(words, k + 1, count).alias(f"w{k}") for k in range(size)])
        grams.append(F.transform(parts, joined[size]))
    return F.array_distinct(F.concat(*grams))


def _once(column: Column) -> Column:
    """``column``, computed once a row: no filter or later column repeats what is generated."""
    return F.explode(F.array(column))


def _templates(spark: SparkSession) -> DataFrame:
    """``template, family, held, words`` of all notices; ``held`` are the forms kept for calibration, every third."""
    n = len(TEMPLATES)
    held = [i >= n and (i - n) // len(NAMES) % 3 == 1 for i in range(len(NOTICES))]
    rows = F.array(
        *[F.struct(F.lit(f).alias("family"), F.lit(h).alias("held"), F.lit(t).alias("text")) for (f, t), h in zip(NOTICES, held)]
    )
    table = spark.range(1).select(F.posexplode(rows).alias("template", "t"))
    return table.select("template", "t.family", "t.held", _words(F.col("t.text")).alias("words"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, paragraph, text``: paragraphs that hold a word; ``paragraph`` is the number of the first line, from 0.

    A paragraph ends at a blank line and behind a line that ends a sentence.
    Marks of comments at the ends of its lines are left out, and its lines joined
    by a space.
    """
    # Each line is led by its number between two control characters, which texts do not keep.
    plain = F.translate("text", "\x01\x02\r", "")

    def bare(line: Column) -> Column:
        # Most lines begin with a letter and end without a mark; they need no pattern.
        opened = F.ltrim(line)
        marked = ~F.substring(opened, 1, 1).rlike("[A-Za-z0-9]") | opened.startswith("dnl") | opened.startswith("REM")
        text = F.when(marked, F.regexp_replace(line, _OPENING, "")).otherwise(opened)
        return F.when(text.contains("*/") | text.contains("-->"), F.regexp_replace(text, _CLOSING, "")).otherwise(F.rtrim(text))

    lines = F.transform(
        F.split(plain, "\n"),
        lambda line, i: F.when(
            line.rlike("[A-Za-z0-9]"), F.concat(F.lit("\x01"), i.cast("string"), F.lit("\x02"), bare(line))
        ).otherwise(""),
    )
    ended = F.regexp_replace(F.array_join(lines, "\n"), r"([.!?:;][\"')\]]*)\n", "$1\n\n")
    found = docs.select("doc_id", F.explode(F.split(ended, "\n{2,}")).alias("raw")).filter(F.col("raw").contains("\x01"))
    return found.select(
        "doc_id",
        F.regexp_extract("raw", "\x01([0-9]+)\x02", 1).cast("int").alias("paragraph"),
        F.regexp_replace(F.regexp_replace("raw", "\n?\x01[0-9]+\x02", " "), "^ ", "").alias("text"),
    )


@dataclass(frozen=True)
class Classifier:
    """What training learned: the features, the regression over ``families``, words of the notices, calibration."""

    families: list[str]
    words: list[str]
    vectors: CountVectorizerModel
    model: LogisticRegressionModel
    slope: float
    offset: float


def _margin(logits: Column, unknown: int) -> Column:
    """How far the best family is above the unknown class."""
    others = F.filter(logits, lambda _, i: i != unknown)
    return F.array_max(others) - F.get(logits, F.lit(unknown))


def train(docs: DataFrame, background: int = BACKGROUND, variants: int = VARIANTS) -> Classifier:
    """Train on variants of the notices and on paragraphs of about ``background`` documents.

    The sample is drawn by a hash of the id; a licence paragraph in it is no
    background. An empty table leaves the notices and their single words.
    """
    spark = docs.sparkSession
    unknown = len({f for f, _ in NOTICES})
    families = sorted({f for f, _ in NOTICES}) + [UNKNOWN]
    templates = _templates(spark).withColumn("grams", _ngrams("words"))
    # All notices together have some hundred words and about two thousand n-grams.
    known = sorted(r["gram"] for r in templates.select(F.explode("grams").alias("gram")).distinct().collect())
    share = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 40)) / float(1 << 40)
    sample = docs.filter(share < background / max(docs.count(), 1)).select("doc_id", "text")
    sampled = paragraphs(sample).select(_once(_words(F.col("text"))).alias("words"))
    sampled = sampled.select("words", _once(_ngrams("words")).alias("grams"))
    known_triples = []
    for _, words in sorted((r["template"], r["words"]) for r in templates.select("template", "words").collect()):
        triples = sorted({" ".join(words[i : i + 3]) for i in range(len(words) - 2)})
        known_triples += [F.array(*map(F.lit, triples))] if triples else []
    notice = F.exists(
        F.array(*known_triples), lambda t: F.size(F.array_intersect("grams", t)) >= NOTICE * F.size(t)
    )
    plain = durable(sampled.filter(~notice), "licence-background")

    label = F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(float(i)))])
    number = F.explode(F.sequence(F.lit(0), F.lit(variants - 1)))
    # Variant v lacks about v % 6 of 20 words.
    left = F.pmod(F.col("variant"), F.lit(6))
    varied = templates.select("family", "template", "held", "words", number.alias("variant")).select(
        label[F.col("family")].alias("label"),
        "held",
        F.filter(
            "words", lambda w, i: F.pmod(F.xxhash64(w, i, F.col("template"), F.col("variant")), F.lit(20)) >= left
        ).alias("words"),
    )

    def of_unknown(words: Column) -> list[Column]:
        held = F.pmod(F.xxhash64(words), F.lit(3)) == 1
        return [F.lit(float(unknown)).alias("label"), held.alias("held"), words.alias("words")]

    lines = plain.select(*of_unknown(F.col("words")))
    # One word of a notice alone decides nothing.
    scraps = templates.select(F.explode("words").alias("word")).distinct().select(*of_unknown(F.array("word")))
    # Nor do all its words in another order: the n-grams tell.
    shuffled = F.transform(
        F.array_sort(F.transform("words", lambda w, i: F.struct(F.xxhash64(w, i, "variant").alias("at"), w.alias("w")))),
        lambda x: x["w"],
    )
    mixed = templates.select("words", number.alias("variant")).filter("variant < 4").select(shuffled.alias("words"))
    scraps = scraps.union(mixed.select(*of_unknown(F.col("words"))))
    rows = varied.union(lines).union(scraps).withColumn("grams", _ngrams("words"))
    vectors = CountVectorizerModel.from_vocabulary(known, "grams", "features")
    vectors.setBinary(True)
    rows = durable(vectors.transform(rows).select("label", "features", "held").coalesce(1), "licence-training")
    regression = LogisticRegression(family="multinomial", maxIter=40, regParam=0.001)

    # What a model makes of notices it has not seen, in wording that it has not seen.
    raw = vector_to_array("rawPrediction").alias("logits")
    scored = regression.fit(rows.filter("not held")).transform(rows.filter("held")).select("label", raw)
    margins = scored.select(
        (F.col("label") != unknown).cast("double").alias("label"),
        array_to_vector(F.array(_margin(F.col("logits"), unknown))).alias("features"),
    )
    calibrated = LogisticRegression(maxIter=40, regParam=0.01).fit(margins)
    model = regression.fit(rows)
    return Classifier(
        families,
        [g for g in known if " " not in g],
        vectors,
        model,
        float(calibrated.coefficients[0]),
        float(calibrated.intercept),
    )


def scan(docs: DataFrame, classifier: Classifier, confirm: float = CONFIRM) -> DataFrame:
    """Licence paragraphs of ``documents(doc_id, text)``.

    ``doc_id, paragraph, text, family, probability, template, similarity,
    confirmed``: paragraphs (numbered by their first line) that the classifier
    gives to a family with a calibrated probability of one half or more;
    ``template`` is the most similar of ``NOTICES`` of that family, by shared
    n-grams over the smaller number of n-grams, the first of equals. All other
    paragraphs are unknown and have no row. Null and empty texts have none; the
    same place and text of a repeated row is reported once; rows without id are
    scanned like any other. Further columns are ignored; an empty table gives no
    rows.
    """
    spark = docs.sparkSession
    known = F.array(*[F.lit(w) for w in classifier.words])
    # A look at the words first: without a word of a notice a line has no feature and is unknown.
    lines = paragraphs(docs.select("doc_id", "text")).select("*", _once(_words(F.col("text"))).alias("words"))
    lines = lines.filter(F.arrays_overlap("words", known)).select("*", _once(_ngrams("words")).alias("grams"))
    raw = classifier.model.transform(classifier.vectors.transform(lines))
    k = len(classifier.families)
    best = F.slice("logits", 1, k - 1)
    margin = _margin(F.col("logits"), k - 1)
    scored = raw.select("*", _once(vector_to_array("rawPrediction")).alias("logits")).select(
        "doc_id",
        "paragraph",
        "text",
        "grams",
        F.get(
            F.array(*map(F.lit, classifier.families)), (F.array_position(best, F.array_max(best)) - 1).cast("int")
        ).alias("family"),
        (1 / (1 + F.exp(-(classifier.slope * margin + classifier.offset)))).alias("probability"),
    )
    found = scored.filter("probability >= 0.5").withColumn("line", F.xxhash64("text"))
    found = found.dropDuplicates(["doc_id", "paragraph", "line"])
    return _compared(found, spark, confirm)


def _compared(found: DataFrame, spark: SparkSession, confirm: float) -> DataFrame:
    """``found`` with the most similar template of its family, by n-grams compared inside the row."""
    templates = _templates(spark).withColumn("grams", _ngrams("words")).select("template", "family", "grams").collect()
    by_family: dict[str, list[Column]] = {}
    for row in sorted(templates, key=lambda r: r["template"]):
        one = F.struct(F.lit(row["template"]).alias("template"), F.array(*map(F.lit, row["grams"])).alias("grams"))
        by_family.setdefault(row["family"], []).append(one)
    best = None
    for family, rows in by_family.items():
        compared = F.transform(
            F.array(*rows),
            lambda t: F.struct(
                (F.size(F.array_intersect(t["grams"], F.col("grams"))) / F.least(F.size("grams"), F.size(t["grams"]))).alias("similarity"),
                (-t["template"]).alias("order"),
            ),
        )
        case = (F.col("family") == family, F.array_max(compared))
        best = F.when(*case) if best is None else best.when(*case)
    return found.select("*", _once(best).alias("best")).select(
        "doc_id",
        "paragraph",
        "text",
        "family",
        "probability",
        F.when(F.col("best.similarity") > 0, -F.col("best.order")).alias("template"),
        F.col("best.similarity").alias("similarity"),
        (F.col("best.similarity") >= confirm).alias("confirmed"),
    )
