"""Licence families of paragraphs, with DataFrame functions only.

A paragraph is a line. Its features are the word sequences of one to three words that occur in the
licence templates, weighed by how rare their rarest word is in all texts of the corpus, equal ones
once. A multinomial logistic regression (Spark's own, sparse by an L1 share)
learns the families from the templates, which are opening sentences, paragraphs and the usual short
forms for each name, from their variants with a word left out or text around them, and the class
``unknown`` from all lines of a bounded sample of the corpus. A paragraph without such words has
no feature and is ``unknown`` by the intercepts; all others are scored, each in its row, without
a shuffle. The temperature of the probabilities is fitted last, on rows kept out of training,
sample lines among them.

A prediction is confirmed by comparison: the share of a template's word pairs that the paragraph
holds, for the best template of the predicted family, so a changed word costs two pairs.

Templates, words and weights depend on the templates alone in size, a few thousand short rows.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import fresh_name, text_or_empty, written

#: Opening or notice sentences of well-known licences, by family.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License"],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "ISC": ["Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC0": ["Dedicated to the public domain under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
#: Names of the families as short notices give them, and the identifiers of file headers.
NAMES = {
    "Apache-2.0": ["Apache", "Apache 2.0", "Apache License 2.0"],
    "MIT": ["MIT"],
    "BSD": ["BSD", "BSD 2-Clause", "BSD 3-Clause"],
    "GPL": ["GPL", "GPLv2", "GPLv3", "GNU GPL v3", "GNU General Public"],
    "LGPL": ["LGPL", "GNU LGPL v3", "GNU Lesser General Public"],
    "AGPL": ["AGPL", "GNU AGPL v3", "GNU Affero General Public"],
    "MPL-2.0": ["MPL 2.0", "Mozilla Public"],
    "ISC": ["ISC"],
    "CC-BY": ["CC BY 3.0", "CC BY 4.0"],
    "CC-BY-SA": ["CC BY-SA 3.0", "CC BY-SA 4.0"],
    "CC-BY-NC": ["CC BY-NC 3.0", "CC BY-NC 4.0"],
    "CC-BY-ND": ["CC BY-ND 3.0", "CC BY-ND 4.0"],
    "CC0": ["CC0", "CC0 1.0"],
    "Unlicense": ["Unlicense"],
}
IDENTIFIERS = {
    "Apache-2.0": ["Apache-2.0"],
    "MIT": ["MIT"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "MPL-2.0": ["MPL-2.0"],
    "ISC": ["ISC"],
    "CC-BY": ["CC-BY-3.0", "CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-3.0", "CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-3.0", "CC-BY-NC-4.0"],
    "CC-BY-ND": ["CC-BY-ND-3.0", "CC-BY-ND-4.0"],
    "CC0": ["CC0-1.0"],
    "Unlicense": ["Unlicense"],
}
NAMED = ["Licensed under the {} License", "Released under {}", "This project is {} licensed", "This software is distributed under the terms of the {} license", "License: {}"]
IDENTIFIED = ["SPDX-License-Identifier: {}", "License: {}"]
#: Paragraphs of full licence texts beyond their opening.
PARAGRAPHS = {
    "MIT": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ],
    "BSD": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    ],
    "Apache-2.0": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "See the License for the specific language governing permissions and limitations under the License",
    ],
    "GPL": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "ISC": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"],
    "MPL-2.0": ["If a copy of the MPL was not distributed with this file, You can obtain one at"],
}


def all_templates() -> list[tuple[str, str]]:
    """``(family, text)`` of sentences, paragraphs and short forms."""
    out = [(f, t) for texts in (TEMPLATES, PARAGRAPHS) for f, many in texts.items() for t in many]
    out += [(f, form.format(n)) for f, names in NAMES.items() for n in names for form in NAMED]
    return out + [(f, form.format(n)) for f, names in IDENTIFIERS.items() for n in names for form in IDENTIFIED]


#: Sentences that use such words without granting a licence; they belong to ``unknown``.
OTHERS = [
    "The driver showed a license to the officer",
    "All rights reserved",
    "The general public may visit the source of the river",
    "Version 2.0 of the program was released in May",
    "A copy of the permit is hereby attached",
    "The license fee is due in spring",
    "Copyright is a legal right",
    "They use the new software at work",
    "Students of the MIT met in the general hall",
]
UNKNOWN = "unknown"
SAMPLE_DOCUMENTS, LEAST_RARITY = 300, 0.4
AROUND, LEAST_PROBABILITY, LEAST_SIMILARITY = 4, 0.5, 0.75
_WORD = "([a-z0-9]+(?:[.+-][a-z0-9]+)*)"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(1))


def sequences(w: Column, n: int) -> Column:
    """All runs of ``n`` words, joined by spaces."""
    starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))


def known_words(w: Column, own: list[str]) -> Column:
    """The words, null where a template has no such word."""
    return F.transform(w, lambda x: F.when(x.isin(own), x))


def features(v: Column) -> Column:
    """Distinct runs of one to three words without a null between, however long the paragraph is."""

    def joined(runs: Column, skip: int) -> Column:
        return F.zip_with(runs, F.slice(v, skip + 1, F.size(v)), lambda a, b: F.concat(a, F.lit(" "), b))

    two = joined(v, 1)
    return F.array_distinct(F.filter(F.concat(v, two, joined(two, 2)), lambda x: x.isNotNull()))


def local_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from values of the driver, as an expression."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _templates(spark: SparkSession) -> DataFrame:
    rows = [{"family": family, "text": text} for family, text in all_templates()]
    return local_table(spark, rows, "family string, text string").withColumn("words", words(F.col("text")))


def paragraphs(docs: DataFrame, text: str, number: str, part: str) -> DataFrame:
    return docs.select("*", F.posexplode(F.split(F.col(text), "\n")).alias(number, part))


def rarities(docs: DataFrame, own: list[str]) -> dict[str, float]:
    """For each word from ``LEAST_RARITY``, in every text, to 1, in none; all texts count, equal ones once."""
    held = F.filter(F.array_distinct(words(F.col("text"))), lambda x: x.isin(own))
    pairs = docs.select(F.xxhash64("text").alias("h"), F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).distinct()
    df = {r["word"]: r["count"] for r in pairs.groupBy("word").count().collect()}  # one row for each word
    n = df.get("", 0)
    span = (1 - LEAST_RARITY) / math.log(2 + n)
    return {w: LEAST_RARITY + span * math.log((1 + n) / (1 + df.get(w, 0))) for w in own}


@dataclass(frozen=True)
class LicenceModel:
    """The fitted stages; ``shifts`` are added to the raw scores, which are then divided by the temperature."""

    families: list[str]
    own: list[str]
    vectors: CountVectorizerModel
    scale: list[float]
    regression: LogisticRegressionModel
    shifts: list[float]
    temperature: float


def fit_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenceModel:
    """A model from the templates and at most ``SAMPLE_DOCUMENTS`` documents, taken in the
    order of a hash of their id."""
    spark = docs.sparkSession
    sample = docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    sample = sample.orderBy(F.xxhash64("id", "text"), "id").limit(SAMPLE_DOCUMENTS)
    sample = written(paragraphs(sample, "text", "n", "part").select("part").filter("length(part) > 0"), "licence-sample")
    templates = _templates(spark)
    triples = sorted({r["t"] for r in templates.select(F.explode(sequences(F.col("words"), 3)).alias("t")).collect()})
    # Licence lines of the sample are no examples of unknown.
    plain = ~F.arrays_overlap(sequences(words(F.col("part")), 3), F.array(*[F.lit(t) for t in triples]))
    sample = written(sample.filter(plain), "licence-sample")
    own = sorted({w for r in templates.select("words").collect() for w in r["words"]})
    rarity = rarities(docs.select(text_or_empty(F.col(text_col)).alias("text")), own)

    # Different lines with the fewest template words: a notice of one source must not pass as unknown.
    lines = sample.select(F.substring("part", 1, 200).alias("near")).distinct()
    around = lines.orderBy(F.size(F.filter(words(F.col("near")), lambda x: x.isin(own))), F.xxhash64("near"), "near").limit(AROUND).collect()
    near = F.array(*[F.lit(r["near"]) for r in around]) if around else F.array().cast("array<string>")
    whole = templates.select("family", "words")
    dropped = templates.filter(F.size("words") > 3).select(
        "family",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.filter("words", lambda x, j: j != i)
            )
        ).alias("words"),
    )
    # A few lines of the sample stand before and after each template.
    edged = templates.select("family", "text", F.explode(near).alias("near")).select(
        "family", F.explode(F.array(words(F.concat_ws(" ", "near", "text")), words(F.concat_ws(" ", "text", "near")))).alias("words")
    )
    others = local_table(spark, [{"text": t} for t in OTHERS], "text string").select(
        F.lit(UNKNOWN).alias("family"), words(F.col("text")).alias("words")
    )
    alone = sample.distinct().select(F.lit(UNKNOWN).alias("family"), words(F.col("part")).alias("words"))
    families = [UNKNOWN, *sorted(TEMPLATES)]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    rest = dropped.union(edged).union(others).union(alone)
    rows = whole.withColumn("plain", F.lit(True)).union(rest.withColumn("plain", F.lit(False)))
    rows = rows.select(label.alias("label"), known_words(F.col("words"), own).alias("v"), F.size("words").alias("n"), "plain")
    rows = rows.select("label", features(F.col("v")).alias("grams"), "n", "plain")
    rows = rows.filter("label > 0 or size(grams) > 0")
    aside = ~F.col("plain") & (F.pmod(F.xxhash64("label", "grams", "n"), F.lit(5)) == 0)
    rows = written(rows.withColumn("aside", aside), "licence-variants")
    # Sequences of the templates are the features; what stands around them in other lines is none.
    known = whole.select(features(F.col("words")).alias("grams"))
    vectors = CountVectorizer(inputCol="grams", outputCol="counted", vocabSize=2**30, binary=True).fit(known)
    scale = [max(rarity[w] for w in g.split(" ") if w in rarity) for g in vectors.vocabulary]
    weighed = ElementwiseProduct(scalingVec=Vectors.dense(scale), inputCol="counted", outputCol="vector")
    wide = weighed.transform(vectors.transform(rows)).cache()
    fitted = LogisticRegression(
        featuresCol="vector", labelCol="label", family="multinomial", regParam=0.001, elasticNetParam=0.3, maxIter=60, standardization=False
    ).fit(wide.filter("not aside"))
    intercepts = fitted.interceptVector.toArray()
    shifts = [0.0] * len(intercepts)
    shifts[0] = max(0.0, float(intercepts[1:].max(initial=-20.0)) + 0.1 - float(intercepts[0]))  # nothing known means unknown
    aside = fitted.transform(wide.filter("aside")).select("label", vector_to_array("rawPrediction").alias("raw")).collect()
    wide.unpersist()

    def loss(t: float) -> float:
        z = (np.array([r["raw"] for r in aside]) + shifts) / t
        z -= z.max(1, keepdims=True)
        at = np.array([int(r["label"]) for r in aside])
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(at)), at]))

    temperature = float(min(np.geomspace(0.25, 4, 33), key=loss)) if aside else 1.0
    return LicenceModel(families, own, vectors, scale, fitted, shifts, temperature)


def may_be_licence(w: Column, model: LicenceModel) -> Column:
    """False only for words of a paragraph that the model is sure to find ``unknown``.

    ``unknown`` starts ahead of every family. What a sequence can add to any family over ``unknown``
    is put down to its rarest word; if all that the distinct words of a paragraph stand for does not
    make up the lead, no family can win, whatever their order.
    """
    scores = np.array(model.regression.coefficientMatrix.toArray()) * model.scale
    starts = model.regression.interceptVector.toArray() + np.array(model.shifts)
    gains = (scores[1:] - scores[0]).max(0, initial=0.0)
    rarity = dict(zip(model.vectors.vocabulary, model.scale, strict=True))  # also of each word alone
    stands = dict.fromkeys(model.own, 0.0)
    for gram, gain in zip(model.vectors.vocabulary, gains.tolist(), strict=True):
        stands[max((x for x in gram.split(" ") if x in stands), key=lambda x: (rarity.get(x, 0.0), x))] += gain
    telling = {x: v for x, v in stands.items() if v > 0}
    if not telling:
        return F.lit(starts[1:].max() >= starts[0])
    lead = float(starts[0] - starts[1:].max())
    rounding = 1e-6 * (1 + abs(lead))
    worth = F.map_from_arrays(F.array(*[F.lit(x) for x in telling]), F.array(*[F.lit(v) for v in telling.values()]))
    held = F.array_distinct(F.filter(w, lambda x: x.isin(list(telling))))
    return F.aggregate(held, F.lit(0.0), lambda a, x: a + worth[x]) >= lead - rounding


def scan(docs: DataFrame, model: LicenceModel, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row for each paragraph that is a licence statement.

    Columns: all of ``docs`` but its text; ``paragraph`` (line number from 0), ``family``,
    ``probability``, ``similarity`` to the best template of that family, ``confirmed``, and the
    line as ``licence_text`` with ``with_text``. Null and empty texts have no rows; rows that
    repeat an id are scanned each. Columns named like a result are replaced, others pass
    through. Every paragraph that is not ``unknown`` with at least ``LEAST_PROBABILITY`` comes
    out; ``confirmed`` tells whether the comparison agrees.
    """
    result = ["paragraph", "family", "probability", "similarity", "confirmed", "licence_text"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in result and c != text_col])
    names = ["text_", "words_", "grams_", "part_", "counted_", "vector_", "raw_", "z_", "top_", "step_"]
    text, w, gram, part, counted, vector, raw, z, top, step = fresh_name(docs, *names)
    others = [c for c in docs.columns if c != text_col]
    held = docs.select(*others, text_or_empty(F.col(text_col)).alias(text))
    # A filter that reads the row number cannot move below the step that made it, where it would repeat the work.
    number, after = F.monotonically_increasing_id().alias(step), F.col(step) >= 0
    lines = paragraphs(held, text, "paragraph", part).drop(text).select("*", words(F.col(part)).alias(w), number)
    lines = lines.filter(after & may_be_licence(F.col(w), model)).drop(step)
    grams = lines.select("*", features(known_words(F.col(w), model.own)).alias(gram))

    vectors = model.vectors.copy().setInputCol(gram).setOutputCol(counted)
    weighed = ElementwiseProduct(scalingVec=Vectors.dense(model.scale), inputCol=counted, outputCol=vector)
    regression = model.regression.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")
    scored = regression.transform(weighed.transform(vectors.transform(grams)))
    shifts = F.array(*[F.lit(x) for x in model.shifts])
    shifted = F.zip_with(vector_to_array(raw), shifts, lambda a, b: (a + b) / model.temperature)
    kept = [*others, "paragraph", part, w]
    scored = scored.select(*kept, shifted.alias(z)).select(*kept, z, F.array_max(z).alias(top))
    total = F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - F.col(top)))
    families = F.array(*[F.lit(f) for f in model.families])
    family = F.element_at(families, F.array_position(z, F.col(top)).cast("int"))
    found = scored.select(*kept, family.alias("family"), (1 / total).alias("probability"), number).filter(
        after & (F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY)
    ).drop(step)

    pairs = lambda c: F.array_distinct(sequences(c, 2))
    # The templates are values of the expression, some hundred short lists.
    wanted = _templates(docs.sparkSession).select("family", pairs(F.col("words")).alias("pairs")).distinct().collect()
    texts = F.from_json(F.lit(json.dumps([r.asDict() for r in wanted])), "array<struct<family string, pairs array<string>>>")
    held_share = lambda t: F.size(F.array_intersect(pairs(F.col(w)), t["pairs"])) / F.size(t["pairs"])
    similarity = F.array_max(F.transform(F.filter(texts, lambda t: t["family"] == F.col("family")), held_share))
    return found.select(
        *others,
        "paragraph",
        "family",
        "probability",
        similarity.alias("similarity"),
        (similarity >= LEAST_SIMILARITY).alias("confirmed"),
        *([F.col(part).alias("licence_text")] if with_text else []),
    )
