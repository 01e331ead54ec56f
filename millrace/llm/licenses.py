"""License scans: a trained paragraph classifier whose findings a template comparison confirms.

Sparse binary features (the words and word pairs that variants of the templates below have) feed a
multinomial logistic regression over license families and an unknown class. The classifier learns
from those variants and, as unknown, from every distinct paragraph of the corpus; how sure it must
be is calibrated on all of these, so the share of them that passes is exact. A finding is confirmed if the
paragraph holds enough of the word pairs of one of the family's templates and more than of any other
family's. Texts are cut into words once; what follows reads the features kept of each paragraph.
Everything runs as DataFrame operations and Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.text import bind

VARIANTS = 40  # of each template
DROPPED = 12  # percent of a variant's words that are left out
UNKNOWN_WEIGHT = 4500  # of all paragraphs of the unknown class together at most, in template variants
FALSE_SHARE = 0.001  # of these paragraphs may pass
BINS = 1000  # of each finer count for the threshold
LEAST_SURE = 0.5
CONFIRMED = 0.6  # share of a template's word pairs
COMPLETE = 0.9  # share from which a line is a notice by itself, whatever the next line says
LIKE_PERCENT = 40  # of a line's word pairs that stand in templates; from there on it may be a part of a notice
STRONG_PAIRS = 3  # such pairs of a line that is no example of the unknown class

#: Words or parts of words one of which any text has that holds CONFIRMED of a template's pairs.
HINTS = "(?i)licen|warrant|redistribut|permi|software|mozilla|domain|copyright|reserved|publi"

#: Public notices by which works state their license, whole or by paragraph.
TEMPLATES = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
        " any later version.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        ' on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
        " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,"
        " INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc": [
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-nc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "epl": [
        "This work is licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
        " any later version.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your"
        " option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS"
        " OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "public domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "reserved": [
        "All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of"
        " the publisher.",
    ],
}
UNKNOWN = "unknown"
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _pairs(found: Column) -> Column:
    """Neighbouring words joined by a blank."""
    return F.when(F.size(found) < 2, F.array().cast("array<string>")).otherwise(
        F.zip_with(
            F.slice(found, F.lit(1), F.size(found) - 1), F.slice(found, F.lit(2), F.size(found) - 1),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
    )


def _worded(rows: DataFrame) -> DataFrame:
    """The words of every piece that has one; a filter on the words themselves would cut each piece twice."""
    return rows.where(F.col("piece").rlike(r"[\p{L}\p{N}]")).select("doc_id", "paragraph", _words(F.col("piece")).alias("words"))


def paragraphs(docs: DataFrame, text: str, doc_id: str, separator: str) -> DataFrame:
    """(doc_id, paragraph, words) of every paragraph with a word.

    Neighbouring lines that look like parts of a wrapped notice are one paragraph, under the first
    one's number.
    """
    held = F.coalesce(F.col(text), F.lit(""))
    pieces = F.split(held, separator)
    if separator == "\n":
        single = F.transform(pieces, lambda x, i: F.struct(i.alias("paragraph"), x.alias("piece")))
        found = F.when(held.rlike(HINTS), bind(pieces, _unwrapped)).otherwise(single)
        return _worded(docs.select(F.col(doc_id).alias("doc_id"), F.inline_outer(found)))
    # outer, as the optimizer would split each text twice to keep empty arrays from an inner one
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode_outer(pieces).alias("paragraph", "piece"))
    return _worded(rows)


def _templates(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(family).alias("family"), F.lit(n).alias("number"), F.lit(t).alias("piece"))
        for family, texts in TEMPLATES.items() for n, t in enumerate(texts)
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).select("family", "number", _words(F.col("piece")).alias("words"))


def _template_pairs() -> dict[str, list[list[str]]]:
    """Word pairs of each template, as `_pairs` makes them."""
    import re

    out = {}
    for family, texts in TEMPLATES.items():
        split = [re.findall(r"[a-z0-9]+", t.lower()) for t in texts]
        out[family] = [sorted({f"{a} {b}" for a, b in zip(w, w[1:])}) for w in split]
    return out


def _by_family(pairs: Column) -> dict[str, Column]:
    """For each family the largest share of a template's word pairs that are among `pairs`."""

    def best(templates: list[list[str]]) -> Column:
        shares = [
            F.size(F.array_intersect(F.array(*map(F.lit, t)), pairs)) / F.lit(float(len(t))) for t in templates if t
        ]
        return F.greatest(*shares) if len(shares) > 1 else shares[0]

    return {f: best(t) for f, t in _template_pairs().items()}


def likeness(found: Column) -> Column:
    """Largest share of a template's word pairs that a paragraph holds."""
    return F.greatest(*_by_family(_pairs(found)).values())


def compared(found: Column, family: Column) -> Column:
    """Struct (similarity, other): the largest shares for `family`'s templates and for those of all other families."""
    return _compared(_pairs(found), family)


def _compared(pairs: Column, family: Column) -> Column:
    shares = F.array(*[F.struct(v.alias("share"), F.lit(f).alias("family")) for f, v in _by_family(pairs).items()])

    def best(chosen) -> Column:
        return F.coalesce(F.array_max(F.transform(F.filter(shares, chosen), lambda x: x["share"])), F.lit(0.0))

    return F.struct(
        best(lambda x: x["family"] == family).alias("similarity"), best(lambda x: x["family"] != family).alias("other")
    )


def _template_hits(pairs: Column) -> Column:
    """How many of the word pairs stand in a template."""
    known = sorted({p for templates in _template_pairs().values() for t in templates for p in t})
    return F.size(F.filter(pairs, lambda p: p.isin(*known)))


def _half_like(grams: Column) -> Column:
    """Whether the pairs among `grams` are half of any template's, compared only where that is possible.

    Of any pairs of a template that are more than half of it, such a paragraph holds one; the longest are rare in other texts.
    """
    probes = sorted({
        p for templates in _template_pairs().values() for t in templates for p in sorted(t, key=lambda p: (-len(p), p))[: len(t) // 2 + 1]
    })
    whole = F.greatest(*_by_family(grams).values()) >= 0.5
    return F.when(F.exists(grams, lambda p: p.isin(*probes)), whole).otherwise(False)


def _part_of_notice(found: Column) -> Column:
    """Whether a line with these words may be a part of a wrapped notice and is not a notice by itself."""
    vocabulary = sorted({w for templates in _template_pairs().values() for t in templates for p in t for w in p.split(" ")})
    hits = bind(_pairs(found), lambda p: F.struct(_template_hits(p).alias("n"), F.size(p).alias("of")))
    like = bind(hits, lambda h: (h["n"] > 0) & (h["n"] * 100 >= h["of"] * LIKE_PERCENT))
    short = (F.size(found) > 0) & (F.size(found) < 3) & F.forall(found, lambda w: w.isin(*vocabulary))
    return F.when(short | like, likeness(found) < COMPLETE).otherwise(False)


def _unwrapped(lines: Column) -> Column:
    """Structs (paragraph, piece) of the lines, neighbouring parts of notices joined by a blank."""

    def joined(parts: Column) -> Column:
        def goes_on(i: Column) -> Column:
            return (i > 0) & F.get(parts, i) & F.coalesce(F.get(parts, i - 1), F.lit(False))

        glued = F.transform(
            lines, lambda x, i: F.concat(F.when(i == 0, "").when(goes_on(i), " ").otherwise("\n"), x)
        )
        places = F.filter(F.transform(lines, lambda _, i: i), lambda i: ~goes_on(i))
        return F.zip_with(
            places, F.split(F.array_join(glued, ""), "\n"), lambda i, x: F.struct(i.alias("paragraph"), x.alias("piece"))
        )

    return bind(F.transform(lines, lambda x: bind(_words(x), _part_of_notice)), joined)


def _variants(spark: SparkSession) -> DataFrame:
    """(label, words) of each template and of variants of it that lack some words."""
    label = {f: i for i, f in enumerate(FAMILIES)}
    variant = _templates(spark).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    kept = F.filter(
        "words",
        lambda w, i: (F.col("variant") == 0)
        | (F.pmod(F.xxhash64("family", "number", "variant", i), F.lit(100)) >= DROPPED),
    )
    return variant.select(
        F.element_at(F.create_map(*[F.lit(x) for f, i in label.items() for x in (f, float(i))]), F.col("family")).alias("label"),
        kept.alias("words"),
    ).where(F.size("words") > 1)


def _vocabulary(variants: DataFrame) -> list[str]:
    """All words and word pairs of the variants."""
    grams = variants.select(F.explode(F.concat("words", _pairs(F.col("words")))).alias("gram"))
    return sorted(r.gram for r in grams.distinct().collect())


def _known(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """`rows` with grams, the words and pairs of `words` that the vocabulary has, each once and in order, in place of words.

    Also a digest of all words and whether the paragraph is like a part of a notice: many of its pairs stand in templates.
    """
    single, double = [g for g in vocabulary if " " not in g], [g for g in vocabulary if " " in g]
    others = [c for c in rows.columns if c != "words"]
    # a pair with a word that is not in the vocabulary is NULL
    marked = rows.select(
        *others, F.xxhash64("words").alias("digest"), F.transform("words", lambda w: F.when(w.isin(*single), w)).alias("marked")
    )
    paired = marked.withColumn("pairs", F.filter(_pairs(F.col("marked")), lambda p: p.isin(*double)))
    strong = bind(_template_hits(F.col("pairs")), lambda n: (n >= STRONG_PAIRS) & (n * 100 >= (F.size("marked") - 1) * LIKE_PERCENT))
    grams = F.concat(F.filter("marked", lambda w: w.isNotNull()), "pairs")
    return paired.select(*others, "digest", strong.alias("strong"), F.array_sort(F.array_distinct(grams)).alias("grams"))


@dataclass
class Classifier:
    model: LogisticRegressionModel
    vocabulary: list[str]
    least_sure: float

    def family(self, rows: DataFrame) -> DataFrame:
        """`rows` (grams) with family and probability; families the classifier is not sure of are unknown."""
        scored = self.model.transform(_featured(rows, self.vocabulary)).drop("features", "rawPrediction")
        odds = vector_to_array("probability")
        chosen = F.col("prediction").cast("int")
        found = scored.select(
            "*", chosen.alias("chosen"), F.get(odds, chosen).alias("sure")
        ).drop("probability", "prediction")
        named = F.get(F.array(*map(F.lit, FAMILIES)), F.col("chosen"))
        kept = (F.col("chosen") < len(FAMILIES) - 1) & (F.col("sure") >= self.least_sure)
        return found.select(
            *[c for c in rows.columns], F.when(kept, named).otherwise(UNKNOWN).alias("family"), F.col("sure").alias("probability")
        )


def _featured(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    return CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True).transform(rows)


def _at_rank(values: DataFrame, rank: int) -> float:
    """The value at a rank (from 0) of the descending order of (value, n), each value n times, from ever finer counts of BINS bins."""
    value = F.col("value")
    ends = [F.min(value).alias("low"), F.max(value).alias("high")]
    low, high = values.agg(*ends).first()
    while low < high:
        place = F.least(F.floor((value - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        bins = values.where(value.between(low, high)).groupBy(place.alias("bin")).agg(F.sum("n").alias("n"), *ends)
        for found in sorted(bins.collect(), reverse=True):
            if rank < found.n:
                low, high = found.low, found.high
                break
            rank -= found.n
    return low


def _threshold(seen: DataFrame, total: int) -> float:
    """What all but FALSE_SHARE of `total` paragraphs stay below, at least LEAST_SURE; `seen` (value, n) are those from there on."""
    place = FALSE_SHARE * (total - 1)
    above = int(place)
    count = seen.agg(F.sum("n")).first()[0] or 0
    if above >= count:
        return LEAST_SURE
    high = _at_rank(seen, above)
    low = _at_rank(seen, above + 1) if above + 1 < count else LEAST_SURE
    return max(LEAST_SURE, high + (low - high) * (place - above))


def train(parts: DataFrame, variants: DataFrame, vocabulary: list[str], unknown_weight: int = UNKNOWN_WEIGHT) -> Classifier:
    """Learn the families from template variants and the unknown class from all paragraphs (`_known`) of the corpus.

    Every distinct paragraph counts once, all together as `unknown_weight` variants at most; equal features are one weighted
    example. Those that hold half of any template's pairs, or much of whose own pairs stand in templates, are
    left out, since the corpus is not labelled.
    """
    with session.workspace(parts.sparkSession) as settle:
        distinct = parts.select("digest", "strong", "grams").distinct()
        unknown = settle(
            distinct.where(~F.col("strong")).groupBy("grams").agg(F.count("*").alias("n")).where(~_half_like(F.col("grams"))),
            "license-unknown",
        )
        total = unknown.agg(F.sum("n")).first()[0] or 0
        weight = F.col("n") * F.lit(min(1.0, unknown_weight / max(total, 1)))
        known = variants.select("label", F.concat("words", _pairs(F.col("words"))).alias("grams"), F.lit(1.0).alias("weight"))
        examples = known.unionByName(unknown.select(F.lit(float(FAMILIES.index(UNKNOWN))).alias("label"), "grams", weight.alias("weight")))
        rows = _featured(examples, vocabulary).select("label", "features", "weight")
        learner = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=40, standardization=False, weightCol="weight")
        model = learner.fit(rows)
        odds = F.array_max(F.slice(vector_to_array("probability"), 1, len(FAMILIES) - 1))
        scored = model.transform(_featured(unknown, vocabulary)).select(odds.alias("value"), "n")
        seen = settle(scored.where(F.col("value") >= LEAST_SURE), "license-sure")
        return Classifier(model, vocabulary, _threshold(seen, total))


def scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", separator: str = "\n", unknown_weight: int = UNKNOWN_WEIGHT
) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, confirmed) of every paragraph with a family.

    Paragraphs count from 0; lines of a wrapped notice are one, under its first line's number. NULL,
    empty and wordless texts have none; texts of any length are scanned whole; repeated rows come
    back repeated; an empty table gives an empty result; other columns are not read. probability is
    the family's, rounded to 6 places; of equally probable families the first by name is taken.
    confirmed: `similarity`, the largest share of a template's word pairs, is CONFIRMED at least, and
    no template of another family is as like.
    """
    variants = _variants(docs.sparkSession)
    vocabulary = _vocabulary(variants)
    parts = session.settle(_known(paragraphs(docs, text, doc_id, separator), vocabulary), "license-parts")
    classifier = train(parts, variants, vocabulary, unknown_weight)
    found = classifier.family(parts).where(F.col("family") != UNKNOWN)
    like = F.col("like.similarity")
    return found.select(
        "doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"),
        bind(F.col("grams"), lambda g: _compared(g, F.col("family"))).alias("like"),
    ).select(
        "doc_id", "paragraph", "family", "probability", like.alias("similarity"), ((like >= CONFIRMED) & (like > F.col("like.other"))).alias("confirmed")
    )
