"""Licence scan: a trained classifier of paragraphs, confirmed by comparison with templates.

Units are lines, long ones divided into sentences, and, where a paragraph (a run of lines
that are not blank without their comment marks) has several lines, its joined sentences and
pairs of neighbouring sentences, so wrapped notices are seen whole. Of these a paragraph gives
the best of each family that none of its lines has. A unit's features are its
word 1- to 3-grams, hashed into ``BUCKETS``. A multinomial logistic regression
(sparse weights) tells licence families and ``unknown`` apart; it is trained on the
templates below, varied by dropped and added words, and on units of a bounded
sample of documents and such units with a few licence words as ``unknown``. A quarter of the
variants is set aside: it sets the temperature of the probabilities and the least
probability that keeps 99% of the unknown units unknown. A prediction
stands if its probability reaches that and the unit holds at least
``LEAST_SHARE`` of the n-grams of one template of the family, an anchor word included.

Native: training data, features, scores and comparison are DataFrame
expressions and Spark's own regression; the scan is one projection over the
documents, without shuffle or join. Only units with an anchor word that some template gives ``LEAST_SHARE`` are scored;
without both a prediction cannot stand, so no unit is lost. A notice without sentence ends
among other lines of its paragraph is seen with those lines only.

Edge cases: null and empty texts have no unit; equal texts have equal results;
of several licences in a text the most similar one is named and all are
listed; an empty table gives no rows. Extra columns pass through ``scan``; a
result column whose name is taken gets a trailing ``_``.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names

#: Licence notices by family. Fixed values.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Distributed under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software.",
    ],
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ],
    "cc-by": [
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung 4.0 International Lizenz.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, you can obtain a copy of the License at http://mozilla.org/MPL/2.0/.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved, no part of this publication may be reproduced without prior written permission of the publisher.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
}
#: Public identifiers of licences by family; each is a notice ``SPDX-License-Identifier: ...`` too. Fixed values.
IDENTIFIERS = {
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "apache-2.0": ["Apache-2.0"],
    "boost": ["BSL-1.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause", "0BSD"],
    "cc-by": ["CC-BY-3.0", "CC-BY-4.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "cc-by-sa": ["CC-BY-SA-3.0", "CC-BY-SA-4.0"],
    "epl": ["EPL-1.0", "EPL-2.0"],
    "gpl": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "mit": ["MIT"],
    "mpl-2.0": ["MPL-2.0"],
    "public-domain": ["CC0-1.0", "Unlicense"],
}
for _family, _names in IDENTIFIERS.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {x}" for x in _names]
UNKNOWN = "unknown"
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]
#: Each template holds one of these.
ANCHORS = r"(?i)licen[cs]e|lizenz|copyright|rights reserved|public domain|redistribution|permission notice|permission is hereby|specific prior written permission|permission to use"
#: The same in wrapped texts: comment marks may stand at a line's begin.
WRAPPED = ANCHORS.replace(" ", r"[\s#/*;%>!-]+")
#: One of these is in every text that has an anchor (a cheap look before the pattern).
STEMS = ("licen", "lizenz", "copyright", "reserved", "domain", "redistribution", "permission")
#: Comment marks at a line's begin and end.
MARKS = r"(?m)^[ \t]*(?:[#;%>*!]+|//+|/\*+|--+|<!--+)[ \t]*|[ \t]*(?:\*/|-->)?[ \t\r]*$"
BUCKETS = 1024
VARIANTS = 24
#: Documents whose units are the background of the training data, and units taken of them, at most.
SAMPLE_DOCS = 200
SAMPLE_UNITS = 600
LEAST_SHARE = 0.6
#: Words beyond which a line is divided into sentences.
LONG_LINE = 40


def _let(value, body) -> F.Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(unit) -> F.Column:
    return F.regexp_extract_all(F.lower(unit), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), 0)


def grams_of(words) -> F.Column:
    """Distinct 1- to 3-grams of an array of words."""

    def of(n):
        last = F.size(words) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def buckets_of(grams) -> F.Column:
    return F.array_distinct(F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def units_of(text) -> F.Column:
    """Lines, those of more than ``LONG_LINE`` words divided into sentences."""
    lines = F.split(text, "\n")
    return F.flatten(F.transform(lines, lambda x: F.when(F.size(F.split(x, " ")) > LONG_LINE, F.split(x, r"(?<=[.!?])\s+")).otherwise(F.array(x))))


def _flat(unit) -> F.Column:
    return F.trim(F.regexp_replace(unit, r"\s+", " "))


def joined_of(paragraph) -> F.Column:
    """Sentences of a paragraph of several lines, and pairs of neighbouring ones."""
    # a word broken at its hyphen is one word again
    sentences = F.split(_flat(F.regexp_replace(paragraph, r"(?<=\p{L}-)\n\s*", "")), r"(?<=[.!?]) ")
    both = _let(sentences, lambda s: F.array_distinct(F.concat(s, F.transform(s, lambda x, i: F.concat_ws(" ", x, F.get(s, i + 1))))))
    return F.when(paragraph.contains("\n"), both).otherwise(F.array().cast("array<string>"))


def paragraph_units(text) -> F.Column:
    """(unit, joined) of each paragraph that has an anchor word."""
    paragraphs = F.filter(F.split(F.regexp_replace(text, MARKS, ""), r"\n\s*\n"), lambda p: p.rlike(WRAPPED))

    def anchored(units):
        return F.filter(units, lambda u: u.rlike(ANCHORS))

    def marked(units, joined):
        return F.transform(units, lambda u: F.struct(u.alias("unit"), F.lit(joined).alias("joined")))

    def of(p):
        # a joined unit that is a line is that line
        return _let(anchored(units_of(p)), lambda lines: F.concat(marked(lines, False), marked(F.array_except(anchored(joined_of(p)), F.transform(lines, _flat)), True)))

    return F.transform(paragraphs, of)


def training_units(docs: DataFrame) -> DataFrame:
    """(label, variant, grams): varied templates, background units, and background units with licence words."""
    spark = docs.sparkSession
    sample = docs.where(F.length("text") > 0).select("text").orderBy(F.xxhash64("text")).limit(SAMPLE_DOCS)
    plain = sample.select(F.explode(units_of(F.col("text"))).alias("unit")).distinct()
    plain = plain.where(~F.col("unit").rlike(ANCHORS)).select(F.slice(words_of(F.col("unit")), 1, LONG_LINE).alias("extra")).where(F.size("extra") > 0)
    plain = plain.orderBy(F.xxhash64("extra")).limit(SAMPLE_UNITS)
    texts = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(f).alias("label"), F.lit(t).alias("text")) for f in FAMILIES[:-1] for t in TEMPLATES[f]))).alias("t")).select("t.*")
    varied = texts.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1)))).withColumn("all", words_of(F.col("text")))
    few = varied.withColumn("words", F.filter("all", lambda w, i: (F.col("variant") < 6) | (F.pmod(F.xxhash64("text", "variant", i), F.lit(10)) > 0)))
    # the k-th background unit lends words to every template's variant k
    lent = plain.withColumn("k", F.row_number().over(_one_window()) - 1)
    some = few.join(lent.where(F.col("k") < VARIANTS).withColumnRenamed("k", "variant"), "variant", "left")
    extra = F.coalesce("extra", F.array().cast("array<string>"))
    good = some.select("label", "variant", F.when(F.col("variant") % 3 == 2, F.concat(F.slice(extra, 1, 5), "words")).when(F.col("variant") % 3 == 1, F.concat("words", F.slice(extra, 1, 8))).otherwise(F.col("words")).alias("words"))
    hint = some.where(F.col("variant") % 2 == 1).select(F.lit(UNKNOWN).alias("label"), "variant", F.concat(F.slice(extra, 1, 12), F.filter("all", lambda w, i: F.pmod(F.xxhash64(w, "variant", i), F.lit(6)) == 0)).alias("words"))
    bare = lent.select(F.lit(UNKNOWN).alias("label"), (F.col("k") % VARIANTS).alias("variant"), F.col("extra").alias("words"))
    rows = good.unionByName(hint).unionByName(bare).where(F.size("words") > 0)
    return rows.select("label", "variant", grams_of(F.col("words")).alias("grams"))


def _one_window():
    from pyspark.sql import Window

    return Window.orderBy(F.xxhash64("extra"), F.col("extra"))


def _logits(buckets, weights, intercepts) -> F.Column:
    return F.aggregate(buckets, intercepts, lambda acc, b: F.zip_with(acc, F.element_at(weights, b + 1), lambda x, y: x + y))


def _softmax(logits, temperature) -> F.Column:
    scaled = _let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp((x - top) / F.lit(temperature))))
    return _let(scaled, lambda v: _let(F.aggregate(v, F.lit(0.0), lambda a, y: a + y), lambda total: F.transform(v, lambda x: x / total)))


def train(docs: DataFrame) -> dict:
    """Weights by bucket and family, intercepts, temperature and least probability."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    index = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("label")) - 1
    rows = cut(training_units(docs).select(index.cast("double").alias("y"), "variant", buckets_of(F.col("grams")).alias("buckets")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.array_contains("buckets", b).cast("double"))
    fitted = rows.where("variant % 4 <> 3").select("y", array_to_vector(dense).alias("x"))
    model = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, standardization=False).fit(fitted)
    weights = [[round(float(x), 5) for x in row] for row in model.coefficientMatrix.toArray().T]
    intercepts = [round(float(x), 5) for x in model.interceptVector.toArray()]
    # a family that no training row has (an empty table has no unknown units) is never predicted
    have = weights and len(intercepts)
    weights, intercepts = [[*r, *[0.0] * (len(FAMILIES) - have)] for r in weights], [*intercepts, *[-50.0] * (len(FAMILIES) - have)]
    made = {"weights": weights, "intercepts": intercepts, "temperature": 1.0, "least": 0.5}
    held = rows.where("variant % 4 = 3").withColumn("logits", _logits(F.col("buckets"), *_constants(made)))
    grid = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
    true = (F.col("y") + 1).cast("int")
    losses = held.agg(*(F.avg(-F.log(F.greatest(F.element_at(_softmax(F.col("logits"), t), true), F.lit(1e-9)))) for t in grid)).first()
    made["temperature"] = min(zip((x if x is not None else 9.0 for x in losses), grid, strict=True))[1]
    unknown = held.where(F.col("y") == len(FAMILIES) - 1).select(F.array_max(F.slice(_softmax(F.col("logits"), made["temperature"]), 1, len(FAMILIES) - 1)).alias("p"))
    made["least"] = max(0.5, round(unknown.agg(F.percentile("p", 0.99)).first()[0] or 0.0, 4))
    return made


def _constants(model: dict) -> tuple[F.Column, F.Column]:
    return F.from_json(F.lit(json.dumps(model["weights"])), "array<array<double>>"), F.from_json(F.lit(json.dumps(model["intercepts"])), "array<double>")


def template_grams(spark: SparkSession) -> list[dict]:
    """Families' places and n-grams of the templates."""
    texts = [(i, t) for i, f in enumerate(FAMILIES[:-1]) for t in TEMPLATES[f]]
    rows = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.lit(t).alias("t")) for i, t in texts))).alias("x"))
    return [{"f": r[0], "g": r[1]} for r in rows.select("x.f", grams_of(words_of(F.col("x.t")))).collect()]


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``licenses`` (units that stand: family, probability, share, unit), ``license`` and ``n_unconfirmed``."""
    names = free_names(docs, "licenses", "license", "n_unconfirmed", "license_units")
    found, best, unsure, work = names
    weights, intercepts = _constants(model)
    templates = F.from_json(F.lit(json.dumps(template_grams(docs.sparkSession))), "array<struct<f:int,g:array<string>>>")
    none = F.array().cast("array<array<struct<unit:string,joined:boolean>>>")
    family = F.array(*map(F.lit, FAMILIES))

    def shares(grams):
        """(share, family's place) by template."""
        return F.transform(templates, lambda t: F.struct((F.size(F.array_intersect(t["g"], grams)) / F.size(t["g"])).alias("share"), t["f"].alias("f")))

    def scored(unit):
        """The unit's probability, family, and share of that family's templates."""
        probabilities = _let(_logits(buckets_of(unit["grams"]), weights, intercepts), lambda z: _softmax(z, model["temperature"]))

        def of(p):
            f = (F.array_position(p, F.array_max(p)) - 1).cast("int")
            own = _let(f, lambda f: F.array_max(F.transform(F.filter(unit["shares"], lambda s: s["f"] == f), lambda s: s["share"])))
            return F.struct(F.coalesce(own, F.lit(0.0)).alias("share"), F.array_max(p).alias("probability"), F.element_at(family, f + 1).alias("family"))

        return _let(probabilities, of)

    # Step by step, so that each value is computed once. A unit stands only if some template gives it the share
    # that confirms a prediction, so the others, most of them, need no prediction: they are unknown.
    every = lambda body: F.transform(work, lambda units: F.transform(units, body))
    low = F.lower("text")
    may = reduce(or_, (F.contains(low, F.lit(x)) for x in STEMS))
    rows = docs.withColumn(work, F.when(may, F.when(F.col("text").rlike(WRAPPED), paragraph_units(F.col("text")))).otherwise(none))
    rows = rows.withColumn(work, F.coalesce(work, none))
    rows = rows.withColumn(work, every(lambda x: x.withField("grams", _let(words_of(x["unit"]), grams_of))))
    rows = rows.withColumn(work, every(lambda x: x.withField("shares", shares(x["grams"]))))
    nothing = F.struct(F.lit(0.0).alias("share"), F.lit(0.0).alias("probability"), F.lit(UNKNOWN).alias("family"))
    can = lambda x: F.array_max(x["shares"])["share"] >= LEAST_SHARE
    rows = rows.withColumn(work, every(lambda x: x.withField("s", F.when(can(x), scored(x)).otherwise(nothing))))
    rows = rows.withColumn(work, every(lambda x: F.struct(x["s"]["share"].alias("share"), x["s"]["probability"].alias("probability"), x["s"]["family"].alias("family"), x["unit"].alias("unit"), x["joined"].alias("joined"))))

    def stands(x):
        return (x["family"] != UNKNOWN) & (x["probability"] >= model["least"]) & (x["share"] >= LEAST_SHARE)

    def families(units):
        return F.transform(units, lambda x: x["family"])

    def confirmed(units):
        """The lines that stand, less the parts of a joined unit that is more like another family, and the best joined unit of each further family."""
        held = F.filter(units, lambda x: stands(x) & x["joined"])
        part = lambda x: F.exists(held, lambda y: (y["family"] != x["family"]) & (y["share"] > x["share"]) & F.contains(y["unit"], _flat(x["unit"])))
        lines = F.filter(units, lambda x: stands(x) & ~x["joined"] & ~part(x))
        more = F.reverse(F.array_sort(F.filter(held, lambda x: ~F.array_contains(families(lines), x["family"]))))
        return F.concat(lines, F.filter(more, lambda x, i: F.array_position(families(more), x["family"]) == i + 1))

    def unconfirmed(units):
        """The lines that neither stand nor lie in a unit that does."""
        held = F.filter(units, lambda x: stands(x) & x["joined"])
        return F.filter(units, lambda x: ~x["joined"] & ~stands(x) & ~F.exists(held, lambda y: F.contains(y["unit"], _flat(x["unit"]))))

    rows = rows.withColumn(unsure, F.coalesce(F.aggregate(work, F.lit(0), lambda n, units: n + F.size(unconfirmed(units))), F.lit(0)))
    rows = rows.withColumn(found, F.transform(F.flatten(F.transform(work, confirmed)), lambda x: x.dropFields("joined")))
    rows = rows.withColumn(found, F.coalesce(found, F.array().cast("array<struct<share:double,probability:double,family:string,unit:string>>")))
    kept = [c for c in rows.columns if c not in (found, unsure, work)]
    return rows.select(*(F.col(f"`{c}`") for c in kept), found, F.array_max(found)["family"].alias(best), unsure)


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, train(docs))
    top = F.array_max("licenses")
    return found.select(
        "doc_id",
        "license",
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"]))), ",").alias("families"),
        F.size("licenses").cast("long").alias("n_found"),
        F.col("n_unconfirmed").cast("long").alias("n_unconfirmed"),
        F.round(top["probability"], 6).alias("probability"),
        F.round(top["share"], 6).alias("template_share"),
    )
