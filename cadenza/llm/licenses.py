"""Licence scans: a word n-gram logistic regression over paragraphs, trained and applied in DataFrame operations.

Training examples are the template notices below, whole and in halves, and ordinary paragraphs of the corpus, which
teach the class ``none``.  Features are the words and word pairs of a paragraph, weighted to unit length.  The softmax
regression is fitted by gradient steps that are joins and aggregations.  One temperature calibrates the probabilities:
it must make examples held out of training likely for their family, and, with a family's examples left out, that
family's notices unlikely for every other one.  A paragraph whose best family stays below ``MIN_PROBABILITY`` is of
unknown licence, and so is one that no template of the predicted family confirms: by shared n-grams, and by shared
n-grams that only this family's templates have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bound
from ..session import cut_lineage
from .common import first_by_hash, pick, small

STEPS = 14
RATE = 4.0
MAX_ORDINARY = 400  # bound of the sample of ordinary paragraphs
MIN_PROBABILITY = 0.5
MIN_SHARED = 0.6  # of the n-grams of the shorter of paragraph and template
MIN_GRAMS = 3
MIN_OWN = 0.5  # of the n-grams of one family alone, in paragraph or template, whichever has fewer
UNKNOWN = "unknown"

# Families and wordings of their notices.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 3."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
    ("public-domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    ("proprietary", "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."),
)
FAMILIES = tuple(dict.fromkeys(f for f, _ in TEMPLATES))
CLASSES = (*FAMILIES, "none")
# A paragraph with one of these is reported even if nothing else is like a notice; others are judged by
# their score and wording alone.
CUES = ("licen", "copyright", "permission", "permitted", "redistribut", "warrant", "public domain", "rights reserved",
        "creative commons", "open source", "free software", "waived")

_WORD = r"[a-z0-9]+"


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _has_cue(lower: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(lower, F.lit(c)) for c in CUES))


def _grams(lower: Column) -> Column:
    """Distinct words and word pairs as 64-bit hashes."""
    words = F.regexp_extract_all(lower, F.lit(_WORD), 0)
    pairs = F.transform(F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))).alias("b")),
                        lambda x: F.when(x["b"].isNotNull(), F.xxhash64(x["a"], x["b"])))
    return F.array_distinct(F.array_compact(F.concat(F.transform(words, lambda w: F.xxhash64(w)), pairs)))


def templates(spark: SparkSession) -> DataFrame:
    """(template, family, lower): the fixed notices."""
    rows = F.array(*(F.struct(F.lit(k).alias("template"), F.lit(f).alias("family"), F.lit(t).alias("text")) for k, (f, t) in enumerate(TEMPLATES)))
    return spark.range(1).select(F.inline(rows)).select("template", "family", _lower(F.col("text")).alias("lower"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, lower) of the lines of ``docs`` (doc_id, text)."""
    lines = docs.select("doc_id", F.posexplode(F.split(_lower(F.col("text")), "\n")).alias("paragraph", "lower"))
    return lines.where(F.trim("lower") != "")


def examples(spark: SparkSession, docs: DataFrame, max_ordinary: int) -> DataFrame:
    """(example, family, lower, held): notices whole and in halves, and ordinary paragraphs; ``held`` calibrate."""
    half = F.floor(F.length("lower") / 2).cast("int")
    parts = F.array("lower", F.substring("lower", F.lit(1), half), F.substring("lower", half + 1, F.length("lower")))
    notices = templates(spark).select("template", "family", F.posexplode(parts).alias("part", "lower"))
    notices = notices.select(F.concat_ws("-", F.lit("t"), "template", "part").alias("example"), "family", "lower", (F.col("part") == 2).alias("held"))
    # One line of each of a bounded number of documents, a hash deciding which.
    some = docs.where("text is not null").where(~_has_cue(_lower(F.col("text"))))
    some = some.select("doc_id", F.substring_index(_lower(F.col("text")), "\n", 1).alias("lower")).where(F.trim("lower") != "")
    some = cut_lineage(some.select("lower").distinct())  # one common first line is one example
    some = first_by_hash(some, max_ordinary, "lower")
    ordinary = some.select(F.concat(F.lit("o"), F.xxhash64("lower").cast("string")).alias("example"), F.lit("none").alias("family"), "lower",
                           (F.pmod(F.xxhash64("lower"), F.lit(4)) == 0).alias("held"))
    return notices.unionByName(ordinary.dropDuplicates(["example"])).where(F.size(_grams(F.col("lower"))) > 0)


def _features(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, gram, v): unit length by row."""
    # The length is taken before the list is opened: a long one would go along with each of its n-grams.
    grams = rows.select(*keys, _grams(F.col("lower")).alias("g")).where("size(g) > 0")
    return grams.select(*keys, "g", (1 / F.sqrt(F.size("g"))).alias("v")).select(*keys, F.explode("g").alias("gram"), "v")


def _logits(features: DataFrame, weights: DataFrame, *keys: str) -> DataFrame:
    """(keys, z): class scores; a row without known feature has zeros."""
    joined = features.join(weights, "gram", "left")
    sums = [F.coalesce(F.sum(F.col("v") * F.col("w")[k]), F.lit(0.0)) for k in range(len(CLASSES))]
    return joined.groupBy(*keys).agg(F.array(*sums).alias("z"))


def _softmax(z: Column, temperature: float | Column = 1.0) -> Column:
    powers = F.transform(z, lambda x: F.exp((x - F.array_max(z)) / temperature))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def fit(spark: SparkSession, docs: DataFrame, max_ordinary: int = MAX_ORDINARY, steps: int = STEPS) -> tuple[DataFrame, float]:
    """(weights (gram, w), temperature).  Classes weigh the same, whatever their number of examples.

    The weights are sums of the examples' features, so the steps keep one coefficient for each example and class and
    read the examples' products; all tables here are as small as the bounded sample, and are broadcast for that.
    """
    rows = cut_lineage(examples(spark, docs, max_ordinary).repartition(4, "example"))
    features = cut_lineage(_features(rows.where("not held"), "example"))
    other = features.select(F.col("example").alias("other"), "gram", F.col("v").alias("u"))
    products = cut_lineage(features.join(other, "gram").groupBy("example", "other").agg(F.sum(F.col("v") * F.col("u")).alias("k")))
    sizes = rows.where("not held").groupBy("family").agg((RATE / F.count(F.lit(1))).alias("rate"))
    target = F.array(*(F.when(F.col("family") == c, 1.0).otherwise(0.0) for c in CLASSES))
    state = rows.where("not held").join(F.broadcast(sizes), "family").select("example", "rate", target.alias("y"))
    state = cut_lineage(state.withColumn("a", F.array_repeat(F.lit(0.0), len(CLASSES))))
    for _ in range(steps):
        known = F.broadcast(state.select(F.col("example").alias("other"), "a"))
        sums = [F.sum(F.col("k") * F.col("a")[k]) for k in range(len(CLASSES))]
        z = products.join(known, "other").groupBy("example").agg(F.array(*sums).alias("z"))
        push = F.zip_with(_softmax(F.col("z")), "y", lambda p, y: F.col("rate") * (y - p))
        state = cut_lineage(z.join(F.broadcast(state), "example").select("example", "rate", "y", F.zip_with("a", push, lambda a, p: a + p).alias("a")))
    sums = [F.sum(F.col("v") * F.col("a")[k]) for k in range(len(CLASSES))]
    weights = cut_lineage(features.join(F.broadcast(state.select("example", "a")), "example").groupBy("gram").agg(F.array(*sums).alias("w")))
    return weights, _temperature(rows, features, state)


def _temperature(rows: DataFrame, features: DataFrame, state: DataFrame) -> float:
    """The temperature with the least loss over the held examples: in their family, and with the family left out."""
    trained = features.join(F.broadcast(state.select("example", "a")), "example").join(
        F.broadcast(rows.select("example", F.col("family").alias("other"))), "example").select("gram", F.col("v").alias("u"), "a", "other")
    held = rows.where("held").select("example", "family")
    met = _features(rows.where("held"), "example", "family").join(trained, "gram")
    pull = [F.col("v") * F.col("u") * F.col("a")[k] for k in range(len(CLASSES))]
    outside = F.col("other") != F.col("family")
    met = met.groupBy("example", "family").agg(F.array(*map(F.sum, pull)).alias("z"), F.array(*(F.sum(F.when(outside, p).otherwise(0.0)) for p in pull)).alias("out"))
    zeros = F.array(*(F.lit(0.0) for _ in CLASSES))
    held = held.join(met, ["example", "family"], "left").select("family", F.coalesce("z", zeros).alias("z"), F.coalesce("out", zeros).alias("out"))
    right = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("family")).cast("int")
    # Left out, a family is no class either.
    held = held.select("family", "z", right.alias("right"), F.transform("out", lambda x, k: F.when(k + 1 == right, F.lit(-1e6)).otherwise(x)).alias("out"))
    # A row for each example and temperature: sixteen columns of these expressions would be one huge compiled method.
    least, t = F.lit(1e-9), F.col("t")
    tried = held.select("*", F.explode(F.array(*(F.lit(0.02 * 1.4**k) for k in range(16)))).alias("t"))
    inside = -F.log(F.greatest(F.element_at(_softmax(F.col("z"), t), F.col("right")), least))
    sure = F.array_max(F.slice(_softmax(F.col("out"), t), 1, len(FAMILIES)))
    loss = inside + F.when(F.col("family") == "none", 0.0).otherwise(-F.log(F.greatest(1 - sure, least)))
    best = tried.groupBy("t").agg(F.round(F.avg(loss), 9).alias("loss")).orderBy("loss", "t").first()
    return best["t"] if best else 1.0


def scan(df: DataFrame, weights: DataFrame, temperature: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, probability, shared) of each paragraph that may be a licence notice.

    ``family`` is ``unknown`` where the calibrated probability or the comparison with templates does not suffice.
    A paragraph without a cue is one too if its family is confirmed, or likely and worded by ``MIN_GRAMS`` n-grams that
    only this family's templates have.  Every paragraph's n-grams are compared with the templates'; one that has too few
    for either is not scored, since no score would make it a notice.
    """
    spark = df.sparkSession
    docs = pick(df, doc_id=id_col, text=text_col)
    # The templates are a fixed list: a few hundred n-grams.  Own ones stand in the templates of one family only.
    known = templates(spark).select("template", "family", F.explode(_grams(F.col("lower"))).alias("gram"))
    # Pieces of addresses are no wording of a family.
    worded = templates(spark).select("family", F.explode(_grams(F.regexp_replace("lower", r"https?://\S+", " "))).alias("gram"))
    shared = worded.groupBy("gram").agg((F.count_distinct("family") == 1).alias("own"))
    known = known.join(shared, "gram", "left").withColumn("own", F.coalesce("own", F.lit(False)))
    sizes = known.groupBy("template").agg(F.count(F.lit(1)).alias("n_template"), F.count_if("own").alias("own_template"))
    shortest = sizes.agg(F.min("n_template")).first()[0]
    listed: dict[int, list] = {}
    for r in known.select("template", "gram", "own").collect():
        listed.setdefault(r.template, []).append(r)
    every = F.lit(sorted({r.gram for rows in listed.values() for r in rows}))
    single = F.lit([r.gram for r in shared.where("own").collect()])

    def worded_as(rows: list, hits: Column, n: Column, own_n: Column) -> Column:
        """Whether one template could confirm a paragraph: the tests on ``worded`` and ``shared`` below, from its n-grams."""
        mine = [r.gram for r in rows if r.own]
        own = F.size(F.array_intersect(hits, F.lit(mine))) if mine else F.lit(0)
        met = F.size(F.array_intersect(hits, F.lit([r.gram for r in rows])))
        near = (own > 0) & (own >= MIN_OWN * F.least(own_n, F.lit(len(mine))) - 1e-6)
        return (own >= MIN_GRAMS) | (near & (met >= F.greatest(F.lit(float(MIN_GRAMS)), MIN_SHARED * F.least(n, F.lit(len(rows))) - 1e-6)))

    def like(g: Column) -> Column:
        # Two cheap counts rule out most paragraphs; the others are compared with each template.
        own, hits = F.size(F.array_intersect(g, single)), F.array_intersect(g, every)
        few = F.greatest(F.lit(float(MIN_GRAMS)), MIN_SHARED * F.least(F.size(g), F.lit(shortest)) - 1e-6)

        def compared(c: Column) -> Column:
            maybe = (c["own"] >= MIN_GRAMS) | ((c["own"] > 0) & (F.size(c["hits"]) >= c["few"]))
            return maybe & reduce(lambda a, b: a | b, (worded_as(rows, c["hits"], c["n"], c["own"]) for rows in listed.values()))

        return bound(F.struct(own.alias("own"), hits.alias("hits"), F.size(g).alias("n"), few.alias("few")), compared)

    judge = _has_cue(F.col("lower")) | bound(_grams(F.col("lower")), like)
    notices = cut_lineage(paragraphs(docs).where(judge).distinct())
    # Equal notices are scored once, under a number: a paragraph may be a whole long text.
    texts = cut_lineage(notices.select("lower").distinct().withColumn("text", F.monotonically_increasing_id()))
    z = _logits(_features(texts, "text"), small(weights, 100_000), "text")
    p = F.slice(_softmax(F.col("z"), temperature), 1, len(FAMILIES))
    # Stored, or the filter below would repeat the scores' expressions in the plan.
    best = cut_lineage(z.select("text", F.array_max(p).alias("probability"), F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position(p, F.array_max(p)).cast("int")).alias("guess")))
    known = F.broadcast(known.join(sizes, "template"))
    mine = texts.select("text", _grams(F.col("lower")).alias("g")).select("text", "g", F.size("g").alias("n_mine"))
    mine = mine.select("text", "n_mine", F.explode("g").alias("gram"))
    both = mine.join(known, "gram").groupBy("text", "family", "template").agg(
        (F.count(F.lit(1)) / F.least(F.first("n_mine"), F.first("n_template"))).alias("shared"), F.count(F.lit(1)).alias("n"),
        F.count_if("own").alias("own"), F.first("own_template").alias("own_template"))
    owned = mine.join(F.broadcast(shared.where("own").select("gram")), "gram").groupBy(F.col("text").alias("_text")).agg(F.count(F.lit(1)).alias("own_mine"))
    both = both.join(owned, F.col("text") == F.col("_text"), "left")
    own = F.col("own") / F.least("own_mine", "own_template") >= MIN_OWN
    both = both.groupBy("text", F.col("family").alias("guess")).agg(
        F.max(F.when((F.col("n") >= MIN_GRAMS) & own, F.col("shared"))).alias("shared"), F.max("own").alias("worded"))
    judged = best.join(both, ["text", "guess"], "left").withColumn("shared", F.coalesce("shared", F.lit(0.0)))
    likely = F.col("probability") >= MIN_PROBABILITY
    sure = likely & (F.col("shared") >= MIN_SHARED)
    judged = judged.join(texts, "text").where(_has_cue(F.col("lower")) | sure | (likely & (F.col("worded") >= MIN_GRAMS)))
    judged = judged.select("lower", F.when(sure, F.col("guess")).otherwise(UNKNOWN).alias("family"), "probability", "shared")
    return notices.join(judged, "lower").select("doc_id", "paragraph", "family", "probability", "shared")


def licences(df: DataFrame, weights: DataFrame, temperature: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, licence, probability, n_notices, families.

    ``licence`` is the family of the surest confirmed paragraph, ``unknown`` where paragraphs look like notices but
    none is confirmed, ``none`` otherwise; ``families`` are the confirmed ones in order.  A null text has none.  Rows that share an id are
    one document and get the same result; a null id is an id; an empty table gives no rows; other columns are not read.
    """
    found = scan(df, weights, temperature, id_col, text_col)
    sure = F.col("family") != UNKNOWN
    by_doc = found.groupBy(F.struct("doc_id").alias("key")).agg(
        F.max_by("family", F.when(sure, F.struct("probability", "family"))).alias("sure_family"),
        F.coalesce(F.max(F.when(sure, F.col("probability"))), F.max("probability")).alias("probability"),
        F.count(F.when(sure, 1)).alias("n_notices"),
        F.array_sort(F.collect_set(F.when(sure, F.col("family")))).alias("families"))
    docs = df.select(F.struct(F.col(f"`{id_col}`").alias("doc_id")).alias("key"))
    return docs.join(by_doc, "key", "left").select(
        F.col("key.doc_id").alias("doc_id"),
        F.when(F.col("n_notices").isNull(), "none").otherwise(F.coalesce("sure_family", F.lit(UNKNOWN))).alias("licence"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
        F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"))
