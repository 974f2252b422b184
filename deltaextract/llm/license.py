"""Licence scans: a trained paragraph classifier, confirmed by templates; in built-in functions only.

A paragraph is a line, or a licence wrapped over several: lines without a break (a line without words) that together have ``SIMILAR`` of the words of a template, and no more lines than the
template can take when it starts anywhere in the first. The first line names it, and of such runs of a family the shortest count, once where they overlap. Its features are the words and pairs of neighbouring words that it has. A multinomial logistic regression over them knows
the licence families and a class for everything else. It is trained on the templates, on their variants with a word left out, on sentences that only talk about
licences, and on a bounded sample of the paragraphs at hand (``NEGATIVES``). The least probability that a family needs is calibrated: on held-out
paragraphs of the last class, no more than ``FALSE_SHARE`` pass it. A prediction is confirmed if the paragraph has at least ``SIMILAR`` of the words
of one of the family's templates.

A confirmed paragraph lacks few of a template's words, so it has one of any large enough subset of them. These cue words are looked for
first, by one pattern, and only texts and lines with one are taken apart. Nothing is lost by it, and scanning shuffles nothing.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEGATIVES, FALSE_SHARE, SIMILAR = 2_000, 0.001, 0.7
UNKNOWN = "unknown"

# Sentences by which licences are named, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl-3.0": ("This program is licensed under the GNU Affero General Public License, version 3.",),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0."),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "lgpl-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited."),
}
# Sentences about licences that grant nothing.
TALK = (
    "The committee discussed which license would suit the public library.",
    "A driving license is required to use this version of the car.",
    "All members reserved their rights to a general hearing under the law.",
    "He studied at the institute and released a work on permission and copyright.",
    "The software is free to try, and source files are kept under version control.",
    "Commons and public forms are licensed by the city.",
)


@dataclass(frozen=True)
class LicenseModel:
    classes: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    least: float


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    # A one-element array names what is used often, so that it is computed once.
    return F.transform(F.array(value), body)[0]


def words_of(paragraph: Column) -> Column:
    """Lower-cased runs of letters, digits, dots and signs inside; dots and signs at the ends do not count."""
    return F.filter(F.split(F.regexp_replace(F.lower(paragraph), r"[.+-]+(?=[^a-z0-9]|$)|(?<![a-z0-9])[.+-]+", " "), r"[^a-z0-9.+-]+"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    # The pairs: each word with its successor, for all words but the last.
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def _examples(spark: SparkSession) -> DataFrame:
    """Templates and sentences, and each with one word left out."""
    rows = [(c, t) for c, texts in TEMPLATES.items() for t in texts] + [(UNKNOWN, t) for t in TALK]
    full = spark.createDataFrame(rows, "family string, paragraph string").withColumn("words", words_of(F.col("paragraph")))
    gap = full.where(F.size("words") > 3).withColumn("gap", F.explode(F.sequence(F.lit(0), F.size("words") - 1)))
    less = gap.select("family", F.filter("words", lambda w, i: i != F.col("gap")).alias("words"))
    return full.select("family", "words").union(less)


def fit(docs: DataFrame, *, text: str = "text", negatives: int = NEGATIVES) -> LicenseModel:
    """The classifier. It reads a sample of documents, in order of a hash, for ``negatives`` paragraphs of three words or more; paragraphs like a template are not taken."""
    spark = docs.sparkSession
    share = max(1, docs.count() // negatives)
    value = F.col(f"`{text}`")
    # Lines of a wrapped licence are no examples of the last class.
    unlike = _let(_wrapped(value), lambda runs: F.filter(F.split(value, "\n"), lambda _, i: ~F.exists(runs, lambda r: (r["paragraph"] <= i) & (i <= r["last"]))))
    sampled = docs.where(value.isNotNull() & (F.pmod(F.xxhash64(value), F.lit(share)) == 0)).select(F.explode(unlike).alias("paragraph"))
    known = F.greatest(*[_likeness(F.col("words"), t) for texts in TEMPLATES.values() for t in texts])
    others = (
        sampled.distinct()
        .orderBy(F.xxhash64("paragraph"), "paragraph")
        .limit(negatives)
        .withColumn("words", words_of(F.col("paragraph")))
        .where((F.size("words") >= 3) & (known < SIMILAR))
        .select(F.lit(UNKNOWN).alias("family"), "words")
    )
    examples = _examples(spark).union(others).withColumn("grams", grams_of(F.col("words"))).withColumn("held", F.pmod(F.xxhash64("words"), F.lit(4)) == 0).coalesce(1).cache()
    classes = tuple(sorted([*TEMPLATES, UNKNOWN]))
    numbered = examples.withColumn("label", (F.array_position(F.lit(list(classes)), F.col("family")) - 1).cast("double"))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(_examples(spark).withColumn("grams", grams_of(F.col("words"))))
    ready = vectors.transform(numbered)
    # Few examples of a family against many of the last class: each class has the same weight.
    counts = {r["family"]: r["count"] for r in examples.groupBy("family").count().collect()}
    weighted = ready.withColumn("weight", F.lit(1.0) / F.element_at(F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, float(n))]), F.col("family")))
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, weightCol="weight", maxIter=40).fit(weighted)
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: tuple(matrix[:, k].tolist()) for k, g in enumerate(vectors.vocabulary)}
    intercepts = tuple(fitted.interceptVector.toArray().tolist())
    # At most ``negatives`` paragraphs: their best family's probability, beside the last class.
    held = examples.where("held and family = 'unknown'").select("grams").collect()
    examples.unpersist()
    unknown = classes.index(UNKNOWN)
    passed = []
    for (grams,) in held:
        odds = [math.exp(x + sum(weights[g][c] for g in grams if g in weights)) for c, x in enumerate(intercepts)]
        passed.append(max(x for c, x in enumerate(odds) if c != unknown) / sum(odds))
    passed.sort()
    least = passed[min(len(passed) - 1, int(len(passed) * (1 - FALSE_SHARE)))] if passed else 0.0
    return LicenseModel(classes, intercepts, weights, max(0.5, least))


def _all_words(template: str) -> list[str]:
    """The words of a template, as ``words_of`` has them."""
    kept = "".join(c if c.isascii() and (c.isalnum() or c in ".+-") else " " for c in template.lower())
    return [w.strip(".+-") for w in kept.split() if w.strip(".+-")]


def _split_words(template: str) -> list[str]:
    return list(dict.fromkeys(_all_words(template)))


def _likeness(words: Column, template: str) -> Column:
    own = _split_words(template)
    return F.size(F.array_intersect(F.lit(own), words)) / F.lit(float(len(own)))


def cue_words() -> list[str]:
    """Of each template, so many of its longest words that a paragraph with ``SIMILAR`` of all its words has one of them."""
    cues = set()
    for texts in TEMPLATES.values():
        for t in texts:
            own = sorted(_split_words(t), key=lambda w: (-len(w), w))
            need = -(-round(SIMILAR * 1000) * len(own) // 1000)
            cues.update(own[: len(own) - need + 1])
    return sorted(cues)


def _fits(inner: Column, template: str) -> Column:
    """Whether a template that starts in the first line of a run, which has ``inner`` words between its first and last line, can reach the last."""
    return inner < len(_all_words(template)) - 1


def _wrapped(value: Column) -> Column:
    """Runs of two or more lines that are like a template: first line ``paragraph``, ``last`` line, ``inner`` words between them, ``words``."""
    longest = max(len(_all_words(t)) for texts in TEMPLATES.values() for t in texts)
    cues = F.lit(cue_words())

    def from_line(w: Column, cued: Column, i: Column) -> Column:
        ends = F.transform(F.slice(w, i + 2, F.lit(longest)), lambda _, k: i + 1 + k)
        runs = F.transform(ends, lambda e: F.struct(i.alias("paragraph"), e.alias("last"), F.size(F.flatten(F.slice(w, i + 2, e - i - 1))).alias("inner")))
        whole = F.filter(runs, lambda r: (r["inner"] < longest - 1) & F.forall(F.slice(w, i + 1, r["last"] - i + 1), lambda x: F.size(x) > 0))
        return F.when(F.array_contains(F.slice(cued, i + 1, F.lit(longest + 1)), True), whole).otherwise(F.slice(whole, 1, 0))

    def like(r: Column) -> Column:
        ways = [_fits(r["inner"], t) & (_likeness(r["words"], t) >= SIMILAR) for texts in TEMPLATES.values() for t in texts]
        return F.arrays_overlap(r["words"], cues) & functools.reduce(lambda a, b: a | b, ways)

    def all_runs(w: Column) -> Column:
        runs = _let(F.transform(w, lambda x: F.arrays_overlap(x, cues)), lambda cued: F.flatten(F.transform(w, lambda _, i: from_line(w, cued, i))))
        return F.filter(F.transform(runs, lambda r: r.withField("words", F.flatten(F.slice(w, r["paragraph"] + 1, r["last"] - r["paragraph"] + 1)))), like)

    return _let(F.transform(F.split(value, "\n"), words_of), all_runs)


def _probabilities(model: LicenseModel, words: Column) -> Column:
    grams = list(model.weights)
    # Constants as JSON: one literal instead of thousands of expressions.
    table = F.from_json(F.lit(json.dumps(model.weights)), "map<string,array<double>>")
    hits = F.array_intersect(grams_of(words), F.from_json(F.lit(json.dumps(grams)), "array<string>"))
    sums = F.aggregate(hits, F.lit(list(model.intercepts)), lambda acc, g: F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b))
    # One-element arrays name what is used twice, so that it is computed once.
    odds = F.array(F.transform(sums, lambda s: F.exp(s)))
    totals = F.transform(odds, lambda o: F.struct(o.alias("odds"), F.aggregate(o, F.lit(0.0), lambda a, x: a + x).alias("total")))
    return F.transform(totals, lambda t: F.transform(t["odds"], lambda x: x / t["total"]))[0]


def scan(docs: DataFrame, model: LicenseModel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``n_paragraphs``, ``licenses`` (paragraph from 0, family, probability, likeness, confirmed) and ``families`` (confirmed, sorted).

    ``licenses`` holds each line with a cue word whose family is not the last class and at least as probable as calibrated, and confirmed wrapped licences, by their first line; ``n_paragraphs`` counts lines. Null and empty texts have no paragraphs. Rows are
    neither dropped nor merged, and columns of ``docs`` with the names of results are replaced.
    """
    value = F.col(f"`{text}`")
    pattern = r"(?i)(?<![a-z0-9])(" + "|".join(w.replace(".", r"\.").replace("+", r"\+") for w in cue_words()) + r")(?![a-z0-9])"
    cue = value.rlike(pattern)
    lines = F.transform(F.split(value, "\n"), lambda p, i: F.struct(i.alias("paragraph"), p.alias("line")))
    near = F.filter(lines, lambda s: s["line"].rlike(pattern))
    # A single line has no words between its first and last one, and any template fits it.
    single = F.transform(near, lambda s: F.struct(s["paragraph"].alias("paragraph"), s["paragraph"].alias("last"), F.lit(-1).alias("inner"), words_of(s["line"]).alias("words")))
    taken = F.concat(single, _wrapped(value))
    rated = F.transform(taken, lambda s: s.withField("p", _probabilities(model, s["words"])))
    classes = F.lit(list(model.classes))

    def best(s: Column) -> Column:
        top = F.array_max(s["p"])
        return F.struct(s["paragraph"].alias("paragraph"), s["last"].alias("last"), s["inner"].alias("inner"), s["words"].alias("words"), F.element_at(classes, F.array_position(s["p"], top).cast("int")).alias("family"), top.alias("probability"))

    sure = F.filter(F.transform(rated, best), lambda s: (s["family"] != UNKNOWN) & (s["probability"] >= model.least))

    def confirmed(s: Column) -> Column:
        like = F.greatest(*[F.when((s["family"] == c) & _fits(s["inner"], t), _likeness(s["words"], t)).otherwise(0.0) for c, texts in TEMPLATES.items() for t in texts])
        return F.struct(s["paragraph"].alias("paragraph"), s["last"].alias("last"), s["family"].alias("family"), F.round(s["probability"], 6).alias("probability"), F.round(like, 6).alias("likeness"), (like >= SIMILAR).alias("confirmed"))

    def shortest(found: Column) -> Column:
        # Confirmed runs that hold no other of their family; lines stay as they are.
        def holds(s: Column, o: Column) -> Column:
            return o["confirmed"] & (o["family"] == s["family"]) & (o["paragraph"] >= s["paragraph"]) & (o["last"] <= s["last"]) & ((o["paragraph"] > s["paragraph"]) | (o["last"] < s["last"]))

        return F.filter(found, lambda s: (s["paragraph"] == s["last"]) | (s["confirmed"] & ~F.exists(found, lambda o: holds(s, o))))

    def once(found: Column) -> Column:
        def met(s: Column, o: Column) -> Column:
            return o["confirmed"] & (o["family"] == s["family"]) & (o["last"] >= s["paragraph"]) & (o["paragraph"] <= s["last"])

        # One-line ones first: a run that meets one of its family, or an earlier run, is the same licence.
        ordered = F.concat(F.filter(found, lambda s: s["paragraph"] == s["last"]), F.filter(found, lambda s: s["paragraph"] < s["last"]))
        return F.array_sort(F.aggregate(ordered, F.slice(found, 1, 0), lambda acc, s: F.when((s["paragraph"] < s["last"]) & F.exists(acc, lambda o: met(s, o)), acc).otherwise(F.concat(acc, F.array(s)))))

    def listed(found: Column) -> Column:
        return F.transform(found, lambda s: F.struct(s["paragraph"].alias("paragraph"), s["family"].alias("family"), s["probability"].alias("probability"), s["likeness"].alias("likeness"), s["confirmed"].alias("confirmed")))

    kind = "array<struct<paragraph:int,family:string,probability:double,likeness:double,confirmed:boolean>>"
    out = docs.withColumns(
        {
            "n_paragraphs": F.when(value.isNull() | (value == ""), 0).otherwise(F.size(F.split(value, "\n"))),
            "licenses": F.when(cue, listed(_let(_let(F.transform(sure, confirmed), shortest), once)).cast(kind)).otherwise(F.array().cast(kind)),
        }
    )
    return out.withColumn("families", F.array_sort(F.array_distinct(F.transform(F.filter("licenses", lambda s: s["confirmed"]), lambda s: s["family"]))))
