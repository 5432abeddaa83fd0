"""Licence scan by a trained paragraph classifier, in DataFrame operations only.

The classifier is a multinomial logistic regression over word 1- and 2-grams, trained on the notices
below, on shortened copies of them, and on sentences that use the same words without granting a licence (the
class ``unknown``). A paragraph goes to the classifier if it holds one of a few cues (without one it is
unknown by definition). Its prediction counts if the calibrated probability is high enough, and if the paragraph then
holds most of the words of some notice of the predicted family.

A paragraph is a line, or some lines in a row that a hard-wrapped notice may fill: from every line on, lines are joined
until they hold as many words as the longest notice, or a line without words ends the block. Joined lines must hold
most of a notice's pairs of words, too. Of overlapping paragraphs that hold a notice the shortest stands.
"""

import json
import re

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
CUES = (
    "licen", "copyright", "spdx", "creative commons", "cc by", "cc-by", "cc0", "public domain", "gpl",
    "warrant", "redistribut", "permission is hereby", "unencumbered",
)
# Short notices as authors put them into their works, by family.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This software is distributed under the terms of the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it under the terms of the GNU General Public License.",
        "Released under the GPL, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright with a CC0 public domain dedication.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    ),
}
OTHERS = (
    "All rights reserved.",
    "Copyright by the author, all rights reserved.",
    "The driver had to show a license at the office.",
    "Her fishing licence was renewed in May under the new version of the rules.",
    "A license is needed to sell wine in this state.",
    "The general public was invited to the release of the report.",
    "The warranty of the car was granted for two years.",
    "The library lent the work to the public.",
    "The judge spoke about copyright and about public law.",
    "The software license costs a fee for each user, see the price list.",
    "The commons met under the creative lead of the author.",
    "Unauthorized redistribution is prohibited.",
    "They waited for permission to use the source of the river.",
    "The programme was released under the name of the club.",
    "The apache tribe lives in the state.",
    "He studied at MIT in the nineties.",
)


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]++", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _grams(words: Column) -> Column:
    pairs = F.transform(
        F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)),
    )
    return F.array_distinct(F.concat(words, pairs))


NOTICE_WORDS = max(len(re.findall("[a-z0-9]+", text.lower())) for texts in NOTICES.values() for text in texts)


def _training(spark: SparkSession) -> DataFrame:
    """Notices and other sentences: whole (0), without the last word (1) and without the first (2)."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    rows += [(UNKNOWN, text) for text in OTHERS]
    values = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in rows])
    whole = spark.range(1).select(F.explode(values).alias("row")).select("row.*", _words(F.col("row.text")).alias("words"))
    n = F.size("words")
    forms = F.array(
        F.col("words"), F.slice("words", 1, F.greatest(n - 1, F.lit(2))), F.slice("words", F.when(n > 3, 2).otherwise(1), n)
    )
    return whole.select("family", F.posexplode(forms).alias("form", "words")).withColumn("grams", _grams(F.col("words")))


class LicenseModel:
    """Weights of the n-grams and the intercept per family, as literals of bounded size."""

    temperature = 1.0

    def __init__(self, spark: SparkSession, ridge: float = 0.002):
        self.families = [UNKNOWN, *NOTICES]
        number = F.array_position(F.array(*[F.lit(f) for f in self.families]), F.col("family")) - 1
        rows = _training(spark).withColumn("number", number.cast("double")).coalesce(1)
        fitted = Pipeline(
            stages=[
                CountVectorizer(inputCol="grams", outputCol="features", binary=True),
                LogisticRegression(
                    labelCol="number", family="multinomial", regParam=ridge, maxIter=100, standardization=False
                ),
            ]
        ).fit(rows.filter("form < 2"))
        grams, regression = fitted.stages[0].vocabulary, fitted.stages[1]
        weights = regression.coefficientMatrix.toArray()
        self.intercepts = [float(x) for x in regression.interceptVector.toArray()]
        self.weights = {gram: [float(w) for w in weights[:, i]] for i, gram in enumerate(grams)}
        self.temperature = self._calibrated(rows.filter("form = 2"))

    def _calibrated(self, unseen: DataFrame) -> float:
        """The temperature under which sentences that were not trained on are likeliest."""
        grid = F.array(*[F.lit(0.25 * 1.25**k) for k in range(16)])
        logits = unseen.select("number", self.logits(F.col("grams")).alias("logits"), F.explode(grid).alias("t"))
        right = F.element_at("logits", (F.col("number") + 1).cast("int")) / F.col("t")
        loss = F.log(F.aggregate("logits", F.lit(0.0), lambda total, x: total + F.exp(x / F.col("t")))) - right
        return logits.groupBy("t").agg(F.avg(loss).alias("loss")).orderBy("loss", "t").first()["t"]

    def logits(self, grams: Column) -> Column:
        table = F.from_json(F.lit(json.dumps(self.weights)), "map<string,array<double>>")  # folded into one literal
        zero = F.array(*[F.lit(v) for v in self.intercepts])
        known = F.filter(grams, lambda g: F.map_contains_key(table, g))
        summed = F.aggregate(known, zero, lambda total, g: F.zip_with(total, table[g], lambda a, b: a + b))
        return F.transform(summed, lambda x: x / self.temperature)


def paragraphs(df: DataFrame, text_column: str, carry: list[str]) -> DataFrame:
    """``row``, ``document`` (a number of this run), ``number`` of the first line (from 0), ``lines`` and ``paragraph``: the
    lines, and the joined lines of a block, that hold a cue."""
    text = F.col(f"`{text_column}`")

    def cued(column: Column) -> Column:
        found = F.lit(False)
        for cue in CUES:
            found = found | F.contains(column, F.lit(cue))
        return found

    def reach(i: Column) -> Column:
        """How many lines from line ``i`` on a notice may fill; 1 for a line without words."""
        grow = lambda n, words: F.struct(n.alias("n"), words.alias("words"))
        longest = F.aggregate(
            F.slice("line", i + 1, NOTICE_WORDS),
            grow(F.lit(0), F.lit(0)),
            lambda held, line: F.when(held["words"] >= NOTICE_WORDS, held)
            .when(F.size(_words(line)) == 0, grow(held["n"], F.lit(NOTICE_WORDS)))
            .otherwise(grow(held["n"] + 1, held["words"] + F.size(_words(line)))),
        )
        return F.greatest(longest["n"], F.lit(1))

    def spans(i: Column) -> Column:
        joined = lambda n: F.array_join(F.slice("line", i + 1, n), " ")
        one = lambda n: F.struct(i.alias("number"), n.alias("lines"), joined(n).alias("paragraph"))
        return F.filter(F.transform(F.sequence(F.lit(1), reach(i)), one), lambda span: cued(F.lower(span["paragraph"])))

    kept = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text.alias("text")).filter(cued(F.lower("text")))
    # An exploded array of one element is evaluated once, where a projection would be merged into its users.
    numbered = kept.withColumn("document", F.monotonically_increasing_id())
    split = numbered.select("row", "document", F.explode(F.array(F.split("text", r"\r\n?|\n"))).alias("line"))
    found = split.select(
        "row",
        "document",
        F.explode(F.flatten(F.transform("line", lambda _, i: spans(i)))).alias("span"),
    )
    return found.select("row", "document", "span.*")


def _apart(found: DataFrame) -> DataFrame:
    """Of paragraphs that share lines of a document, the shortest, then the most similar, then the first."""
    order = F.struct("lines", (-F.col("similarity")).alias("unlike"), "number", "paragraph", "family", "probability", "similarity")
    spans = F.array_sort(F.collect_list(order))
    by_document = found.groupBy("document").agg(F.first("row").alias("row"), spans.alias("spans"))
    meets = lambda a, b: (a["number"] < b["number"] + b["lines"]) & (b["number"] < a["number"] + a["lines"])
    apart = F.aggregate(
        "spans",
        F.filter("spans", lambda _: F.lit(False)),
        lambda taken, span: F.when(F.exists(taken, lambda t: meets(t, span)), taken).otherwise(F.concat(taken, F.array(span))),
    )
    return by_document.select("row", F.explode(apart).alias("span")).select("row", "span.*")


def license_paragraphs(
    df: DataFrame,
    text_column: str = "text",
    carry: list[str] | None = None,
    sure: float = 0.5,
    covered: float = 0.7,
) -> DataFrame:
    """Paragraphs with a licence notice: ``row`` (all columns of ``df``, or those of ``carry``), ``number`` of the first line,
    ``paragraph`` (a line, or joined lines), ``family``, ``probability`` and ``similarity`` (share of the words of the nearest
    notice of that family; of its words and pairs of words for joined lines).

    A paragraph is reported if the family's probability is ``sure`` or more and the similarity ``covered`` or more. Null
    and empty texts have none. Long lines are read whole.
    """
    model = LicenseModel(df.sparkSession)
    found = paragraphs(df, text_column, carry or df.columns).withColumn("words", _words(F.col("paragraph")))
    every = F.array(*[F.array_distinct(_words(F.lit(t))) for texts in NOTICES.values() for t in texts])
    share = lambda wanted, held: F.size(F.array_intersect(wanted, held)) / F.size(wanted)
    near = found.filter(F.exists(every, lambda notice: share(notice, F.col("words")) >= covered))
    # An exploded array of one element is evaluated once, where a projection would be merged into its users.
    scored = near.withColumn("logits", F.explode(F.array(model.logits(_grams(F.col("words"))))))
    top = F.array_max("logits")
    whole = F.aggregate("logits", F.lit(0.0), lambda total, x: total + F.exp(x - F.array_max("logits")))
    families = F.array(*[F.lit(f) for f in model.families])
    named = scored.withColumn("probability", 1 / whole).withColumn(
        "family", F.element_at(families, F.array_position("logits", top).cast("int"))
    )

    def nearest(form, held: Column) -> Column:
        notices = [(F.lit(f), F.array(*[form(_words(F.lit(t))) for t in texts])) for f, texts in NOTICES.items()]
        of_family = F.create_map(*[x for pair in notices for x in pair])[F.col("family")]
        return F.array_max(F.transform(of_family, lambda notice: share(notice, held)))

    alone, joined = nearest(F.array_distinct, F.col("words")), nearest(_grams, _grams(F.col("words")))
    sure_of = (
        named.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= sure))
        .withColumn("similarity", F.when(F.col("lines") == 1, alone).otherwise(joined))
        .filter(F.col("similarity") >= covered)
    )
    return _apart(sure_of).select("row", "number", "paragraph", "family", "probability", "similarity")
