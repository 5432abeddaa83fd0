"""Search, quality, licences, mixing and language model against brute force, with awkward rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import collision_search, compression_quality, language_model, licenses, mixing


def test_search_finds_what_brute_force_finds(spark):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((12, 24))
    x = centres[draw.integers(0, 12, 3000)] + 0.7 * draw.standard_normal((3000, 24))
    x *= draw.uniform(0.5, 2.0, (3000, 1))  # inner product and distance differ
    x[100:200] = x[100]  # many equal vectors
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    rows += [(5000, None, 1), (5001, [0.0] * 24, 1), (5002, [None] + [1.0] * 23, 1), (5003, [float("nan")] * 24, 1), (5004, [float("inf")] * 24, 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").repartition(4)
    found = collision_search.nearest_neighbours(df, F.col("vec_id") % 20 == 0, block_rows=700, query_rows=60).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r["query_id"], []).append(r)
    assert set(by_query) == set(range(0, 3000, 20))
    hits = 0
    for q, got in by_query.items():
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21))
        scores = (x * x[q]).sum(axis=1)
        assert all(math.isclose(r["score"], scores[r["vec_id"]], rel_tol=1e-12) for r in got)
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
        best = sorted((i for i in range(3000) if i != q), key=lambda i: (-scores[i], i))[:20]
        hits += len(set(best) & {r["vec_id"] for r in got})
    assert hits / (20 * len(by_query)) >= 0.95


def test_search_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(0, [1.0, 0.0], None), (1, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (2, [1.0, 1.0], 3)]
    df = spark.createDataFrame(rows, schema)
    got = collision_search.nearest_neighbours(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 1.0), (1, 0.5), (2, 0.5)]
    assert collision_search.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0
    assert collision_search.nearest_neighbours(df, F.lit(None).cast("boolean")).count() == 0


def test_search_among_vectors_of_the_commonest_length(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)] + [(9, [1.0, 2.0, 3.0]), (10, [1.0]), (11, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collision_search.nearest_neighbours(df, F.lit(True), wanted=4).collect()
    assert {r["query_id"] for r in got} == set(range(5)) == {r["vec_id"] for r in got}
    even = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0]), (2, [3.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert {(r["query_id"], r["vec_id"]) for r in collision_search.nearest_neighbours(even, F.lit(True)).collect()} == {(1, 3), (3, 1)}


def labelled(n=600):
    draw = random.Random(2)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(400)]
    texts, labels = [], []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(20, 400))]
        good = draw.random() < 0.7
        texts.append((i, " ".join(words) if good else " ".join(w + draw.choice(["$$", "&&&", "###"]) for w in words)))
        labels.append((i, int(good)))
    return texts, labels


def test_quality_on_held_out_rows(spark):
    texts, labels = labelled()
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = compression_quality.fit(df, marks.filter("doc_id % 5 <> 0"))
    scored = {r["doc_id"]: r["score"] for r in compression_quality.quality_scores(df, model).filter("doc_id % 5 = 0").collect()}
    assert np.mean([(scored[i] >= 0.5) == bool(q) for i, q in labels if i % 5 == 0]) > 0.97
    assert all(0 <= s <= 1 for s in scored.values())


def test_quality_of_awkward_rows(spark):
    rows = [(1, None, "s", 1.0), (2, "", None, None), (None, "x" * 200_000, "s", 2.0), (4, "fine text", "s", 3.0), (4, "fine text", "s", 3.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, score double")
    for marks in ([], [(4, 1, 0)], [(4, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 1)], [(9, 1, 1)]):
        given = spark.createDataFrame(marks, "doc_id long, quality int, text int")
        model = compression_quality.fit(df, given)
        got = compression_quality.quality_scores(df, model)
        assert got.columns == df.columns
        assert all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == len(rows)
        assert compression_quality.quality_scores(df.limit(0), model).count() == 0


@pytest.mark.parametrize("text, families", [
    ("First line.\nReleased under the MIT License.\nmore", ["MIT"]),
    ("Licensed under CC BY-NC 4.0.\r\n\r\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0", "CC-BY-NC"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL"]),
    ("© 2020 someone. This work is licensed under the GNU Lesser General Public License, version 2.1. Enjoy.", ["LGPL"]),
    ("SPDX-License-Identifier: BSD-3-Clause", ["BSD"]),
    ("You need a driving license to rent the car, and the license is shown at the desk.", []),
    ("All rights reserved. Copyright of the newspaper.", []),
    ("", []), (None, []), ("word " * 50000, []), ("gpl", []),
])
def test_license_lines(spark, text, families):
    df = spark.createDataFrame([(1, text, "x", 0.5)], "doc_id long, text string, family string, probability double")
    found = licenses.license_paragraphs(df).collect()
    assert sorted(r["family"] for r in found) == families
    assert all(r["row"]["family"] == "x" and 0.5 <= r["probability"] <= 1 for r in found)


WRAPPED = {
    "MIT": """Copyright (c) 2020 someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "LGPL": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "BSD": """Redistribution and use in source and
binary forms, with or without
modification, are permitted provided
that the following conditions are met:""",
}


def test_wrapped_licenses(spark):
    """Found once, as one paragraph of some lines; prose around them has none."""
    around = "Some words before.\n\n{}\n\nSome words after."
    texts = {(f, end): around.format(text).replace("\n", end) for f, text in WRAPPED.items() for end in ("\n", "\r\n")}
    rows = [(f, end, text) for (f, end), text in texts.items()]
    found = licenses.license_paragraphs(spark.createDataFrame(rows, "wrapped string, end string, text string")).collect()
    assert sorted((r["row"]["wrapped"], r["row"]["end"], r["family"]) for r in found) == sorted((f, end, f) for f, end, _ in rows)
    assert all(" ".join(r["paragraph"].split()) in " ".join(r["row"]["text"].split()) for r in found)


def sainte_lague(shares, seats):
    won = [0] * len(shares)
    for _ in range(seats):
        best = max(range(len(shares)), key=lambda i: (shares[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_apportionment_is_that_of_the_highest_quotients(spark):
    draw = random.Random(6)
    for n, seats in [(1, 7), (5, 0), (4, 3), (9, 100), (30, 11), (12, 1000)]:
        shares = [draw.choice([0, 1, 5, draw.randrange(1, 1000)]) for _ in range(n - 1)] + [17]
        rows = [("g", i, s, seats) for i, s in enumerate(shares)]
        df = spark.createDataFrame(rows, "g string, name int, share long, seats long")
        got = mixing.apportion(df, ["g"], ["name"], "share", "seats").orderBy("name").collect()
        assert [r["quota"] for r in got] == sainte_lague(shares, seats)


def filled(sizes, weights, most):
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weights) if i not in capped)
        target = [most * s if i in capped else rest * weights[i] / open_weight for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in capped and target[i] > most * sizes[i]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 50, 1, 900], [10], [0, 5, 5], [1, 2, 3, 4000, 5, 6, 7], [0, 0]])
def test_targets_stop_at_three_sizes(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    weights = [i % 3 + 1 for i in range(len(sizes))]
    expected = filled(sizes, weights, 3) if sum(sizes) else [0.0] * len(sizes)
    assert [got[n] for n in names] == pytest.approx(expected)


def test_small_sources_and_sources_at_their_cap(spark):
    """Sources of 1, 7 and 31 words beside a large one: each gives its target to a word."""
    rows, n = [], 0
    for source, sizes in (("a", [400] * 5), ("b", [1]), ("c", [3, 4]), ("d", [31]), ("e", [40, 0, 0]), (None, [9, 90])):
        for size in sizes:
            rows.append((n, "w " * size, source))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for shard_rows in (2, 2000):
        found = mixing.mix(df, shard_rows=shard_rows).groupBy("source_size", "target", "row.source").agg(F.sum("taken").alias("taken")).collect()
        assert all(abs(r["taken"] - r["target"]) <= 1 for r in found) and len(found) == 6
        assert sum(r["taken"] for r in found) == pytest.approx(sum(r["source_size"] for r in found), abs=6)
        kept = mixing.mixed_rows(mixing.mix(df, shard_rows=shard_rows), length_column=None)
        assert {r["source"] for r in kept.select("source").distinct().collect()} == {"a", "b", "c", "d", "e", None}


def test_mixing(spark):
    draw = random.Random(8)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(draw.randrange(0, 120))), draw.choice(["a", "b", "c", None]), 0, "z") for i in range(500)]
    rows += [(None, None, "a", 0, "z"), (900, "", None, 0, "z"), (901, "t " * 3000, "d", 0, "z"), (902, "\t \n", "a", 0, "z"), (3, rows[3][1], "a", 0, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, size string").repartition(4)
    mixture = mixing.mix(df, shard_rows=40).collect()
    assert len(mixture) == len(rows)
    again = mixing.mix(df.repartition(7), shard_rows=40).collect()
    key = lambda r: (r["row"]["doc_id"] or -1, r["taken"], r["size"])
    assert sorted(map(key, mixture)) == sorted(map(key, again))
    taken, target = Counter(), {}
    for r in mixture:
        assert r["size"] == len((r["row"]["text"] or "").split()) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["row"]["source"]] += r["taken"]
        target[r["row"]["source"]] = r["target"]
    for source, words in target.items():
        assert abs(taken[source] - words) <= 32 * 8
    out = mixing.mixed_rows(mixing.mix(df, shard_rows=40)).collect()
    words = Counter()
    originals = {}
    for i, text, *_ in rows:
        originals.setdefault(i, []).append(text or "")
    for r in out:
        assert any(r["text"].strip() in o for o in originals[r["doc_id"]]) and r["n_chars"] == len(r["text"]) and r["size"] == "z"
        words[r["doc_id"]] += len(r["text"].split())
    per_document = Counter()
    for r in mixture:
        per_document[r["row"]["doc_id"]] += r["taken"]
    assert +words == +per_document
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_rows(mixing.mix(df.limit(0))).count() == 0


def brute_scores(texts, train, prior, order=2):
    """The model's formula, word by word."""
    words = [["<s>", *(t or "").encode().lower().split(), None] for t in texts]
    seen = Counter()
    for w, used in zip(words, train, strict=True):
        for i in range(len(w) if used else 0):
            seen.update(tuple(w[i - k + 1 : i + 1]) for k in range(1, order + 1) if k <= i + 1)
    known = {gram[0] for gram in seen if len(gram) == 1} - {"<s>"}
    n, v = sum(seen[(w,)] for w in known), len(known)

    def p(h, w):
        if not h:
            return (seen[(w,)] + 0.5) / (n + 0.5 * (v + 1))
        return (seen[(*h, w)] + prior * p(h[1:], w)) / (seen[h] + prior)

    base = [sum(math.log10(p((), w)) for w in x[1:]) for x in words]
    full = [sum(math.log10(p(tuple(x[max(0, i - order + 1) : i]), x[i])) for i in range(1, len(x))) for x in words]
    return n, [len(x) - 1 for x in words], [sum(w in known for w in x[1:]) for x in words], base, full


def _corpus():
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["the", "The", "of", "cat", "é", f"r{draw.randrange(50)}"]) for _ in range(draw.randrange(40))) for _ in range(120)]
    texts += [None, "", " \t", "unseenword " * 400, texts[0], "the cat of the r1 " * 300]
    return texts, [zlib.crc32(str(i).encode()) % 5 != 1 for i in range(len(texts))]


@pytest.mark.parametrize("order, block_bytes, segment", [(2, 300, 512), (3, 8_000_000, 512), (3, 300, 7), (1, 8_000_000, 5), (4, 2_000, 3)])
def test_language_scores(spark, monkeypatch, order, block_bytes, segment):
    monkeypatch.setattr(language_model, "RANGE_KEYS", 200)
    texts, train = _corpus()
    df = spark.createDataFrame([(i, t, "k", 0.0) for i, t in enumerate(texts)], "doc_id long, text string, block string, score double").repartition(3)
    learned = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    scored = language_model.language_scores(df, learned, block_bytes=block_bytes, order=order, segment_tokens=segment)
    n, tokens, known, base, full = brute_scores(texts, train, 64.0, order)
    rows = sorted(scored.collect(), key=lambda r: r["row"]["doc_id"])
    assert [r["n_tokens"] for r in rows] == tokens and [r["n_known"] for r in rows] == known
    assert {r["train_tokens"] for r in rows} == {n} and [r["in_training"] for r in rows] == train
    assert [r["base_score"] for r in rows] == pytest.approx(base) and [r["score"] for r in rows] == pytest.approx(full)


def test_automaton_has_the_states_and_arcs_of_the_model():
    texts = pa.array(["a b a c", "a a b", "c"])
    block = language_model.Block(*language_model.Block.coded(texts), np.ones(3, bool), 3)
    totals = {k: counts for k, _, counts in block.asked()}
    made = language_model.Automaton(block, totals, totals[1] / totals[1].sum(), 3, 2.0)
    # the root, the beginning, a, b, c, the end; and the pairs <s>a <s>c aa ab ac ba b$ c$
    assert len(made.fail_to) == 2 + 4 + 8 and made.fail_to[:2].tolist() == [0, 0]
    assert (made.fail_to[2:6] == 0).all() and set(made.fail_to[6:].tolist()) <= set(range(2, 6))
    assert len(made.arc_keys) - 1 == len(totals[2]) + len(totals[3]) and (np.diff(made.arc_keys) > 0).all()


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_after_a_context_add_up(spark, order):
    """Every known word after a context, and the unknown one, whose share a new word would get."""
    texts, ends = ["a b a c", "a a b", "c"], ["a", "b", "c", "zzz", ""]
    given = [*texts, *[f"b a {w}" for w in ends], "b a"]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    scored = language_model.language_scores(df, F.col("doc_id") < 3, prior=3.0, order=order)
    rows = {r["row"]["doc_id"]: r["score"] for r in scored.collect()}
    *_, full = brute_scores(given, [True] * 3 + [False] * 6, 3.0, order)
    assert [rows[k] for k in sorted(rows)] == pytest.approx(full)
    made = language_model.Block(*language_model.Block.coded(pa.array(texts)), np.ones(3, bool), order)
    totals = {k: counts for k, _, counts in made.asked()}
    n, v = int(totals[1].sum()), len(totals[1])
    machine = language_model.Automaton(made, totals, (totals[1] + 0.5) / (n + 0.5 * (v + 1)), 3, 3.0)
    contexts = {machine.ROOT, machine.BEGIN, *(machine.arc_keys[:-1] // v).tolist()}
    assert len(contexts) > 4
    for state in contexts:
        _, weights = machine.step(np.full(v, state), np.arange(v))
        unknown, at = math.log10(0.5 / (n + 0.5 * (v + 1))), state
        while at != machine.ROOT:
            unknown, at = unknown + machine.fail_weight[at], machine.fail_to[at]
        assert (10**weights).sum() + 10**unknown == pytest.approx(1)


def test_language_model_refuses_odd_parameters(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for odd in ({"order": 0}, {"prior": 0.0}, {"segment_tokens": 0}):
        with pytest.raises(ValueError, match="order"):
            language_model.language_scores(df, F.lit(True), **odd)


def test_language_scores_without_rows_or_training(spark):
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert language_model.language_scores(df.limit(0), F.lit(True)).count() == 0
    rows = language_model.language_scores(df, F.lit(None).cast("boolean")).collect()
    assert {r["train_tokens"] for r in rows} == {0} and all(r["n_known"] == 0 and r["score"] == 0 for r in rows)
