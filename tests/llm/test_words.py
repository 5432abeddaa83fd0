"""Phrase mining, toxicity and ranked search: against brute force, and on awkward tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import phrases, queries, ranked_search, toxicity

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string"


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# ---- phrases --------------------------------------------------------------------------------


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text))]


def counted(rows, longest):
    counts = Counter()
    for _, text, lang in rows:
        for words in pieces(text):
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang if lang is not None else "und", tuple(words[i : i + size])] += 1
    return counts


def brute_collocations(rows, longest, least, percent, top):
    counts = counted(rows, longest)
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    found = {}
    for (lang, gram), a in candidates.items():
        inside = [
            f for (other, g), f in candidates.items()
            if other == lang and len(g) > len(gram) and any(g[i : i + len(gram)] == gram for i in range(len(g)))
        ]
        if any(100 * f >= percent * a for f in inside):
            continue
        cuts = []
        for k in range(1, len(gram)):
            left, right = counts[lang, gram[:k]], counts[lang, gram[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(gram).encode(), left, right))
    out = []
    for lang, listed in found.items():
        n = sum(f for (other, g), f in counts.items() if other == lang and len(g) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def wordy_rows(seed, rows, words):
    rng = np.random.default_rng(seed)
    vocabulary = np.array(["a", "B", "c", "dé", "é", "ß9", "x.y", "q", "ZZ", "\x00", "the", "of"])
    joins = np.array([" ", " ", " ", "\t", "  ", ", ", "\n", "! "])
    out = []
    for i in range(rows):
        chosen = rng.choice(vocabulary, words, p=np.arange(12, 0, -1) / 78)
        text = "".join(w + j for w, j in zip(chosen, rng.choice(joins, words), strict=True))
        out.append((i, text, [None, "und", "en", "fr"][i % 4]))
    return out


@pytest.mark.parametrize(("longest", "shard_bytes", "percent", "top"), [(3, 400, 50, 2000), (2, 8_000_000, 50, 7), (4, 900, 80, 2000)])
def test_collocations_equal_brute_force(spark, longest, shard_bytes, percent, top):
    rows = wordy_rows(longest, 60, 40) + [(100, None, "en"), (101, "", None), (102, "  ., ", "fr"), (103, "a B c " * 3000, "en")]
    rows += [(104, "one two three four", "es")] * 12
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(3).withColumn("rank", F.lit("clash"))
    found = phrases.collocations(df, max_words=longest, percent=percent, top=top, shard_bytes=shard_bytes)
    assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, longest, 10, percent, top)


def test_index_extends_to_both_sides():
    """The interval of every phrase has the size of its count, whichever way it was reached."""
    text = np.concatenate([[0], np.random.default_rng(3).integers(0, 5, 400)])
    index = phrases.ShardIndex(text, 5, 3)
    forward, reverse, size = index.single()
    counts = Counter(zip(text.tolist(), text[1:].tolist(), text[2:].tolist(), strict=False))
    pairs = Counter(zip(text.tolist(), text[1:].tolist(), strict=False))
    parent, symbol, *middle = index.right(forward, reverse, size)
    first, second = parent + 1, symbol
    assert {(a, b): n for a, b, n in zip(first.tolist(), second.tolist(), middle[2].tolist(), strict=True)} == {
        key: n for key, n in pairs.items() if 0 not in key
    }
    for extend, gram in ((index.left, lambda p, s: (s, first[p], second[p])), (index.right, lambda p, s: (first[p], second[p], s))):
        parent, symbol, _, _, sizes = extend(*middle)
        found = {tuple(map(int, gram(p, s))): n for p, s, n in zip(parent, symbol, sizes.tolist(), strict=True)}
        assert found == {key: n for key, n in counts.items() if 0 not in key}


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, [big + 5, big], [big + 7, big + 1])], "a long, heads array<long>, tails array<long>")
    cut = df.select(phrases.lowest_cut(F.col("a"), F.col("heads"), F.col("tails")).alias("c")).first()["c"]
    scores = [1000000 * big * big // (x * y) for x, y in ((big + 5, big + 7), (big, big + 1))]
    assert (cut["score"], cut["k"]) == min((s, k) for k, s in enumerate(scores, 1))


def test_no_phrases(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, "a b", "en")], DOCUMENTS)).collect() == []


# ---- ranked search --------------------------------------------------------------------------


def brute_search(rows, items, k):
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
    texts = [(doc_id, Counter(cut(text))) for doc_id, text, *_ in rows]
    sizes = [sum(t.values()) for _, t in texts]
    n_texts, n_words = sum(s > 0 for s in sizes), sum(sizes)
    held = Counter(term for _, t in texts for term in t)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, terms), n in zip(texts, sizes, strict=True):
            score = 0
            for term in cut(text):
                if terms[term]:
                    m = 100 - 75 + 75 * n * n_texts // n_words
                    weight = math.floor(1000 * math.log((2 * n_texts + 2) / (2 * held[term] + 1)))
                    score += weight * (1000000000 * terms[term] // (1000 * terms[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, unnamed, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, None if unnamed else doc_id, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("k", "block_bytes", "pass_bytes"), [(10, 500, 8_000_000), (3, 100, 60), (1, 8_000_000, 8_000_000)])
def test_search_equals_brute_force(spark, k, block_bytes, pass_bytes):
    rows = [row[:2] for row in wordy_rows(9, 80, 15)]
    rows += [(5, "the of"), (6, None), (None, "the ZZ q"), (7, ""), (3, "ß9 ß9 É"), (8, "the " * 4000 + "q")] + [(9, "q é copy")] * 14
    items = [(1, "the ZZ the q"), (2, None), (1, "É ß9-é"), (None, "copy of it"), (4, "nowhere"), (5, "a b c dé é q zz the of copy 9")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("score", F.lit("clash"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    found = ranked_search.ranked_search(df, asked, k, block_bytes=block_bytes, pass_bytes=pass_bytes)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_search(rows, items, k)


def test_accumulators_are_limited():
    """Once ten texts share the rare term, the frequent one opens no more accumulators; scores stay exact."""
    texts = pa.array(["rare rare common"] * 12 + ["common"] * 500)
    group = ranked_search.Queries([0], ["rare common"])
    block = ranked_search.Postings.of(texts, group.vocabulary)
    by_term = dict(zip(group.vocabulary.to_pylist(), range(2), strict=True))
    weights = np.zeros(2, np.int64)
    weights[by_term[b"rare"]], weights[by_term[b"common"]] = 3000, 2
    ranking = ranked_search.Ranking(group, weights, 512, 536, 10)
    ranking.add(block, list(range(512)))
    assert ranking.opened == 12 and len(ranking.best[0]) == 10
    ranking = ranked_search.Ranking(group, weights, 512, 536, 13)
    ranking.add(block, list(range(512)))
    assert ranking.opened == 512 and len(ranking.best[0]) == 13


def test_search_without_rows(spark):
    rows, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.ranked_search(rows, items).collect() == []
    assert ranked_search.ranked_search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).collect() == []


# ---- toxicity -------------------------------------------------------------------------------


def insulting(spark, n=240):
    rng = np.random.default_rng(5)
    words = np.array(["the", "on", "réa", "stone", "wind", "tree", "blue"])
    rows = []
    for i in range(n):
        chosen = rng.choice(words, 30).tolist()
        if i % 4 == 0:
            chosen[int(rng.integers(30))] = rng.choice(["Grumbler", "grumbling", "öftig"])
        rows.append((i, " ".join(chosen), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_texts_not_learned_from(spark):
    df = insulting(spark)
    model = toxicity.fit(df.drop("toxic"), df.filter("doc_id < 160").select("doc_id", "toxic"))
    scored = toxicity.toxicity_scores(df, model).filter("doc_id >= 160").collect()
    assert {(r["toxic"], r["score"] >= 0.7) for r in scored} == {(0, False), (1, True)}


def test_toxicity_scores_equal_a_plain_version(spark):
    """Grams by slicing strings, distinct by a set, weights looked up one by one."""
    df = insulting(spark)
    model = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"))
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    texts = ["", None, "grumbler", "a\x00\nb\tÖFTIG öftig 😀", "wind " * 200, "x" * 70000 + " grumbling"]

    def bucket(gram):
        h = ord(gram[0]) + 1
        for c in gram[1:]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> shift)) * factor % 2**64
        return (h ^ (h >> 31)) >> (64 - model.bits)

    expected = []
    for text in texts:
        padded = " " + re.sub(r"[\x09-\x0D]", " ", lower(text)) + " "
        buckets = {bucket(padded[i : i + n]) for n in (3, 4, 5, 6) for i in range(len(padded) - n + 1)}
        expected.append(1 / (1 + math.exp(-(model.intercept + sum(weight.get(b, 0.0) for b in buckets)))))
    assert model.score(pa.array(texts, pa.string())) == pytest.approx(expected, rel=1e-9)


def test_ratios_and_regression():
    counts = np.array([[1.0, 8.0, 0.0], [6.0, 8.0, 0.0]])
    p, q = (counts[1] + 1) / (counts[1] + 1).sum(), (counts[0] + 1) / (counts[0] + 1).sum()
    assert toxicity.ratios(counts) == pytest.approx(np.log(p / q))
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.3) * rng.normal(size=6)
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ np.array([3.0, -2, 0, 1, 0, 2]) - 0.5)))).astype(float)
    weights = rng.random(300) + 0.5
    row, feature = np.nonzero(x)
    intercept, found = toxicity.logistic(row, feature, x[row, feature], y, weights, 6, 0.7)
    p = 1 / (1 + np.exp(-(intercept + x @ found)))
    assert x.T @ (weights * (p - y)) + 0.7 * found == pytest.approx(np.zeros(6), abs=1e-4)  # the gradient is zero there


def test_toxicity_on_awkward_tables(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "x", 1), (3, "y", 1), (3, "y", 1)], "doc_id long, text string, label int")
    for labels in ([], [(1, None), (None, 1)], [(3, 1)], [(1, 0), (3, 1), (3, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        rows = toxicity.toxicity_scores(df, toxicity.fit(df, table)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["text"] == "y"}) == 1
    model = toxicity.fit(df.limit(0), table)
    assert toxicity.toxicity_scores(df.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="score"):
        toxicity.toxicity_scores(df.withColumn("score", F.lit(1)), model)


def test_query_rows_of_toxicity(spark):
    rows = queries.QUERIES["op12_toxicity"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
