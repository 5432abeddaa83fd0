"""Exact and near duplicates against brute force, with awkward rows."""

import hashlib
import math
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from reviewloom.llm import exact_dedup, near_duplicates, textbytes
from reviewloom.llm.components import connected


def test_fingerprints_compose():
    printer = exact_dedup.Fingerprinter(chunk=16)
    draw = random.Random(1)
    for _ in range(50):
        left, right = (bytes(draw.randrange(256) for _ in range(draw.randrange(90))) for _ in range(2))
        whole, a, b = (
            tuple(int(x) for x in printer(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0])
            for t in (left + right, left, right)
        )
        assert printer.combine(a, b, len(right)) == whole
    one = b"same bytes" * 9
    many = np.frombuffer(b"xy" + one + one, np.uint8)
    prints = printer(many, np.array([0, 2, 2 + len(one), 2 + 2 * len(one), 2 + 2 * len(one)]))
    assert (prints[1] == prints[2]).all() and (prints[3] == 0).all()


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (2,)])
def test_exact_duplicates(spark, primes):
    """With one tiny prime nearly all fingerprints of a length collide, and the comparison decides."""
    long = "lorem ipsum " * 20000
    texts = ["a", "b", "a", None, "", " ", long, long + "x", long, "c", "d", "e", "a", "b", long[:-1] + "y", "A"]
    rows = [(i, t, i, True, "z") for i, t in enumerate(texts)] + [(7, "seven", 1, None, None)] * 3 + [(None, "b", 1, None, None)]
    schema = "doc_id long, text string, group_size int, kept boolean, print string"
    df = spark.createDataFrame(rows, schema).repartition(4)
    found = exact_dedup.exact_duplicates(df, primes=primes, bases=exact_dedup.BASES[: len(primes)]).collect()
    assert len(found) == len(rows)
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t or "", []).append(i)
    stays = {}
    for r in found:
        text, ids = r["row"]["text"] or "", by_text[r["row"]["text"] or ""]
        assert r["keep_id"] == max(i for i in ids if i is not None)
        assert r["group_size"] == len(ids)
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        if r["kept"]:
            stays.setdefault(text, []).append(r["row"]["doc_id"])
            assert r["row"]["doc_id"] == r["keep_id"]
    assert {t: len(x) for t, x in stays.items()} == dict.fromkeys(by_text, 1)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert exact_dedup.exact_duplicates(df).count() == 0
    assert near_duplicates.near_duplicates(df).count() == 0


def test_word_hashes_are_those_of_the_words():
    texts = ["The cat\tsat", "the  CAT\n", None, "", "  ", "Ä é x the"]
    hashes, first = textbytes.word_hashes(pa.array(texts))
    split = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in split]
    by_word = {}
    for word, h in zip((w for words in split for w in words), hashes.tolist(), strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def swapped_texts(a, b, length=2048):
    """Two words whose running polynomials modulo 2**64 are equal for every odd base: the parity of the bits of the places."""
    parity = [bin(i).count("1") % 2 for i in range(length)]
    return "".join(a if p else b for p in parity), "".join(b if p else a for p in parity)


def test_rearranged_bytes_have_other_hashes():
    one, other = swapped_texts("a", "b")
    spans = [one, other, one[:40], other[:40], one[:64], other[:64], one[:65], other[:65], "a", "b", "", "\x00", "\x00\x00", "ab", "ba"]
    data = np.frombuffer("".join(spans).encode(), np.uint8)
    ends = np.cumsum([len(x) for x in spans])
    starts = ends - [len(x) for x in spans]
    hashes = textbytes.span_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(spans))
    shifted = textbytes.span_hashes(np.concatenate([data[:5], data]), starts + 5, ends + 5)
    assert (shifted == hashes).all() and (textbytes.span_hashes(data, starts, ends, 7) != hashes).all()
    codes, distinct = textbytes.coded(textbytes.span_values(data, starts, ends))
    assert [distinct[c].as_py().decode() for c in codes] == spans


def test_texts_of_rearranged_bytes_are_not_linked(spark):
    rows = list(enumerate(swapped_texts("a", "b")))
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {r["component_id"] for r in found} == {0, 1}


def test_many_texts_just_below_the_threshold(spark):
    """2,000 texts around one, 0.75 to 0.79 similar to each other: few links or none, and none are lost."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(2000):
        words = list(base)
        for at in rng.choice(400, (9 + i % 7), replace=False):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r["row"]["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(df, words=2).collect()}
    assert found == brute_by_matrix(rows)


def brute_by_matrix(rows):
    vocabulary = {}
    sets = [np.array([vocabulary.setdefault(g, len(vocabulary)) for g in set(zip(t.split(), t.split()[1:], strict=False))]) for _, t in rows]
    sizes = np.array([len(x) for x in sets])
    holders = [[] for _ in vocabulary]
    for i, x in enumerate(sets):
        for g in x.tolist():
            holders[g].append(i)
    label = np.arange(len(rows))
    for i, x in enumerate(sets):
        both = np.bincount(np.concatenate([holders[g] for g in x.tolist()]), minlength=len(rows))
        for j in np.flatnonzero(100 * both >= 80 * (sizes + sizes[i] - both)).tolist():
            if label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label[label == old] = new
    return {doc_id: rows[label[i]][0] for i, (doc_id, _) in enumerate(rows)}


def test_links_of_a_block_join_parts_and_no_more():
    rng = np.random.default_rng(2)
    base = rng.choice(10**6, 60, replace=False)
    sets = []
    for i in range(120):
        kept = base[rng.random(60) < 0.93] if i % 2 else rng.choice(10**6, 55)
        sets.append(np.unique(kept).astype(np.uint64))
    size, bits = np.array([len(x) for x in sets]), np.zeros(120, np.int64)
    starts, stops = np.arange(1, 121), np.full(120, 120)
    a, b = near_duplicates.joining_links(np.arange(120), size, bits, sets, starts, stops, 80)
    parent = list(range(120))
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        both = len(np.intersect1d(sets[x], sets[y]))
        assert 100 * both >= 80 * (size[x] + size[y] - both) and root(x) != root(y)
        parent[root(x)] = root(y)
    for x in range(120):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            assert 100 * both < 80 * (size[x] + size[y] - both) or root(x) == root(y)


def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
        sets.append(grams)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return [len(s) for s in sets], [min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(rows))]


def altered(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    draw = random.Random(words)
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "ONE"), (5, "one two"), (6, "One\ttwo"), (8, "one two three")]
    number = 10
    for _ in range(25):  # chains of alterations, so that ends of a component are not similar
        base = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(30, 200))]
        for _ in range(draw.randrange(1, 8)):
            rows.append((number, " ".join(base)))
            base = altered(draw, base, draw.randrange(0, 4)).split()
            number += 1
    rows += [(number, "x " * 30000), (number + 1, "y x " * 20000), (number + 2, " ".join(f"u{i}" for i in range(30000)))]
    rows.append((number + 3, rows[-1][1] + " tail"))
    draw.shuffle(rows)
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, node string, size int").repartition(5)
    found = near_duplicates.near_duplicates(df, words=words)
    sizes, components = brute_components(rows, words, 80)
    expected = sorted(
        (i, n, i if n == 0 else c, i == (i if n == 0 else c)) for (i, _), n, c in zip(rows, sizes, components, strict=True)
    )
    got = sorted((r["row"]["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect())
    assert got == expected


def test_near_duplicates_without_ids_and_repeated(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (9, text + " x"), (4, text), (4, text), (None, "alone here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["row"]["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_duplicates.near_duplicates(df).collect())
    assert got == sorted(
        [("None", "4", False), ("9", "4", False), ("4", "4", True), ("4", "4", True), ("None", "None", True), ("None", "None", True)]
    )


def test_one_row_of_a_group_stays_in_the_pipeline(spark):
    """Also where ids are null or repeated."""
    text, other = (" ".join(f"{w}{i}" for i in range(50)) for w in "uv")
    rows = [(None, text), (None, text + " x"), (4, other), (4, other + " y"), (9, other + " z"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], (r["text"] or "")[:1]) for r in corpus_pipeline.near_copies(spark, df, "").collect()]
    assert sorted(kept, key=str) == sorted([(None, "u"), (4, "v"), (None, ""), (None, "")], key=str)


def test_a_large_group_of_near_copies(spark):
    """Hundreds of distinct copies end as one component, and pairs stay few."""
    draw = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, altered(draw, base, 3)) for i in range(400)] + [(1000 + i, altered(draw, base, 60)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["row"]["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(df, words=2).collect()}
    _, components = brute_components(rows, 2, 80)
    assert got == {i: c for (i, _), c in zip(rows, components, strict=True)}


def test_the_test_of_bits_loses_no_pair_at_the_border():
    """At similarity 0.8 a bit differs with a probability of 0.1; fewer than 2 in a million pairs differ in more than may."""
    n = near_duplicates.SYMBOLS
    lost = sum(math.comb(n, k) * 0.1**k * 0.9 ** (n - k) for k in range(near_duplicates.FAR_IN_BLOCK + 1, n + 1))
    assert lost < 2e-6


def test_components(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(300, 360)] + [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected(df).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {x: root(x) for x in list(parent)}
    assert connected(df.limit(0)).count() == 0
