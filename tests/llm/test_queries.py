"""The registered queries on the small tables: against DuckDB, or against brute force; and the pipeline."""

import os
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from reviewloom.llm import near_duplicates, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(database):
    return database.execute("SELECT doc_id, coalesce(text, '') AS text, source FROM documents ORDER BY doc_id").df()


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.ORACLES) <= set(queries.QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, database, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = database.execute(queries.ORACLES[name])
    order = [column[0] for column in cursor.description]
    assert sorted(order) == columns
    theirs = Counter(tuple(row[order.index(c)] for c in columns) for row in cursor.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == theirs


def test_search_recall(spark, database):
    table = database.execute("SELECT vec_id, embedding FROM embeddings").df()
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding.tolist()).astype(float)
    found = {}
    for r in queries.QUERIES["op1_collision_search"](spark, SF_DIR).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(found) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, got in found.items():
        scores = (vectors * vectors[ids == q][0]).sum(axis=1)
        best = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))[:20]
        hits += len(got & {ids[i] for i in best})
    assert hits / sum(map(len, found.values())) >= 0.9


def test_quality_rows(spark, documents):
    rows = queries.QUERIES["op2_compression_quality"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == documents.doc_id.tolist()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_near_duplicate_components(spark, documents):
    sets = []
    for text in documents.text:
        w = text.encode().lower().split()
        sets.append(set(zip(w, w[1:], strict=False)) if len(w) > 1 else {tuple(w)} if w else set())
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    expected = {d: (len(s), documents.doc_id[x]) for d, s, x in zip(documents.doc_id, sets, label, strict=True)}
    rows = queries.QUERIES["op6_near_duplicates"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_license_lines(spark, documents):
    marks = {"GNU General": "GPL", "CC BY-NC": "CC-BY-NC", "MIT License": "MIT", "Apache License": "Apache-2.0"}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_license_scan"](spark, SF_DIR).collect()}
    for doc_id, text in zip(documents.doc_id, documents.text, strict=True):
        lines = [line for line in text.split("\n") if "icense" in line]
        families = {family for mark, family in marks.items() if any(mark in line for line in lines)}
        assert rows[doc_id]["n_paragraphs"] == len(lines)
        assert rows[doc_id]["families"] == ",".join(sorted(families))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    quality, copies, near, mixed, packed = [stage for _, stage in corpus_pipeline.STAGES]

    good = quality(spark, docs, SF_DIR)
    assert good.columns == columns
    passed = {r["doc_id"] for r in queries.QUERIES["op2_compression_quality"](spark, SF_DIR).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == passed

    alone = copies(spark, docs, SF_DIR)
    assert alone.columns == columns
    assert {r["doc_id"] for r in alone.collect()} == {
        r["doc_id"] for r in docs.groupBy("text").agg(F.max("doc_id").alias("doc_id")).collect()
    }
    kept = near(spark, docs, SF_DIR)
    assert kept.columns == columns
    found = near_duplicates.near_duplicates(docs, words=5).filter("kept").select("row.doc_id")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in found.collect())

    mixture = mixed(spark, docs, SF_DIR)
    assert mixture.columns == columns
    taken = queries.QUERIES["op8_mixing"](spark, SF_DIR).agg(F.sum("taken")).first()[0]
    assert sum(len(r["text"].encode().split()) for r in mixture.collect()) == taken
    assert packed(spark, docs, SF_DIR).select("doc_id").distinct().count() == docs.count()

    pieces = corpus_pipeline.run(spark, SF_DIR)
    totals = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).orderBy("sequence_id").collect()
    assert [r["n"] for r in totals[:-1]] == [1024] * (len(totals) - 1) and 0 < totals[-1]["n"] <= 1024


def test_pipeline_on_awkward_tables(spark, tmp_path):
    """Nulls, repeats, no labels of use, and a column that clashes; and no rows at all."""
    rows = [(1, None, None, "a", None), (None, "text without id", "en", None, 1), (2, "", "en", "b", 0)]
    rows += [(3, "one two three four five six seven", "en", "a", 5)] * 3 + [(4, "word " * 30000, None, "c", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumn("score", F.lit("mine")).withColumn("print", F.lit(None).cast("int")).withColumn("kept", F.lit(False))
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0), (1, None, 1)], "doc_id long, quality int, toxic int")
    for name, table in (("some", df), ("none", df.limit(0))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        docs = spark.read.parquet(str(tmp_path / name / "documents.parquet"))
        for step, (label, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path / name))
            assert step == 4 or out.columns == df.columns
            path = str(tmp_path / name / label.replace(" ", "-"))
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() == 0) == (name == "none")


def test_licenses_are_counted_by_row(spark, tmp_path):
    """Rows that share an id, or have none, have their own counts."""
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, notice), (1, "plain words"), (None, notice), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op9_license_scan"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["n_paragraphs"], r["families"]) for r in found) == [
        (0, 0, ""), (0, 1, "Apache-2.0"), (1, 0, ""), (1, 1, "Apache-2.0")
    ]


def test_language_model_rows(spark, documents):
    """Counts and the base formula, at full precision."""
    split = [d.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split() for d in documents.text]
    train = [zlib.crc32(str(d).encode()) % 5 != 1 for d in documents.doc_id]
    counts = Counter(w for words, used in zip(split, train, strict=True) if used for w in [*words, None])
    n, v = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op10_language_model"](spark, SF_DIR).collect()}
    for doc_id, words, used in zip(documents.doc_id, split, train, strict=True):
        tokens = [*words, None]
        r = rows[doc_id]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not used, len(tokens), sum(counts[w] > 0 for w in tokens), n)
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-12) and r["score"] < 0
