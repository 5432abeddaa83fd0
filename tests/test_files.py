import json
import os

import pytest
from pyspark.sql import functions as F

from reviewloom.schemas import CORE_RUN_SCHEMA, REVIEW_SCHEMA, SUMMARY_SCHEMA
from reviewloom.sinks.csv import (
    codec_suffix,
    merge_csv,
    metrics_row,
    write_csv,
    write_single_csv,
    write_single_json,
)
from reviewloom.sources.reviews import (
    CORRUPT_COLUMN,
    load_reviews,
    quarantine,
    read_parsed,
    read_rejected,
    read_reviews,
    resolve_dataset,
    split_rejects,
)
from reviewloom.sources.runs import read_core_runs, read_results_csv
from reviewloom.sources.storage import path_exists

LINES = [
    '{"text": "fine", "asin": "B1", "user_id": "u", "rating": 5, "title": "t", "extra": {"a": [1]}}',
    '{"text": "quoted rating", "rating": "4"}',
    "not json",
    '{"text": 7}',
    "",
    '{"text": null, "asin": "B2"}',
    '{"text": "  "}',
    r'{"text": "\n"}',
    r'{"text": " \"q\"\nline"}',
]

AWKWARD = [
    (None, "null", None, None, None),
    ("", "empty", "", 0.0, ""),
    ("  outer blanks  ", "blanks", "u", 1.5, "\t"),
    ("line\nbreak\r\nand cr\r", "breaks", "u", 2.0, "\n"),
    ('quote " and ""', "quotes", '"', 3.0, '","'),
    ("back\\slash \\N", "slashes", "\\", 4.0, "\\\\"),
    ("comma, comma", "commas", ",", 5.0, ",,"),
    ("naïve 😀", "unicode", "ü", None, "é"),
    ("\\N", "marker", "\\\\N", 1.0, "\\N\n"),
    ("\\\\\\N", "markers", "\\", 1.0, "N"),
]


@pytest.fixture
def jsonl(tmp_path):
    path = tmp_path / "reviews.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def test_permissive_rows(spark, jsonl):
    rows = [tuple(r) for r in read_reviews(spark, jsonl).collect()]
    assert rows == [
        ("fine", "B1", "u", 5.0, "t"),
        ("quoted rating", None, None, None, None),
        (None,) * 5,
        ("7", None, None, None, None),
        (None, "B2", None, None, None),
        ("  ", None, None, None, None),
        ("\n", None, None, None, None),
        (' "q"\nline', None, None, None, None),
    ]


def test_rejects(spark, jsonl):
    parsed, rejected = split_rejects(read_reviews(spark, jsonl, CORRUPT_COLUMN))
    assert sorted(r[0] for r in rejected.select(CORRUPT_COLUMN).collect()) == ["not json", LINES[1]]
    assert parsed.count() == 6 and rejected.count() == 2
    assert parsed.columns == REVIEW_SCHEMA.names


def test_gzip_and_globs(spark, tmp_path, rows_of):
    df = spark.createDataFrame(AWKWARD, REVIEW_SCHEMA)
    for name, compression in (("a", "none"), ("b", "gzip")):
        df.coalesce(1).write.option("compression", compression).json(str(tmp_path / name))
    assert rows_of(read_reviews(spark, str(tmp_path / "b" / "*.json.gz"))) == rows_of(df)
    assert read_reviews(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 2 * len(AWKWARD)


def test_load_samples(spark, tmp_path, rows_of):
    path = str(tmp_path / "in")
    spark.range(500).selectExpr("concat('text ', id) as text", "concat('B', id) as asin").write.json(path)
    assert load_reviews(spark, path).count() == 500
    assert load_reviews(spark, path, 1.0, 0).count() == 500
    assert load_reviews(spark, path, count=20).count() == 20
    assert load_reviews(spark, path, 0.5, 40).count() == 40
    assert rows_of(load_reviews(spark, path, 0.5, 40)) == rows_of(load_reviews(spark, path, 0.5, 40))
    assert 150 < load_reviews(spark, path, 0.5, keys=["asin"]).count() < 350


def test_resolve(spark, tmp_path, jsonl):
    root = str(tmp_path)
    assert resolve_dataset(spark, "reviews", root) == f"{root}/reviews.jsonl"
    assert resolve_dataset(spark, "reviews", root, "/nowhere") == f"{root}/reviews.jsonl"
    assert resolve_dataset(spark, "other", root, jsonl) == jsonl
    (tmp_path / "packed.jsonl.gz").write_bytes(b"")
    assert resolve_dataset(spark, "packed", root) == f"{root}/packed.jsonl.gz"
    with pytest.raises(FileNotFoundError, match="no input file"):
        resolve_dataset(spark, "other", root)
    with pytest.raises(FileNotFoundError, match="not found"):
        resolve_dataset(spark, "other", root, f"{root}/none.jsonl")
    with pytest.raises(ValueError, match="required"):
        resolve_dataset(spark, "", root)
    assert path_exists(spark, f"{root}/rev*.jsonl") and not path_exists(spark, f"{root}/x*")


def test_csv_is_lossless(spark, tmp_path, rows_of):
    df = spark.createDataFrame(AWKWARD, REVIEW_SCHEMA)
    path = write_csv(df.repartition(3), str(tmp_path / "csv"))
    assert rows_of(read_results_csv(spark, path, REVIEW_SCHEMA)) == rows_of(df)
    packed = write_csv(df, str(tmp_path / "csv-gz"), "gzip")
    assert any(name.endswith(".csv.gz") for name in os.listdir(packed))
    assert rows_of(read_results_csv(spark, packed, REVIEW_SCHEMA)) == rows_of(df)


def test_single_csv(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int").repartition(2)
    folder = str(tmp_path / "out")
    path = write_single_csv(df, folder, "table")
    assert path == f"{folder}/table.csv"
    assert sorted(open(path).read().splitlines()) == ["a,1", "b,2", "k,n"]
    write_single_csv(df.filter("n = 1"), folder, "table")  # overwrites
    assert open(path).read().splitlines() == ["k,n", "a,1"]
    assert [name for name in os.listdir(folder) if not name.startswith(".table.csv")] == ["table.csv"]
    write_single_csv(df.limit(0), folder, "none")
    assert os.path.exists(f"{folder}/none.csv")


def test_merge_has_one_header(spark, tmp_path, rows_of):
    df = spark.range(100).select(F.col("id"), F.concat(F.lit("line\n"), F.col("id")).alias("text"))
    parts = write_csv(df.repartition(7), str(tmp_path / "parts"))
    merged = merge_csv(spark, parts, str(tmp_path / "merged"), "all", df.schema)
    assert open(merged).read().count("id,text") == 1
    assert rows_of(read_results_csv(spark, merged, df.schema)) == rows_of(df)


@pytest.mark.parametrize("split_bytes", [7, 61, 300, 5000, 1 << 20])
def test_one_file_is_read_in_splits(spark, tmp_path, rows_of, split_bytes):
    long = [("x\ny\"\n" * 90, f"long{i}", "u", float(i), None) for i in range(3)]
    df = spark.createDataFrame([*AWKWARD, *long, *AWKWARD], REVIEW_SCHEMA)
    parts = write_csv(df.repartition(4), str(tmp_path / "parts"))
    merged = merge_csv(spark, parts, str(tmp_path / "merged"), "all", REVIEW_SCHEMA)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = read_results_csv(spark, merged, REVIEW_SCHEMA, split=True)
        assert rows_of(found) == rows_of(df)
        assert found.schema.simpleString() == REVIEW_SCHEMA.simpleString()
        if split_bytes < 1000:
            assert spark.read.text(merged).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "deflate", "GZIP", "none"])
def test_codecs(spark, tmp_path, rows_of, codec):
    df = spark.range(20).select(F.concat(F.lit("text "), F.col("id")).alias("text"))
    parts = write_csv(df, str(tmp_path / "parts"), codec)
    merged = merge_csv(spark, parts, str(tmp_path / "merged"), "all", df.schema, codec)
    assert merged.endswith(".csv" + codec_suffix(codec))
    assert rows_of(read_results_csv(spark, merged, df.schema)) == rows_of(df)


def test_unknown_codec_is_refused_before_writing(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown compression"):
        write_csv(spark.range(3), str(tmp_path / "never"), "rar")
    assert not os.path.exists(tmp_path / "never")


def test_metrics(spark, tmp_path):
    metrics = {name: None for name in SUMMARY_SCHEMA.names}
    metrics |= {"total_reviews": 3, "processing_time_seconds": 1.5, "started_at": "2025-01-01 00:00:00"}
    path = write_single_csv(metrics_row(spark, metrics), str(tmp_path), "summary_metrics")
    assert path.endswith("/summary_metrics.csv")
    header, line = open(path).read().splitlines()
    assert header.split(",") == SUMMARY_SCHEMA.names
    assert dict(zip(header.split(","), line.split(","), strict=True))["total_reviews"] == "3"
    as_json = write_single_json(metrics_row(spark, metrics), str(tmp_path), "metrics")
    assert json.loads(open(as_json).read())["processing_time_seconds"] == 1.5


def test_quarantine_in_one_pass(spark, jsonl, tmp_path, plan_of):
    written = quarantine(spark, jsonl, str(tmp_path / "out"))
    assert (written.parsed, written.rejected) == (6, 2)
    parsed = read_parsed(spark, written)
    assert parsed.columns == [*REVIEW_SCHEMA.names, "source_file", "block_start"]
    expected, _ = split_rejects(read_reviews(spark, jsonl, CORRUPT_COLUMN))
    assert sorted(map(repr, parsed.select(REVIEW_SCHEMA.names).collect())) == sorted(map(repr, expected.collect()))
    assert {(r["source_file"].rsplit("/", 1)[1], r["block_start"]) for r in parsed.collect()} == {("reviews.jsonl", 0)}
    rejected = read_rejected(spark, written)
    assert sorted(r["line"] for r in rejected.collect()) == sorted([LINES[1], LINES[2]])
    assert "PartitionFilters" in plan_of(rejected) and rejected.inputFiles() != []


def test_quarantine_of_good_bad_or_no_lines(spark, tmp_path):
    for name, text, counts in (("good", LINES[0], (1, 0)), ("bad", "no json", (0, 1)), ("none", "", (0, 0))):
        path = tmp_path / f"{name}.jsonl"
        path.write_text(text + "\n", encoding="utf-8")
        written = quarantine(spark, str(path), str(tmp_path / name))
        assert (written.parsed, written.rejected) == counts
        assert (read_parsed(spark, written).count(), read_rejected(spark, written).count()) == counts


def metric_files(folder, **texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_metric_files_with_differing_headers(spark, tmp_path):
    path = metric_files(
        tmp_path / "a b%20c",
        a="cores,total_time,total_time\n2,1.5,9\n1,2.5,9\n",
        b='"total_tokens","no, te",cores\n70,"x, y",4\n',
        c="\n\ntotal_time,cores\n3.5,8\n",
        d="",
        e="cores,total_time\n",
    )
    runs = read_core_runs(spark, path, position_col="place").orderBy("place")
    assert runs.columns == ["cores", "total_tokens", "total_time", "place"]
    assert [tuple(r)[:3] for r in runs.collect()] == [(2, None, 1.5), (1, None, 2.5), (4, 70, None), (8, None, 3.5)]


def test_metric_files_without_a_line(spark, tmp_path):
    path = metric_files(tmp_path / "empty", a="", b="\n")
    runs = read_core_runs(spark, path, position_col="place")
    assert runs.columns == [*CORE_RUN_SCHEMA.names, "place"] and runs.count() == 0
