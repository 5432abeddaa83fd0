import hashlib
from collections import Counter
from datetime import datetime

import pytest

from reviewloom.operators.sampling import (
    head_rows,
    order_hash,
    sample_ratio,
    sample_rows,
    shuffle_rows,
    take_random,
)


@pytest.fixture(scope="module")
def numbered(spark):
    return spark.range(2000).selectExpr("concat('k', id) as key", "id % 7 as value")


def smallest_hashes(keys, n, seed=42):
    return sorted(keys, key=lambda key: hashlib.md5(f"{seed}:{key}".encode()).hexdigest())[:n]


@pytest.mark.parametrize("n", [1, 2, 150, 1999, 2000, 5000])
def test_count_sample_is_the_n_smallest_hashes(numbered, n):
    sample = [row["key"] for row in take_random(numbered, n, keys=["key"]).collect()]
    assert sorted(sample) == sorted(smallest_hashes([f"k{i}" for i in range(2000)], n))


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_samples_do_not_depend_on_the_partitioning(numbered, rows_of, partitions):
    other = numbered.repartition(partitions)
    for sample in (
        lambda df: take_random(df, 50, keys=["key"]),
        lambda df: take_random(df, 50),
        lambda df: sample_ratio(df, 0.1, keys=["key"]),
        lambda df: sample_rows(df, 0.5, 100, keys=["key"]),
    ):
        assert rows_of(sample(numbered)) == rows_of(sample(other))
    order = [row["key"] for row in shuffle_rows(numbered, keys=["key"]).collect()]
    assert order == [row["key"] for row in shuffle_rows(other, keys=["key"]).collect()]
    assert order == smallest_hashes([f"k{i}" for i in range(2000)], 2000)


def test_seed_changes_the_sample(numbered, rows_of):
    assert rows_of(take_random(numbered, 50, 1, ["key"])) != rows_of(take_random(numbered, 50, 2, ["key"]))


def test_copies_of_one_row_are_cut_exactly(spark, plan_of):
    """A third and more of the rows are copies of one; some of them belong to the sample."""
    hot = spark.range(3000).selectExpr("'same text' as text", "cast(1 as int) as part")
    rest = spark.range(1000).selectExpr("concat('text ', id) as text", "cast(2 as int) as part")
    df = hot.unionByName(rest)
    hashes = [(r["hash"], r["text"]) for r in df.select("text", order_hash(df).alias("hash")).distinct().collect()]
    hot_hash = next(h for h, text in hashes if text == "same text")
    before_hot = sum(h < hot_hash for h, _ in hashes)
    for n in (before_hot, before_hot + 1, before_hot + 1500, before_hot + 2999, before_hot + 3000, 3999):
        if n == 0:
            continue
        sample = take_random(df, n)
        plan = plan_of(sample)
        assert "SortMergeJoin" not in plan and "Cartesian" not in plan and "RangePartitioning" not in plan
        counts = Counter(row["text"] for row in sample.collect())
        assert sum(counts.values()) == n
        assert counts["same text"] == min(max(n - before_hot, 0), 3000)
        assert all(count == 1 for text, count in counts.items() if text != "same text")


@pytest.mark.parametrize("n", range(1, 9))
def test_sampled_rows_are_actual_rows(spark, n):
    """Rows that differ in microseconds, in the sign of zero, in null against missing, in a map."""
    times = [datetime(2025, 1, 1, 0, 0, 0, micro) for micro in (1, 2, 3, 4)]
    rows = [(t, 0.0, "x", {"a": 1}) for t in times]
    rows += [(times[0], -0.0, "x", {"a": 1}), (times[0], 0.0, None, {"a": 1}), (times[0], 0.0, "null", None), (None, 0.0, "x", {})]
    df = spark.createDataFrame(rows, "ts timestamp, v double, s string, m map<string,int>").repartition(3)
    got = [repr(tuple(r)) for r in take_random(df, n).collect()]
    assert len(got) == len(set(got)) == n and set(got) <= {repr(r) for r in rows}


def test_rows_that_share_a_key_are_ordered_by_content(spark):
    df = spark.range(100).selectExpr("'one key' as key", "id")
    sample = take_random(df, 30, keys=["key"])
    assert sample.count() == 30
    assert sample.distinct().count() == 30


def test_sample_is_a_filter_on_the_scan(spark, plan_of):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_of(take_random(source, 20, keys=["doc_id"]))
    assert "Filter" in plan and "FileScan" in plan
    for costly in ("Exchange", "Sort", "TakeOrdered", "Window", "Limit"):
        assert costly not in plan


@pytest.mark.parametrize(("n", "keys"), [(20, ["k"]), (1500, ["k"]), (700, None)])
def test_a_count_sample_reads_its_input_twice(spark, rows_of, n, keys):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.range(2000).selectExpr("concat('k', id % 1000) as k", "id").mapInArrow(counted, "k string, id long")
    sample = take_random(source, n, keys=keys)
    assert sample.count() == n and len(set(rows_of(sample))) == n
    assert read.value == 2 * 2000


def test_the_cut_is_found_where_many_hashes_share_a_prefix(spark, monkeypatch):
    """With one digit a step, the cut takes several steps; the sample stays the same."""
    df = spark.range(500).selectExpr("concat('k', id) as key")
    usual = sorted(r["key"] for r in take_random(df, 123, keys=["key"]).collect())
    monkeypatch.setattr("reviewloom.operators.sampling._PREFIX_DIGITS", 1)
    assert sorted(r["key"] for r in take_random(df, 123, keys=["key"]).collect()) == usual


def test_ratio_bounds(numbered):
    for everything in (None, 0, 0.0, 1, 1.0, 2.5, 1 - 1e-12):
        assert sample_ratio(numbered, everything, keys=["key"]).count() == 2000
    for everything in (None, 0):
        assert take_random(numbered, everything).count() == 2000
    with pytest.raises(ValueError):
        sample_ratio(numbered, -0.1)
    with pytest.raises(ValueError):
        take_random(numbered, -1)


def test_ratio_is_about_right(numbered):
    for keys in (None, ["key"]):
        assert 500 < sample_ratio(numbered, 0.3, keys=keys).count() < 700


def test_null_keys_are_told_apart_from_text(spark):
    df = spark.createDataFrame([(None, 1), ("x", 2)], "key string, id int")
    assert take_random(df, 1, keys=["key"]).count() == 1
    assert take_random(df, 2, keys=["key"]).count() == 2


def test_head_is_limited_per_task_and_per_group(spark, plan_of):
    plan = plan_of(head_rows(spark.range(0, 10000, 1, 50), 10, ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "TakeOrderedAndProject" in plan
    for n in (1, 10, 1000, 1001, 20000):
        head = head_rows(spark.range(10000).repartition(20), n, ["id"])
        assert [row["id"] for row in head.collect()] == list(range(min(n, 10000)))


def test_head_of_several_partitions(spark):
    assert [r["id"] for r in head_rows(spark.range(100).repartition(5), 3, ["id"]).collect()] == [0, 1, 2]


def test_partition_dependent_shuffle_keeps_rows(numbered, rows_of):
    assert rows_of(shuffle_rows(numbered, partition_dependent=True)) == rows_of(numbered)
