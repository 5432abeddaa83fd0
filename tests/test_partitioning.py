import os

import pytest

from reviewloom.operators.partitioning import (
    MIB,
    ROW_BYTES,
    partition_bytes,
    partition_profile,
    plan_by_ceiling,
    plan_by_file_size,
    plan_by_row_size,
    repartition_by_bytes,
    repartition_by_rows,
    serialized_size,
    spread_evenly,
    spread_plan,
    task_slots,
)
from reviewloom.sources.storage import input_bytes, input_size, scratch_path

TB = 1024 * 1024 * MIB


@pytest.mark.parametrize(
    ("size", "target_mb", "slots", "expected"),
    [
        (0, 128, 14, 14),
        (8 * MIB, 128, 4, 4),
        (128 * MIB, 128, 4, 4),
        (640 * MIB, 128, 4, 8),  # five targets, two waves
        (int(886.4 * MIB), 128, 14, 14),
        (100 * TB, 128, 1000, 820_000),
    ],
)
def test_plan_by_file_size(size, target_mb, slots, expected):
    assert plan_by_file_size(size, target_mb, slots) == expected


def test_plan_by_ceiling():
    assert plan_by_ceiling(0, MIB) == 1
    assert plan_by_ceiling(8 * MIB, 8 * MIB) == 1
    assert plan_by_ceiling(8 * MIB + 1, 8 * MIB) == 2
    assert plan_by_ceiling(8 * MIB + 1, 8 * MIB, min_partitions=4) == 4


def test_plan_by_row_size():
    # 2 * 2409.87 + 200 bytes per row
    assert plan_by_row_size(2409.87, 1000, MIB) == (208, 4)
    assert plan_by_row_size(None, 0, MIB) == (5242, 1)
    assert plan_by_row_size(1e9, 10, MIB) == (1, 10)


def test_sizes(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('text ', id) as text")
    path = str(tmp_path / "parts")
    df.repartition(3).write.json(path)
    files = [name for name in os.listdir(path) if name.startswith("part-")]
    total = sum(os.path.getsize(os.path.join(path, name)) for name in files)
    assert input_size(spark, path).first() == (3, total)
    assert input_size(spark, path + "/part-*.json").first() == (3, total)
    assert input_bytes(spark, os.path.join(path, files[0])) == os.path.getsize(os.path.join(path, files[0]))
    assert serialized_size(df.limit(0)).first()[0] == 0
    assert serialized_size(spark.createDataFrame([("ab",)], "text string")).first()[0] == len('{"text":"ab"}')


def test_small_scans_are_spread_and_large_ones_left_alone(spark, tmp_path, plan_of):
    path = str(tmp_path / "one.json")
    spark.range(100).selectExpr("concat('text ', id) as text").coalesce(1).write.json(path)
    scan = spark.read.schema("text string").json(path)
    assert spread_evenly(scan, 10_000).rdd.getNumPartitions() == task_slots(spark) == 8

    wide = spark.range(100, numPartitions=10)
    assert spread_evenly(wide, 10 * 128 * MIB) is wide
    assert spread_evenly(wide, 10 * 128 * MIB + 5 * 128 * MIB) is wide  # more targets, but no idle slots
    many = spark.range(1000, numPartitions=200)
    assert spread_plan(many, 10 * 128 * MIB) == (16, "merge")
    assert spread_evenly(many, 10 * 128 * MIB).rdd.getNumPartitions() == 16
    assert "Exchange" not in plan_of(spread_evenly(many, 10 * 128 * MIB))
    assert spread_plan(spark.range(900, numPartitions=900), 800 * 128 * MIB) == (900, "keep")
    assert spread_evenly(wide, 100 * 128 * MIB).rdd.getNumPartitions() == 104  # as with gzip


def test_profile(spark):
    assert partition_profile(spark.range(80).repartition(8)).select(
        "partitions", "total_rows", "avg_rows"
    ).first() == (8, 80, 10.0)
    assert partition_profile(spark.range(0)).first() == (0, 0, None, None, None)


def test_repartition_by_rows(spark):
    df = spark.range(1000).selectExpr("repeat('x', 100) as text")  # 400 bytes each
    partitions, spread = repartition_by_rows(df, 0.05)
    assert partitions == spread.rdd.getNumPartitions() == 7


def test_partitions_of_like_bytes(spark, rows_of):
    """Lengths from 0 to 20,000, the long ones side by side; null texts; other columns stay."""
    length = "cast(case when id % 100 = 0 then 20000 when id > 3000 then 900 else id % 50 end as int)"
    df = spark.range(4000).selectExpr("id", f"if(id % 7 = 3, null, repeat('é', {length})) as text", "array(id) as more").repartition(5, "id")
    for wanted in (1, 3, 12, 40):
        partitions, dealt = repartition_by_bytes(df, partitions=wanted)
        assert partitions == dealt.rdd.getNumPartitions() == wanted and dealt.columns == df.columns
        assert rows_of(dealt) == rows_of(df)
        seen = partition_bytes(dealt).first()
        assert seen["partitions"] == wanted and seen["total_bytes"] == partition_bytes(df).first()["total_bytes"]
        assert seen["max_bytes"] <= seen["total_bytes"] / wanted + 40000 + ROW_BYTES
    partitions, dealt = repartition_by_bytes(df, target_mb=0.25)
    assert partitions == -(-seen["total_bytes"] // (MIB // 4)) and partition_bytes(dealt).first()["max_to_mean"] < 1.5


def test_bytes_of_nothing(spark):
    empty = spark.createDataFrame([], "text string")
    partitions, dealt = repartition_by_bytes(empty, target_mb=1)
    assert partitions == 1 and dealt.count() == 0
    assert partition_bytes(empty).first() == (0, 0, None, None)
    blank = spark.createDataFrame([("",), (None,)] * 50, "text string")
    assert partition_bytes(repartition_by_bytes(blank, partitions=4)[1]).first()[:2] == (4, 100 * ROW_BYTES)
    with pytest.raises(ValueError):
        repartition_by_bytes(blank)


def test_scratch_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root) and first != second

