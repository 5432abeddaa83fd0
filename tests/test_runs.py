"""Run analytics. The published scaling runs give a golden test of speedup and comparison."""

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import runs
from reviewloom.plans.comparison import compare_run_files, scaling, write_comparison
from reviewloom.queries import runs as run_queries
from reviewloom.schemas import CORE_RUN_SCHEMA, SIZE_SWEEP_SCHEMA
from reviewloom.sinks.csv import write_single_csv
from reviewloom.sinks.report import write_report
from reviewloom.sources.runs import read_core_runs, read_metrics_csv, read_thread_runs

# Published runs, level -> (seconds, tokens per second), and their comparison.
CORE_RUNS = {
    1: (1874.1537885665894, 183.01753148141555),
    2: (979.2319822311401, 350.27757081471304),
    3: (686.3499245643616, 499.7494539213508),
    4: (519.985846042633, 659.6391086611953),
}
THREAD_RUNS = {
    1: (1901.1241629123688, 180.9892308521778),
    2: (1088.0258815288544, 316.2452344575729),
    3: (970.8084042072296, 354.4293585725405),
    4: (658.121423959732, 522.826012758784),
}
COMPARISON = """\
parallelism,spark_time,torch_time,time_ratio,spark_speedup,torch_speedup,speedup_ratio,spark_efficiency,torch_efficiency,efficiency_ratio
1,1874.1537885665891,1901.1241629123688,1.0143906943551348,1.0,1.0,1.0,1.0,1.0,1.0
2,979.23198223114,1088.0258815288544,1.1111012520749495,1.9139017337816178,1.747315201951794,0.9129597257322764,0.9569508668908089,0.873657600975897,0.9129597257322764
3,686.3499245643616,970.8084042072296,1.4144510977012474,2.7306097392757023,1.9582897662127707,0.7171620821700466,0.9102032464252341,0.652763255404257,0.7171620821700466
4,519.985846042633,658.121423959732,1.265652572985176,3.6042400054345505,2.8887133797800377,0.8014764209443249,0.9010600013586376,0.7221783449450094,0.8014764209443249
"""


def run_table(spark, data, framework="Spark"):
    rows = [(level, seconds, tokens, framework) for level, (seconds, tokens) in data.items()]
    return spark.createDataFrame(
        rows, "parallelism int, total_time double, throughput_tokens_per_second double, framework string"
    )


def golden():
    header, *lines = COMPARISON.splitlines()
    return header.split(","), [[float(value) for value in line.split(",")] for line in lines]


def assert_golden(comparison):
    columns, expected = golden()
    assert comparison.columns == columns
    for row, values in zip(comparison.collect(), expected, strict=True):
        assert list(row) == pytest.approx(values, rel=1e-14)


def test_published_comparison(spark):
    left = scaling(run_table(spark, CORE_RUNS))
    right = scaling(run_table(spark, THREAD_RUNS, "PyTorch"))
    assert_golden(runs.compare_systems(left, right))


def test_published_comparison_from_files(spark, tmp_path):
    core = tmp_path / "cores.csv"
    core.write_text(
        "cores,total_time,throughput_tokens_per_second\n"
        + "".join(f"{level},{s!r},{t!r}\n" for level, (s, t) in CORE_RUNS.items())
    )
    thread = tmp_path / "threads.csv"
    thread.write_text(  # columns in another order, one the schema does not know, a second run at level 2
        "note,throughput_tokens_per_second,threads,total_time\n"
        + "".join(f"n,{t!r},{level},{s!r}\n" for level, (s, t) in THREAD_RUNS.items())
        + "n,1.0,2,1.0\n"
    )
    comparison = compare_run_files(spark, str(core), str(thread))
    assert_golden(comparison)
    path = write_comparison(comparison, str(tmp_path / "out"))
    written = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    assert_golden(written.orderBy("parallelism"))


def test_throughput_ratio(spark):
    ratios = [r["throughput_ratio"] for r in scaling(run_table(spark, CORE_RUNS)).orderBy("parallelism").collect()]
    assert ratios == pytest.approx([t / CORE_RUNS[1][1] for _, t in CORE_RUNS.values()])


def test_baseline_falls_back_to_the_first_run(spark):
    df = run_table(spark, {level: run for level, run in CORE_RUNS.items() if level > 1})
    scaled = runs.speedup_and_efficiency(df, ["framework"]).orderBy("parallelism").collect()
    assert [r["speedup"] for r in scaled] == pytest.approx([CORE_RUNS[2][0] / CORE_RUNS[n][0] for n in (2, 3, 4)])
    with pytest.raises(Exception, match="no run at level 1"):
        scaling(df).collect()


def test_first_run_is_by_position_when_asked(spark):
    df = spark.createDataFrame(
        [("a", 4, 10.0, 0), ("a", 2, 20.0, 1)], "framework string, parallelism int, total_time double, position int"
    )
    by_position = runs.speedup_and_efficiency(df, ["framework"], order_by=["position"])
    assert {r["parallelism"]: r["speedup"] for r in by_position.collect()} == {4: 1.0, 2: 0.5}


def test_efficiency_of_level_zero_is_zero(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 0, 5.0)], "framework string, parallelism int, total_time double")
    assert {r["parallelism"]: r["efficiency"] for r in runs.speedup_and_efficiency(df, ["framework"]).collect()} == {
        1: 1.0,
        0: 0.0,
    }


def test_systems_do_not_mix(spark):
    both = runs.concat_runs(run_table(spark, CORE_RUNS, "a"), run_table(spark, THREAD_RUNS, "b"))
    scaled = {(r["framework"], r["parallelism"]): r["speedup"] for r in scaling(both).collect()}
    assert scaled["a", 4] == pytest.approx(golden()[1][3][4])
    assert scaled["b", 4] == pytest.approx(golden()[1][3][5])


def test_missing_and_repeated_levels(spark):
    left = scaling(run_table(spark, CORE_RUNS))
    right = runs.concat_runs(
        *[scaling(run_table(spark, {1: THREAD_RUNS[1], level: THREAD_RUNS[level]})) for level in (2, 2, 4)]
    )
    rows = {r["parallelism"]: r for r in runs.compare_systems(left, right).collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert rows[3]["spark_time"] == CORE_RUNS[3][0]
    assert [rows[3][c] for c in ("torch_time", "time_ratio", "speedup_ratio", "efficiency_ratio")] == [None] * 4
    assert rows[2]["time_ratio"] == pytest.approx(golden()[1][1][3])


def test_ratio_with_zero_denominator(spark):
    schema = "parallelism int, total_time double, speedup double, efficiency double"
    left = spark.createDataFrame([(1, 1.0, 0.0, 0.0)], schema)
    right = spark.createDataFrame([(1, 2.0, 1.0, 1.0)], schema)
    row = runs.compare_systems(left, right).first()
    assert (row["time_ratio"], row["speedup_ratio"], row["efficiency_ratio"]) == (2.0, 0.0, 0.0)


def test_levels(spark):
    a = spark.createDataFrame([(3,), (1,), (3,)], "parallelism int")
    b = spark.createDataFrame([(2,), (1,)], "parallelism int")
    assert [r[0] for r in runs.levels(a, b).collect()] == [1, 2, 3]
    assert [r[0] for r in runs.levels(a).collect()] == [1, 3]


def test_best_configuration_takes_the_first_of_equals(spark):
    sweep = spark.createDataFrame([(8, 5.0), (2, 9.0), (4, 9.0)], "target int, throughput double")
    assert tuple(runs.best_configuration(sweep, ["target"]).first()) == (2, 9.0)


def test_core_usage(spark):
    samples = spark.createDataFrame([([90.0, 10.0],), ([70.0, 30.0],)], "per_core array<double>")
    usage = runs.core_usage(runs.core_samples(samples, "per_core"))
    assert sorted(tuple(r) for r in usage.collect()) == [(0, 80.0, 2), (1, 20.0, 2)]
    assert tuple(runs.core_usage_summary(usage).first()) == (2, 1, 50.0, 80.0, 2)
    assert tuple(runs.core_usage_summary(usage.limit(0)).first()) == (0, 0, 0.0, 0.0, 0)


def test_half_used_core_is_not_active(spark):
    usage = runs.core_usage(spark.createDataFrame([(0, 50.0), (1, 50.1)], "core int, percent double"))
    assert runs.core_usage_summary(usage).first()["active_cores"] == 1


def test_peak(spark, plan_of):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 3.0), ("a", 3, 4.0), ("b", 1, 1.0)], "k string, t int, v double")
    peaks = runs.peak_and_increase(df, ["k"], "v", ["t"])
    assert sorted(tuple(r) for r in peaks.collect()) == [("a", 3.0, 5.0, 2.0), ("b", 1.0, 1.0, 0.0)]
    assert "SortAggregate" not in plan_of(runs.peak_and_increase(df, ["k"], "v", ["t"]))
    two = runs.peak_and_increase(df, ["k"], "v", ["t", "v"])
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, peaks.collect()))


def test_latency(spark):
    df = spark.createDataFrame([(0.5, 10), (1.5, 30)], "s double, n int")
    assert runs.latency_stats(df, "s", "n").first().asDict() == {
        "total_samples": 2,
        "total_time": 2.0,
        "avg_time_per_sample": 1.0,
        "max_time_per_sample": 1.5,
        "min_time_per_sample": 0.5,
        "total_tokens": 40,
        "avg_tokens": 20.0,
        "max_tokens": 30,
        "throughput_tokens_per_second": 20.0,
    }
    assert runs.latency_stats(df.limit(0), "s").first()["avg_time_per_sample"] is None


def test_throughput_without_time_is_zero(spark):
    df = spark.createDataFrame([(1, 0.0, 5)], "level int, s double, n int")
    row = runs.throughput_by_level(df, ["level"], F.sum("s"), F.count(F.lit(1)), F.sum("n")).first()
    assert (row["throughput_samples_per_second"], row["throughput_tokens_per_second"]) == (0.0, 0.0)


def test_thread_runs_have_core_usage_as_array(spark, tmp_path):
    path = tmp_path / "threads.csv"
    path.write_text(
        "threads,memory_before_mb,memory_after_mb,per_core_usage,cpu_samples_collected\n"
        '1,10.5,9.5,"[34.5, 15.25]",7\n'
    )
    row = read_thread_runs(spark, str(path)).first()
    assert row.asDict() == {
        "threads": 1,
        "memory_before_mb": 10.5,
        "memory_after_mb": 9.5,
        "per_core_usage": [34.5, 15.25],
        "cpu_samples_collected": 7,
    }


def test_many_metric_files_make_one_table(spark, tmp_path):
    for level, (seconds, _) in CORE_RUNS.items():
        one = spark.createDataFrame([(level, seconds)], "cores int, total_time double")
        write_single_csv(one, str(tmp_path), f"cores_{level}")
    table = runs.sort_runs(read_core_runs(spark, str(tmp_path / "cores_*.csv")), "cores")
    assert [tuple(r) for r in table.collect()] == [(level, s) for level, (s, _) in CORE_RUNS.items()]
    (tmp_path / "cores_9.csv").write_text("total_time,cores\n1.0,9\n")
    other = read_metrics_csv(spark, str(tmp_path / "cores_*.csv"), CORE_RUN_SCHEMA).filter("cores = 9")
    assert [tuple(r) for r in other.select("cores", "total_time").collect()] == [(9, 1.0)]


def test_sweep_report(spark, tmp_path):
    sweep = spark.createDataFrame(
        [
            (2.0, 5, 3243.2, 16216, 16216, 1224.58, 1225.08, 13.24),
            (4.0, 3, 5405.3, 16216, 16216, 1063.96, 1064.14, 15.24),
        ],
        SIZE_SWEEP_SCHEMA,
    )
    path = write_report({"Best": runs.best_configuration(sweep, ["target_mb"]), "Runs": sweep}, str(tmp_path), "sweep")
    assert open(path).read().splitlines() == [
        "Best",
        "target_mb 4.0, throughput 15.24",
        "Runs",
        "target_mb 2.0, num_partitions 5, reviews_per_partition 3243.2, total_reviews 16216, result_count 16216, "
        "process_time 1224.58, total_time 1225.08, throughput 13.24",
        "target_mb 4.0, num_partitions 3, reviews_per_partition 5405.3, total_reviews 16216, result_count 16216, "
        "process_time 1063.96, total_time 1064.14, throughput 15.24",
    ]


@pytest.mark.parametrize(
    "name",
    ["speedup_efficiency", "speedup_first_run_baseline", "throughput_ratio", "framework_comparison", "best_configuration"],
)
def test_analytics_read_their_table_once(spark, plan_of, name):
    plan = plan_of(run_queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_rows_of_several_files_keep_their_order(spark, tmp_path):
    for name, rows in (("a", "2,1.0\n1,2.0\n"), ("b", "1,9.0\n")):
        (tmp_path / f"{name}.csv").write_text("cores,total_time\n" + rows)
    read = read_core_runs(spark, str(tmp_path / "*.csv"), "position").orderBy("position")
    assert [(r["cores"], r["total_time"]) for r in read.collect()] == [(2, 1.0), (1, 2.0), (1, 9.0)]
