"""Comparing the scaling runs of two systems."""

from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators.runs import compare_systems, speedup_and_efficiency, tag_runs
from reviewloom.sinks.csv import write_single_csv
from reviewloom.sources.runs import read_core_runs, read_thread_runs


def scaling(runs: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Speedup, efficiency and throughput ratio; every system needs a run at level 1."""
    return speedup_and_efficiency(
        runs,
        ["framework"],
        throughput_col="throughput_tokens_per_second",
        order_by=order_by,
        require_level_one=True,
    )


def compare_run_files(spark: SparkSession, core_runs_path: str, thread_runs_path: str) -> DataFrame:
    """One row per level of the core runs. Of several runs at a level the first in the file counts."""
    order = ["position"]
    left = tag_runs(read_core_runs(spark, core_runs_path, "position"), "cores", "Spark")
    right = tag_runs(read_thread_runs(spark, thread_runs_path, "position"), "threads", "PyTorch")
    return compare_systems(scaling(left, order), scaling(right, order), order_by=order)


def write_comparison(comparison: DataFrame, directory: str, name: str = "comparison") -> str:
    """A comparison has one row per level of parallelism, hence one file."""
    return write_single_csv(comparison, directory, name)
