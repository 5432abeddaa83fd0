"""Analytics over run metrics: throughput, speedup, efficiency, comparison of two systems.

All of it works on tables of any length: baselines are aggregated per system and joined back, so no
task has to hold all runs of one system. For runs that are aggregated to a row per system and level
already, ``aggregated=True`` takes the baseline over a window of these few rows instead, and the input is evaluated once.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.numeric import ratio_or_zero

ACTIVE_CORE_PERCENT = 50.0  # fixed value: a core counts as active above this mean usage


# ---- one table out of many runs -------------------------------------------------------------


def concat_runs(*runs: DataFrame) -> DataFrame:
    """One table of all runs; a column some runs lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def tag_runs(df: DataFrame, level_col: str, framework: str) -> DataFrame:
    """Name the level column ``parallelism`` and say which system the runs belong to."""
    return df.withColumnRenamed(level_col, "parallelism").withColumn("framework", F.lit(framework))


def levels(*runs: DataFrame, level_col: str = "parallelism") -> DataFrame:
    """All levels that occur, each once, ascending."""
    columns = [df.select(level_col).distinct() for df in runs]
    return reduce(DataFrame.union, columns).distinct().orderBy(level_col)


def sort_runs(df: DataFrame, level_col: str = "parallelism") -> DataFrame:
    return df.orderBy(level_col)


# ---- per-level and per-sample aggregates ----------------------------------------------------


def throughput_by_level(
    df: DataFrame, keys: list[str], seconds: Column, samples: Column, tokens: Column
) -> DataFrame:
    """Samples and tokens per second for each level.

    ``samples``, ``tokens`` and ``seconds`` are aggregates over the rows of a level.
    """
    totals = df.groupBy(*keys).agg(
        samples.alias("total_samples"), tokens.alias("total_tokens"), seconds.alias("total_time")
    )
    return totals.withColumns(
        {
            "throughput_samples_per_second": ratio_or_zero("total_samples", "total_time"),
            "throughput_tokens_per_second": ratio_or_zero("total_tokens", "total_time"),
        }
    )


def latency_stats(df: DataFrame, seconds_col: str, tokens_col: str | None = None) -> DataFrame:
    """Mean, largest, smallest and total time per sample; with tokens also their throughput."""
    seconds = F.col(seconds_col)
    totals = [
        F.count(F.lit(1)).alias("total_samples"),
        F.sum(seconds).alias("total_time"),
        F.avg(seconds).alias("avg_time_per_sample"),
        F.max(seconds).alias("max_time_per_sample"),
        F.min(seconds).alias("min_time_per_sample"),
    ]
    if tokens_col is None:
        return df.agg(*totals)
    tokens = [
        F.sum(F.col(tokens_col).cast("bigint")).alias("total_tokens"),
        F.avg(tokens_col).alias("avg_tokens"),
        F.max(tokens_col).alias("max_tokens"),
    ]
    return df.agg(*totals, *tokens).withColumn(
        "throughput_tokens_per_second", ratio_or_zero("total_tokens", "total_time")
    )


def core_samples(df: DataFrame, samples_col: str, keep: list[str] | None = None) -> DataFrame:
    """One row per core out of an array with one usage value per core."""
    return df.select(*(keep or []), F.posexplode(samples_col).alias("core", "percent"))


def core_usage(samples: DataFrame, core_col: str = "core", percent_col: str = "percent") -> DataFrame:
    """Mean usage of each core."""
    return samples.groupBy(core_col).agg(
        F.avg(percent_col).alias("mean_usage"), F.count(F.lit(1)).alias("samples")
    )


def core_usage_summary(usage: DataFrame) -> DataFrame:
    """Active cores, mean and highest core usage and samples per core; zeros without samples."""

    def or_zero(aggregate, zero):
        return F.coalesce(aggregate, F.lit(zero))

    return usage.agg(
        F.count(F.lit(1)).alias("num_cores"),
        F.count_if(F.col("mean_usage") > ACTIVE_CORE_PERCENT).alias("active_cores"),
        or_zero(F.avg("mean_usage"), 0.0).alias("avg_core_usage"),
        or_zero(F.max("mean_usage"), 0.0).alias("max_core_usage"),
        or_zero(F.max("samples"), 0).alias("samples_collected"),
    )


def peak_and_increase(
    df: DataFrame, keys: list[str], value_col: str, order_by: list[str]
) -> DataFrame:
    """First and highest value of each series, and how far it rose.

    A single, numeric or time, ``order_by`` column keeps this a hash aggregate; several columns
    make Spark sort the rows of each task first.
    """
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    first = F.min_by(value_col, order)
    return (
        df.groupBy(*keys)
        .agg(first.alias("first_value"), F.max(value_col).alias("peak_value"))
        .withColumn("increase", F.col("peak_value") - F.col("first_value"))
    )


# ---- relative to a baseline -----------------------------------------------------------------


def baseline_of(
    runs: DataFrame,
    values: list[str],
    system_cols: list[str],
    level_col: str = "parallelism",
    order_by: list[str] | None = None,
    require_level_one: bool = False,
) -> DataFrame:
    """Baseline values (``base_<value>``) of each system: its run at level 1.

    Without a run at level 1 the first run counts, in the order of ``order_by`` (by default level,
    then values); ``require_level_one=True`` raises instead. One aggregate, summed up per task
    before the shuffle.
    """
    picked = runs.groupBy(*system_cols).agg(_first_run(values, level_col, order_by).alias("run"))
    return picked.select(*system_cols, *_base_values("run", values, require_level_one))


def _first_run(values: list[str], level_col: str, order_by: list[str] | None) -> Column:
    order = [F.col(name) for name in order_by or [level_col, *values]]
    rank = F.struct(F.when(F.col(level_col) == 1, 0).otherwise(1).alias("missing"), *order)
    return F.min_by(F.struct(F.col(level_col).alias("level"), *values), rank)


def _base_values(run: str, values: list[str], require_level_one: bool) -> list[Column]:
    def base(name):
        if not require_level_one:
            return F.col(f"{run}.{name}")
        problem = F.raise_error(F.lit("a system has no run at level 1"))
        return F.when(F.col(f"{run}.level") == 1, F.col(f"{run}.{name}")).otherwise(problem)

    return [base(name).alias(f"base_{name}") for name in values]


def with_baseline(runs: DataFrame, baseline: DataFrame, system_cols: list[str]) -> DataFrame:
    """Runs with the baseline of their system.

    There is no broadcast hint: the baseline is an aggregate, and adaptive execution broadcasts it
    when its measured size allows, and splits a skewed system otherwise.
    """
    return runs.join(baseline, system_cols, "left")


def speedup_and_efficiency(
    runs: DataFrame,
    system_cols: list[str],
    level_col: str = "parallelism",
    time_col: str = "total_time",
    throughput_col: str | None = None,
    order_by: list[str] | None = None,
    require_level_one: bool = False,
    aggregated: bool = False,
) -> DataFrame:
    """Add ``speedup``, ``efficiency`` and, given a throughput, ``throughput_ratio``.

    ``aggregated`` says that a system has few rows, so that a window may hold them.
    """
    values = [time_col] + ([throughput_col] if throughput_col else [])
    if aggregated:
        first = _first_run(values, level_col, order_by).over(Window.partitionBy(*system_cols))
        based = runs.withColumn("_first_run", first)
        based = based.select(*runs.columns, *_base_values("_first_run", values, require_level_one))
    else:
        baseline = baseline_of(runs, values, system_cols, level_col, order_by, require_level_one)
        based = with_baseline(runs, baseline, system_cols)
    result = based.withColumn("speedup", F.try_divide(F.col(f"base_{time_col}"), F.col(time_col)))
    result = result.withColumn("efficiency", ratio_or_zero("speedup", level_col))
    if throughput_col:
        ratio = F.try_divide(F.col(throughput_col), F.col(f"base_{throughput_col}"))
        result = result.withColumn("throughput_ratio", ratio)
    return result.drop(*[f"base_{name}" for name in values])


# ---- two systems side by side ---------------------------------------------------------------


def compare_systems(
    left: DataFrame,
    right: DataFrame,
    level_col: str = "parallelism",
    left_name: str = "spark",
    right_name: str = "torch",
    order_by: list[str] | None = None,
) -> DataFrame:
    """``compare_tagged`` for two systems in two tables."""
    both = concat_runs(left.withColumn("_side", F.lit("left")), right.withColumn("_side", F.lit("right")))
    sides = F.col("_side") == "left", F.col("_side") == "right"
    return compare_tagged(both, *sides, level_col, left_name, right_name, order_by)


def compare_tagged(
    runs: DataFrame,
    is_left: Column,
    is_right: Column,
    level_col: str = "parallelism",
    left_name: str = "spark",
    right_name: str = "torch",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Time, speedup and efficiency of two systems per level of the left one, and their ratios.

    Runs carry ``total_time``, ``speedup`` and ``efficiency``. Of several runs of a system at one level the first
    in the order of ``order_by`` (by default of the values) counts. A level the right side lacks
    gives nulls; a ratio with a denominator that is not positive is 0. One aggregate, and no join.
    """
    values = ["total_time", "speedup", "efficiency"]

    def first(of_side):
        run, order = F.struct(*values), F.struct(*(order_by or values))
        return F.min_by(F.when(of_side, run), F.when(of_side, order))

    per_level = runs.groupBy(level_col).agg(first(is_left).alias("left"), first(is_right).alias("right"))

    def ratio(measure):
        return ratio_or_zero(f"right.{measure}", f"left.{measure}").alias(f"{measure}_ratio")

    # The names of the columns of a comparison.
    return per_level.filter("left is not null").select(
        level_col,
        F.col("left.total_time").alias(f"{left_name}_time"),
        F.col("right.total_time").alias(f"{right_name}_time"),
        F.try_divide(F.col("right.total_time"), F.col("left.total_time")).alias("time_ratio"),
        F.col("left.speedup").alias(f"{left_name}_speedup"),
        F.col("right.speedup").alias(f"{right_name}_speedup"),
        ratio("speedup"),
        F.col("left.efficiency").alias(f"{left_name}_efficiency"),
        F.col("right.efficiency").alias(f"{right_name}_efficiency"),
        ratio("efficiency"),
    ).orderBy(level_col)


def best_configuration(
    runs: DataFrame, config_cols: list[str], throughput_col: str = "throughput"
) -> DataFrame:
    """The configuration with the highest throughput; of equals, the one that sorts first."""
    ascending = [F.col(name).asc() for name in config_cols]
    return (
        runs.select(*config_cols, throughput_col)
        .orderBy(F.col(throughput_col).desc(), *ascending)
        .limit(1)
    )
