"""Run-metric analytics over line items and events."""

from pyspark.sql import functions as F

from reviewloom.operators import runs
from reviewloom.queries.tables import RUNS_SQL, round_columns, system_runs, table

NAMES = {"A": "Alpha", "N": "Nova", "R": "Rho"}


def by_level(records, *keys):
    """Seconds, samples and tokens per system and level (and more keys)."""
    return runs.throughput_by_level(
        records,
        ["framework", "parallelism", *keys],
        seconds=F.sum("hundredths") / 100,
        samples=F.sum("samples"),
        tokens=F.sum("tokens"),
    )


def levels_of(spark, sf_dir):
    return by_level(system_runs(spark, sf_dir).withColumn("samples", F.lit(1)))


def throughput(spark, sf_dir):
    return round_columns(
        by_level(system_runs(spark, sf_dir).withColumn("samples", F.lit(1))),
        "total_time",
        "throughput_samples_per_second",
        "throughput_tokens_per_second",
    )


def speedup(spark, sf_dir):
    scaled = runs.speedup_and_efficiency(levels_of(spark, sf_dir), ["framework"], require_level_one=True, aggregated=True)
    return round_columns(scaled, "speedup", "efficiency").select(
        "framework", "parallelism", "speedup", "efficiency"
    )


def speedup_without_level_one(spark, sf_dir):
    """One system lacks level 1: its first level is the baseline then."""
    known = levels_of(spark, sf_dir).filter("not (framework = 'R' and parallelism = 1)")
    scaled = runs.speedup_and_efficiency(known, ["framework"], aggregated=True)
    return round_columns(scaled, "speedup", "efficiency").select(
        "framework", "parallelism", "speedup", "efficiency"
    )


def throughput_ratio(spark, sf_dir):
    scaled = runs.speedup_and_efficiency(
        levels_of(spark, sf_dir), ["framework"], throughput_col="throughput_tokens_per_second", aggregated=True
    )
    return round_columns(scaled, "throughput_ratio").select("framework", "parallelism", "throughput_ratio")


def comparison(spark, sf_dir):
    """Left: system N. Right: system R up to level 5, with two runs per level, of which the first counts."""
    is_left, is_right = F.col("framework") == "N", F.col("framework") == "R"
    records = system_runs(spark, sf_dir).filter(is_left | is_right & (F.col("parallelism") <= 5))
    batches = records.withColumns({"samples": F.lit(1), "batch": F.when(is_left, F.lit("all")).otherwise(F.col("batch"))})
    order = ["parallelism", "batch"]
    scaled = runs.speedup_and_efficiency(by_level(batches, "batch"), ["framework"], order_by=order, aggregated=True)
    compared = runs.compare_tagged(scaled, is_left, is_right, order_by=["batch"])
    return round_columns(compared, *[name for name in compared.columns if name != "parallelism"])


def level_union(spark, sf_dir):
    records = system_runs(spark, sf_dir)
    return runs.levels(
        records.filter("framework = 'N' and parallelism > 2"),
        records.filter("framework = 'R' and parallelism < 4"),
    )


def distinct_levels(spark, sf_dir):
    return runs.levels(system_runs(spark, sf_dir))


def concatenated(spark, sf_dir):
    """The runs of each system under its own level column, put together again under one."""
    all_runs = levels_of(spark, sf_dir)
    parts = []
    for flag, name in NAMES.items():
        own = all_runs.filter(F.col("framework") == flag).drop("framework")
        own = own.withColumnRenamed("parallelism", f"{name}_level")
        parts.append(runs.tag_runs(own, f"{name}_level", name))
    table_of_runs = runs.sort_runs(runs.concat_runs(*parts))
    return table_of_runs.select("framework", "parallelism", "total_samples", "total_tokens")


def best(spark, sf_dir):
    rows = levels_of(spark, sf_dir).withColumnRenamed("throughput_tokens_per_second", "throughput")
    return round_columns(runs.best_configuration(rows, ["framework", "parallelism"]), "throughput")


def latency(spark, sf_dir):
    return round_columns(
        runs.latency_stats(table(spark, sf_dir, "events"), "value"),
        "total_time",
        "avg_time_per_sample",
        "max_time_per_sample",
        "min_time_per_sample",
    )


def token_latency(spark, sf_dir):
    """Latency and tokens of line items, in hundredths of a second."""
    stats = runs.latency_stats(system_runs(spark, sf_dir), "hundredths", "tokens")
    return round_columns(stats, "avg_time_per_sample", "avg_tokens", "throughput_tokens_per_second")


def _usage(spark, sf_dir):
    return runs.core_usage(table(spark, sf_dir, "events"), "user_id", "value")


def usage(spark, sf_dir):
    return round_columns(_usage(spark, sf_dir), "mean_usage")


def usage_summary(spark, sf_dir):
    return round_columns(
        runs.core_usage_summary(_usage(spark, sf_dir)), "avg_core_usage", "max_core_usage"
    )


def usage_of_arrays(spark, sf_dir):
    """Samples that hold one value per core, as an array."""
    percent = [F.col("l_quantity") * 2, F.rint(F.col("l_discount") * 1000), F.rint(F.col("l_tax") * 1000)]
    samples = table(spark, sf_dir, "lineitem").select(F.array(*percent).alias("per_core"))
    return round_columns(runs.core_usage(runs.core_samples(samples, "per_core")), "mean_usage")


def memory_peak(spark, sf_dir):
    # Time and number as one decimal: a single value to compare keeps this a hash aggregate.
    place = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(38,0)") * F.lit(10**15).cast("decimal(18,0)") + F.col("event_id")
    events = table(spark, sf_dir, "events").withColumn("place", place.cast("decimal(38,0)"))
    peaks = runs.peak_and_increase(events, ["user_id"], "value", ["place"])
    return round_columns(peaks, "first_value", "peak_value", "increase")


QUERIES = {
    "throughput_by_level": throughput,
    "speedup_efficiency": speedup,
    "speedup_first_run_baseline": speedup_without_level_one,
    "throughput_ratio": throughput_ratio,
    "framework_comparison": comparison,
    "levels_union": level_union,
    "levels_distinct": distinct_levels,
    "runs_concatenated": concatenated,
    "best_configuration": best,
    "latency_stats": latency,
    "token_latency_stats": token_latency,
    "core_usage": usage,
    "core_usage_summary": usage_summary,
    "core_usage_arrays": usage_of_arrays,
    "memory_peak": memory_peak,
}

_BY_LEVEL = f"""
WITH {RUNS_SQL},
totals AS (
  SELECT framework, parallelism, count(*) AS total_samples, CAST(sum(tokens) AS BIGINT) AS total_tokens,
         CAST(sum(seconds) AS DOUBLE) AS total_time
  FROM runs GROUP BY framework, parallelism),
levels AS (
  SELECT *, total_samples / total_time AS throughput_samples_per_second,
         total_tokens / total_time AS throughput_tokens_per_second
  FROM totals)"""

ORACLES = {
    "throughput_by_level": f"""{_BY_LEVEL}
SELECT framework, parallelism, total_samples, total_tokens, round(total_time, 6) AS total_time,
       round(throughput_samples_per_second, 6) AS throughput_samples_per_second,
       round(throughput_tokens_per_second, 6) AS throughput_tokens_per_second
FROM levels""",
    "speedup_efficiency": f"""{_BY_LEVEL}
SELECT l.framework, l.parallelism, round(b.total_time / l.total_time, 6) AS speedup,
       round(b.total_time / l.total_time / l.parallelism, 6) AS efficiency
FROM levels l JOIN levels b ON b.framework = l.framework AND b.parallelism = 1""",
    "speedup_first_run_baseline": f"""{_BY_LEVEL},
known AS (SELECT * FROM levels WHERE NOT (framework = 'R' AND parallelism = 1)),
base AS (SELECT framework, arg_min(total_time, parallelism) AS base_time FROM known GROUP BY framework)
SELECT framework, parallelism, round(base_time / total_time, 6) AS speedup,
       round(base_time / total_time / parallelism, 6) AS efficiency
FROM known JOIN base USING (framework)""",
    "throughput_ratio": f"""{_BY_LEVEL}
SELECT l.framework, l.parallelism,
       round(l.throughput_tokens_per_second / b.throughput_tokens_per_second, 6) AS throughput_ratio
FROM levels l JOIN levels b ON b.framework = l.framework AND b.parallelism = 1""",
    "framework_comparison": f"""{_BY_LEVEL},
lhs AS (
  SELECT parallelism, total_time,
         (SELECT total_time FROM levels WHERE framework = 'N' AND parallelism = 1) / total_time AS speedup
  FROM levels WHERE framework = 'N'),
batches AS (
  SELECT parallelism, batch, CAST(sum(seconds) AS DOUBLE) AS total_time
  FROM runs WHERE framework = 'R' AND parallelism <= 5 GROUP BY parallelism, batch),
firsts AS (
  SELECT parallelism, arg_min(total_time, batch) AS total_time FROM batches GROUP BY parallelism),
rhs AS (
  SELECT parallelism, total_time,
         (SELECT total_time FROM firsts WHERE parallelism = 1) / total_time AS speedup
  FROM firsts)
SELECT l.parallelism, round(l.total_time, 6) AS spark_time, round(r.total_time, 6) AS torch_time,
       round(r.total_time / l.total_time, 6) AS time_ratio,
       round(l.speedup, 6) AS spark_speedup, round(r.speedup, 6) AS torch_speedup,
       round(r.speedup / l.speedup, 6) AS speedup_ratio,
       round(l.speedup / l.parallelism, 6) AS spark_efficiency,
       round(r.speedup / r.parallelism, 6) AS torch_efficiency,
       round((r.speedup / r.parallelism) / (l.speedup / l.parallelism), 6) AS efficiency_ratio
FROM lhs l LEFT JOIN rhs r ON r.parallelism = l.parallelism""",
    "levels_union": f"""WITH {RUNS_SQL}
SELECT parallelism FROM runs WHERE framework = 'N' AND parallelism > 2
UNION SELECT parallelism FROM runs WHERE framework = 'R' AND parallelism < 4
ORDER BY parallelism""",
    "levels_distinct": f"WITH {RUNS_SQL} SELECT DISTINCT parallelism FROM runs ORDER BY parallelism",
    "runs_concatenated": f"""{_BY_LEVEL}
SELECT CASE framework WHEN 'A' THEN 'Alpha' WHEN 'N' THEN 'Nova' ELSE 'Rho' END AS framework,
       parallelism, total_samples, total_tokens
FROM levels""",
    "best_configuration": f"""{_BY_LEVEL}
SELECT framework, parallelism, round(throughput_tokens_per_second, 6) AS throughput
FROM levels ORDER BY throughput_tokens_per_second DESC, framework, parallelism LIMIT 1""",
    "latency_stats": """
SELECT count(*) AS total_samples, round(sum(value), 6) AS total_time,
       round(sum(value) / count(*), 6) AS avg_time_per_sample,
       round(max(value), 6) AS max_time_per_sample, round(min(value), 6) AS min_time_per_sample
FROM events""",
    "token_latency_stats": f"""
WITH {RUNS_SQL},
h AS (SELECT CAST(seconds * 100 AS BIGINT) AS h, CAST(tokens AS BIGINT) AS tokens FROM runs)
SELECT count(*) AS total_samples, CAST(sum(h) AS BIGINT) AS total_time,
       round(CAST(sum(h) AS DOUBLE) / count(*), 6) AS avg_time_per_sample,
       max(h) AS max_time_per_sample, min(h) AS min_time_per_sample,
       CAST(sum(tokens) AS BIGINT) AS total_tokens,
       round(CAST(sum(tokens) AS DOUBLE) / count(*), 6) AS avg_tokens, max(tokens) AS max_tokens,
       round(CAST(sum(tokens) AS DOUBLE) / CAST(sum(h) AS DOUBLE), 6) AS throughput_tokens_per_second
FROM h""",
    "core_usage": """
SELECT user_id, round(avg(value), 6) AS mean_usage, count(*) AS samples FROM events GROUP BY user_id""",
    "core_usage_summary": """
WITH u AS (SELECT user_id, avg(value) AS mean_usage, count(*) AS samples FROM events GROUP BY user_id)
SELECT count(*) AS num_cores, count(*) FILTER (WHERE mean_usage > 50) AS active_cores,
       round(avg(mean_usage), 6) AS avg_core_usage, round(max(mean_usage), 6) AS max_core_usage,
       max(samples) AS samples_collected
FROM u""",
    "core_usage_arrays": """
WITH s AS (
  SELECT unnest([0, 1, 2]) AS core,
         unnest([l_quantity * 2, round(l_discount * 1000), round(l_tax * 1000)]) AS percent
  FROM lineitem)
SELECT core, round(avg(percent), 6) AS mean_usage, count(*) AS samples
FROM s GROUP BY core""",
    "memory_peak": """
WITH e AS (
  SELECT user_id, arg_min(value, {'ts': ts, 'id': event_id}) AS first_value, max(value) AS peak_value
  FROM events GROUP BY user_id)
SELECT user_id, round(first_value, 6) AS first_value, round(peak_value, 6) AS peak_value,
       round(peak_value - first_value, 6) AS increase
FROM e""",
}
