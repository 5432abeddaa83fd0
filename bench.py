"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores, ``BENCH_ROUNDS``
how often each query is timed (the best time counts). ``scaling`` has the seconds of one query in sessions of
1, 2, 4 and all of the cores, and how much of the ideal speedup that is.
"""

import json
import os
import subprocess
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewloom.queries import all_queries  # noqa: E402
from reviewloom.session import local_session  # noqa: E402

HEADLINES = [
    "clean_text",
    "clean_mask_counts",
    "rejection_report",
    "sample_ratio",
    "sample_count",
    "score_lexicon",
    "score_udf_errors",
    "sentiment_distribution",
    "score_stats",
    "token_stats",
    "run_summary",
    "observed_counts",
    "throughput_by_level",
    "speedup_efficiency",
    "framework_comparison",
    "core_usage_summary",
    "memory_peak",
    "jsonl_roundtrip",
    "csv_roundtrip",
    "review_job_distribution",
]


SCALED = "score_lexicon"


def seconds_of(spark, query, sf_dir: str, rounds: int) -> float:
    times = []
    for _ in range(rounds):
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def session(cores: str):
    spark = local_session(cores, "bench", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scaling(cores: int) -> dict:
    """Each number of cores in a process of its own."""
    levels = sorted({n for n in (1, 2, 4, cores) if n <= cores})
    seconds = {}
    for n in levels:
        ran = subprocess.run([sys.executable, __file__, "--cores", str(n)], capture_output=True, text=True, check=True)
        seconds[n] = float(ran.stdout.strip().splitlines()[-1])
    return {str(n): {"sec": s, "efficiency": round(seconds[1] / s / n, 2)} for n, s in seconds.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "2"))
    queries = all_queries()
    if sys.argv[1:2] == ["--cores"]:
        print(seconds_of(session(sys.argv[2]), queries[SCALED], sf_dir, rounds))
        return
    spark = session(cores)
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start-up is not part of any query
    seconds = {name: seconds_of(spark, queries[name], sf_dir, rounds) for name in HEADLINES}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "scaling": {SCALED: scaling(int(cores))},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
