"""Observed counts stay exact when tasks fail and run again."""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

SCRIPT = textwrap.dedent(
    """
    import json, sys
    sys.path.insert(0, sys.argv[1])
    import pandas as pd
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from reviewloom.functions.lexicon import Lexicon
    from reviewloom.operators.observation import input_aggregates, observe, scored_aggregates
    from reviewloom.operators.scoring import LABELS, LexiconScorer, score

    spark = SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")

    @F.pandas_udf("string")
    def lost_once(texts: pd.Series) -> pd.Series:
        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
            raise RuntimeError("executor lost")
        return texts

    rows = spark.range(1000).select(F.col("id").cast("string").alias("text")).repartition(6)
    rows, seen = observe(rows, "input", input_aggregates())
    scored = score(rows.withColumn("text", lost_once("text")), LexiconScorer(Lexicon(("7",), (), ())), "text")
    scored, totals = observe(scored, "scored", scored_aggregates(LABELS))
    scored.write.csv(sys.argv[2])
    totals = totals.get
    print(json.dumps([seen.get["loaded"], totals["total_reviews"], totals["label_NEG"], totals["total_tokens"]]))
    """
)


def test_repeated_tasks_are_counted_once(tmp_path):
    root = str(Path(__file__).parent.parent)
    command = [sys.executable, "-c", SCRIPT, root, str(tmp_path / "out")]
    done = subprocess.run(command, capture_output=True, text=True, timeout=180, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.splitlines()[-1]) == [1000, 1000, 1, 3000]
