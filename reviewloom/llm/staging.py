"""Intermediate tables in the folder that the whole cluster shares."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a session inside one process may do without that setting; it gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="reviewloom-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: ids given out while writing stay what they are, several
    uses share one evaluation, the planner knows the size, and a lost executor costs nothing."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
