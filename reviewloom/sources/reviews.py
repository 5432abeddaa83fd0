"""Reading reviews from JSON Lines."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from reviewloom.operators.sampling import sample_rows
from reviewloom.schemas import REVIEW_SCHEMA
from reviewloom.sources.storage import path_exists

CORRUPT_COLUMN = "corrupt_record"


def read_reviews(
    spark: SparkSession, path: str | list[str], corrupt_column: str | None = None
) -> DataFrame:
    """JSON Lines (plain or ``.gz``) under the declared schema; nothing is inferred.

    Fields that are not declared are dropped, missing ones are null. A line that does not parse
    becomes a row of nulls; with ``corrupt_column`` its text is kept in that column.
    """
    if corrupt_column is None:
        return spark.read.schema(REVIEW_SCHEMA).json(path)
    schema = StructType(list(REVIEW_SCHEMA.fields)).add(corrupt_column, StringType(), True)
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", corrupt_column).json(path)


def split_rejects(
    with_corrupt: DataFrame, corrupt_column: str = CORRUPT_COLUMN
) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not).

    Only columns a query uses are parsed, and an unparsed column cannot be found corrupt. So that
    the split does not depend on what is selected later, it looks at all of them.
    """
    fields = F.array(*[F.col(name).isNull() for name in with_corrupt.columns])
    all_parsed = F.size(fields) > 0
    rejected = F.col(corrupt_column).isNotNull()
    checked = with_corrupt.filter(all_parsed)
    return checked.filter(~rejected).drop(corrupt_column), checked.filter(rejected)


@dataclass(frozen=True)
class Quarantine:
    """Where the lines went, and how many."""

    path: str
    parsed: int
    rejected: int


def quarantine(spark: SparkSession, path: str | list[str], output: str) -> Quarantine:
    """Write the lines that parse and those that do not in one pass: one scan, one stage, two folders below ``output``.

    Both are counted by the stage that writes. Each row keeps the file it came from and the start of its block, a rejected one also
    its text. Blank lines are neither. Read back with ``read_parsed`` and ``read_rejected``.
    """
    lines = read_reviews(spark, path, CORRUPT_COLUMN).select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col(CORRUPT_COLUMN).isNotNull().alias("rejected"),
    )
    counts = Observation()
    counted = lines.observe(
        counts, F.count_if(~F.col("rejected")).alias("parsed"), F.count_if("rejected").alias("rejected_lines")
    )
    counted.write.partitionBy("rejected").parquet(output)
    return Quarantine(output, counts.get["parsed"], counts.get["rejected_lines"])


def read_parsed(spark: SparkSession, written: Quarantine) -> DataFrame:
    """The reviews that parsed, with ``source_file`` and ``block_start``; the rejected files are not opened."""
    return _quarantined(spark, written).filter("NOT rejected").drop(CORRUPT_COLUMN, "rejected")


def read_rejected(spark: SparkSession, written: Quarantine) -> DataFrame:
    """Rejected lines as ``line``, with ``source_file`` and ``block_start``."""
    rows = _quarantined(spark, written).filter("rejected")
    return rows.select(F.col(CORRUPT_COLUMN).alias("line"), "source_file", "block_start")


def _quarantined(spark: SparkSession, written: Quarantine) -> DataFrame:
    schema = StructType(list(REVIEW_SCHEMA.fields)).add(CORRUPT_COLUMN, "string").add("source_file", "string")
    return spark.read.schema(schema.add("block_start", "long").add("rejected", "boolean")).parquet(written.path)


def resolve_dataset(
    spark: SparkSession, dataset: str, root: str = "/", input_file: str | None = None
) -> str:
    """``<root>/<dataset>.jsonl`` (or ``.jsonl.gz``) if it exists, else the user's file, in place."""
    if not dataset:
        raise ValueError("a dataset name is required")
    base = f"{root.rstrip('/')}/{dataset}.jsonl"
    for candidate in (base, f"{base}.gz"):
        if path_exists(spark, candidate):
            return candidate
    if not input_file:
        raise FileNotFoundError(f"{base} does not exist and no input file was given")
    if not path_exists(spark, input_file):
        raise FileNotFoundError(f"input file not found: {input_file}")
    return input_file


def load_reviews(
    spark: SparkSession,
    path: str | list[str],
    ratio: float | None = None,
    count: int | None = None,
    seed: int = 42,
    keys: list[str] | None = None,
) -> DataFrame:
    """Read and, if asked, sample: ratio first, then count. Not sorted, and not cached."""
    return sample_rows(read_reviews(spark, path), ratio, count, seed, keys)
