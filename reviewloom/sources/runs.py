"""Reading run metrics and written results."""

import csv
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from reviewloom.schemas import (
    CORE_RUN_SCHEMA,
    SCORE_STATS_SCHEMA,
    SUMMARY_SCHEMA,
    THREAD_RUN_SCHEMA,
    TOKEN_STATS_SCHEMA,
)

# Null is written as \N, so that it differs from an empty text; a text that looks like it gets one
# more backslash in front. Texts may hold line breaks.
NULL_MARKER = "\\N"
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_MARKER,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# What ``position_col`` holds.
PLACE_TYPE = "struct<file_path: string, file_block_start: bigint, row: bigint>"


def read_metrics_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, position_col: str | None = None
) -> DataFrame:
    """One table out of one or many metric files, each with a header of its own.

    Columns are found by name: a header may order them differently, lack some, or have others,
    which are dropped; of two columns of one name the first counts. A column that some files lack is null
    in their rows, one that all lack is missing. Files of equal headers share a scan, which opens no others.
    ``position_col`` keeps the order of the rows: by file path, then as they stand in the file.
    Files without a line give no rows; if there are no others, all declared columns are there.
    """
    tables = [_read_alike(spark, path, header, files, schema, position_col) for header, files in _files_by_header(spark, path)]
    if not tables:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(position_col, F.lit(None).cast(PLACE_TYPE)) if position_col else empty
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    names = [name for name in schema.names if name in united.columns]
    return united.select(*names, *([position_col] if position_col else []))


def _files_by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[str, list[str]]]:
    """Each distinct first line, with the files that have it. The file names pass through the driver, as in any listing."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    first = lines.filter("start = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "row").alias("header"))
    alike = first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("header")
    return [(row["header"], row["files"]) for row in alike.collect()]


def _read_alike(
    spark: SparkSession, path: str | list[str], header: str, files: list[str], schema: StructType, position_col: str | None
) -> DataFrame:
    """The rows of ``files``, which are among those of ``path`` and begin with ``header``."""
    declared = {field.name: field for field in schema.fields}
    names = []
    for place, name in enumerate(next(csv.reader([header.removeprefix("\ufeff")]))):
        names.append(f"{name}_{place}" if name in names else name)
    whole = StructType([declared.get(name, StructField(name, StringType())) for name in names])
    rows = spark.read.options(header="true", quote='"', escape='"').schema(whole).csv(path)
    columns = [F.col(name) for name in schema.names if name in names]
    if position_col:
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
        columns.append(place.cast(PLACE_TYPE).alias(position_col))
    return rows.filter(F.col("_metadata.file_path").isin(files)).select(*columns)


def read_core_runs(
    spark: SparkSession, path: str | list[str], position_col: str | None = None
) -> DataFrame:
    return read_metrics_csv(spark, path, CORE_RUN_SCHEMA, position_col)


def read_thread_runs(
    spark: SparkSession, path: str | list[str], position_col: str | None = None
) -> DataFrame:
    """Thread runs, with ``per_core_usage`` as an array."""
    runs = read_metrics_csv(spark, path, THREAD_RUN_SCHEMA, position_col)
    if "per_core_usage" not in runs.columns:
        return runs
    return runs.withColumn("per_core_usage", F.from_json("per_core_usage", ArrayType(DoubleType())))


def read_run_summaries(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The summaries of several jobs as one table, each with the name of its configuration."""
    tables = [
        read_metrics_csv(spark, path, SUMMARY_SCHEMA).withColumn("config_name", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_run_statistics(spark: SparkSession, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """The score and token statistics that several jobs wrote, one row for each job, with its name as ``run``:
    what ``operators.statistics.merge_statistics`` takes. ``paths`` holds the two files of each job."""

    def named(index: int, schema: StructType) -> DataFrame:
        tables = [spark.read.schema(schema).options(**CSV_OPTIONS).csv(files[index]).withColumn("run", F.lit(name)) for name, files in paths.items()]
        return reduce(DataFrame.unionByName, tables)

    return named(0, SCORE_STATS_SCHEMA).join(named(1, TOKEN_STATS_SCHEMA), "run")


def read_results_csv(spark: SparkSession, path: str | list[str], schema: StructType, split: bool = False) -> DataFrame:
    """Read back what ``sinks.csv`` wrote: the same rows, line breaks and empty texts included.

    Each file is read by one task, or with ``split`` by many, for large files without a codec; that takes one more pass.
    """
    if split:
        parsed = F.from_csv("record", schema.simpleString(), {**CSV_OPTIONS, "multiLine": "true"})
        rows = _records(spark, path).select(parsed.alias("row")).select("row.*")
    else:
        rows = spark.read.schema(schema).options(multiLine="true", **CSV_OPTIONS).csv(path)
    return _map_strings(rows, lambda text: F.when(_looks_null(text), F.substr(text, F.lit(2))).otherwise(text))


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``record``: the text of each CSV record but the first of a file, however many lines it has.

    All quotes before a line, also those that stand for one in a text, are even in number if the line begins a record. So they are counted for every split
    first. A record that lies in several splits comes as pieces, at most two from each split, which are joined.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )
    quotes = F.sum((F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).cast("bigint"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    splits = lines.groupBy("file", "start").agg(quotes.alias("quotes"))
    inside = {(r["file"], r["start"]): r["open"] for r in splits.select("file", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("open")).collect()}
    known = spark.sparkContext.broadcast(inside)  # one entry for each split

    def cut(batches):
        at, pieces, is_open, continues, number = None, [], False, False, 0

        def ended():  # what a split leaves of a record that goes on in the next
            return [("\n".join(pieces), *at, number, True, not continues)] if pieces else []

        for batch in batches:
            out = []
            for file, start, line in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (file, start) != at:
                    out += ended()
                    at, pieces, is_open, number = (file, start), [], known.value[file, start], 0
                    continues = is_open
                pieces.append(line)
                is_open ^= line.count('"') % 2 == 1
                if not is_open:
                    out.append(("\n".join(pieces), file, start, number, continues, False))
                    pieces, continues, number = [], False, number + 1
            yield _as_batch(out)
        yield _as_batch(ended())

    cut_lines = lines.mapInArrow(cut, "record string, file string, start bigint, number bigint, torn boolean, begins boolean")
    found = cut_lines.filter("record <> '' OR torn")
    whole = found.filter("NOT torn AND NOT (start = 0 AND number = 0)").select("record")
    order = Window.partitionBy("file").orderBy("start", "number")
    grouped = found.filter("torn").withColumn("which", F.sum(F.col("begins").cast("int")).over(order))
    joined = grouped.groupBy("file", "which").agg(F.array_sort(F.collect_list(F.struct("start", "number", "record"))).alias("pieces"))
    return whole.unionByName(joined.select(F.array_join(F.col("pieces.record"), "\n").alias("record")))


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
    names = ["record", "file", "start", "number", "torn", "begins"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def escape_nulls(df: DataFrame) -> DataFrame:
    """Texts made of backslashes and an N get one more backslash, so that none equals the marker."""
    return _map_strings(
        df, lambda text: F.when(_looks_null(text), F.concat(F.lit("\\"), text)).otherwise(text)
    )


def _looks_null(text: Column) -> Column:
    return text.startswith("\\") & text.rlike(r"^\\+N\z")


def _map_strings(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
