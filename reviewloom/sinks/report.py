"""Text reports over small result tables, one line per row, made from the tables' own columns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from reviewloom.sinks.csv import write_single_text


def table_lines(df: DataFrame, title: str, digits: int = 4) -> DataFrame:
    """(line_no, line): the title, then every row as ``column value, column value``.

    Rows are in the order of their columns. Null reads ``n/a``, fractions are rounded.
    """
    columns = [f"`{name}`" for name in df.columns]
    rows = df.select(
        F.row_number().over(Window.orderBy(*columns)).alias("line_no"),
        F.concat_ws(", ", *[_item(field, digits) for field in df.schema.fields]).alias("line"),
    )
    head = df.sparkSession.range(1).select(F.lit(0).alias("line_no"), F.lit(title).alias("line"))
    return head.unionByName(rows)


def write_report(sections: dict[str, DataFrame], directory: str, name: str) -> str:
    """The tables of ``sections`` under their titles. They are aggregates, so one task writes them."""
    numbered = [
        table_lines(df, title).withColumn("section", F.lit(number))
        for number, (title, df) in enumerate(sections.items())
    ]
    lines = numbered[0]
    for more in numbered[1:]:
        lines = lines.unionByName(more)
    ordered = lines.coalesce(1).sortWithinPartitions("section", "line_no")
    return write_single_text(ordered.select("line"), directory, name)


def _item(field, digits: int) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, FractionalType):
        value = F.round(value.cast("double"), digits)
    return F.concat(F.lit(f"{field.name} "), F.coalesce(value.cast("string"), F.lit("n/a")))
