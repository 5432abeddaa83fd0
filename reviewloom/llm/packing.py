"""Packing by concatenate and cut.

The ids of all documents, each with an end id, are thought of as one stream in scan order. The first pass
encodes the texts, writes the ids, and sums them per task; prefix sums over the tasks' totals give
each task its place in the stream. The second pass cuts at every multiple of the sequence length. A piece is a boundary
record: which ids of which document lie where in which sequence. Neither pass shuffles texts or ids, and only the
last sequence of all can have room left.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.llm.staging import staged
from reviewloom.llm.textbytes import slices
from reviewloom.llm.tokens import encoder_for

SEQUENCE_TOKENS = 1024


def encoded(df: DataFrame, text_column: str, tokenizer: str, end_id: int, carry: list[str]) -> DataFrame:
    """First pass, written: ``row`` (the columns of ``carry``), ``ids`` (little-endian 32 bits, end id
    included), ``n_tokens``, the task's number ``part`` and the ids ``before`` it within that task. Null texts are empty."""
    given = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_column}`").alias("text")
    )
    schema = StructType.fromJson(given.select("row").schema.jsonValue())
    schema.add("ids", "binary").add("n_tokens", "long").add("part", "long").add("before", "long")

    def encode(batches):
        encoder = encoder_for(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                ids, first = encoder(texts)
                counts = np.diff(first)
                with_end = np.insert(ids, first[1:], end_id).astype("<u4")
                ends = np.cumsum(counts + 1)
                raw = with_end.tobytes()
                stops = (ends * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([raw[b:e] for b, e in zip([0, *stops], stops, strict=False)], pa.binary()),
                        pa.array(counts + 1),
                        pa.array(np.full(len(texts), part, np.int64)),
                        pa.array(before + ends - counts - 1),
                    ],
                    names=["row", "ids", "n_tokens", "part", "before"],
                )
                before += int(ends[-1])
                at += len(texts)

    return staged(given.mapInArrow(encode, schema), "encoded")


def placed(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``at``, the number of ids before each row in the whole stream.

    The table of bases that is broadcast has one row for each task of the first pass.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("before"))


def pack(
    df: DataFrame,
    tokenizer: str,
    end_id: int,
    text_column: str = "text",
    carry: list[str] | None = None,
    length: int = SEQUENCE_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces: ``row`` (all columns, or those of ``carry``), ``start`` (its document's ids before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, with ``with_ids``, ``ids``.

    A document without text has its end id only. Repeated rows are packed as often as they occur. An empty table gives no
    pieces.
    """
    rows = placed(encoded(df, text_column, tokenizer, end_id, carry or df.columns)).select("row", "ids", "at")
    schema = StructType.fromJson(rows.select("row").schema.jsonValue())
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema.add(name, "long")
    if with_ids:
        schema.add("ids", "binary")

    def cut(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            for begin in range(0, batch.num_rows, 1000):
                some = batch.slice(begin, 1000)
                yield from _pieces(some.column(0), some.column(1), at[begin : begin + 1000], length, with_ids)

    return rows.mapInArrow(cut, schema)


def _pieces(row: pa.Array, ids: pa.Array, at: np.ndarray, length: int, with_ids: bool):
    raw = ids.to_pylist()
    total = np.array([len(x) // 4 for x in raw], np.int64)
    first, last = at // length, (at + total - 1) // length
    n = last - first + 1
    which = np.repeat(np.arange(len(raw)), n)
    sequence = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[which]
    start = np.maximum(sequence * length - at[which], 0)
    stop = np.minimum((sequence + 1) * length - at[which], total[which])
    parts = [raw[i][4 * b : 4 * e] for i, b, e in zip(which.tolist(), start.tolist(), stop.tolist(), strict=True)]
    columns = [
        row.take(pa.array(which)),
        pa.array(start),
        pa.array(stop - start),
        pa.array([zlib.crc32(x) for x in parts], pa.int64()),
        pa.array(total[which]),
        pa.array(sequence),
        pa.array(at[which] + start - sequence * length),
    ]
    names = ["row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        columns.append(pa.array(parts, pa.binary()))
        names.append("ids")
    yield pa.RecordBatch.from_arrays(columns, names=names)


def sequences(pieces: DataFrame, pad_id: int, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``ids``: the pieces of each sequence together, padded to ``length``
    unless their number of ids is a power of two. A sequence has at most ``length`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["ids"]), "")
    pad = F.hex(F.lit(int(pad_id).to_bytes(4, "little")))
    power = F.expr("bit_count(n_tokens) = 1")
    padded = F.when(power, joined).otherwise(F.concat(joined, F.expr("repeat('@', 0)"), F.repeat(pad, (length - F.col("n_tokens")).cast("int"))))
    return whole.select("sequence_id", "n_tokens", F.unhex(padded).alias("ids"))
