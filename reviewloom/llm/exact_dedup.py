"""Exact duplicates by composable polynomial fingerprints.

A text's bytes are cut into chunks counted from the end. Each chunk is hashed by itself, as a
polynomial in a fixed base modulo three primes, and the hashes are put together by shifting each
one by the length of what follows it: ``H(ab) = H(a) * base**len(b) + H(b)``. All chunks of a batch
are hashed by one matrix product, so a huge text is as many independent pieces of work as it has
chunks. Rows whose fingerprint and length occur more than once are then compared with the row that
would stay, chunk by chunk, so that no two whole texts need to lie side by side.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.staging import staged
from reviewloom.llm.textbytes import slices, utf8

CHUNK_BYTES = 4096  # of a chunk hash: 4096 * 255 * 2**31 < 2**53, exact in double precision
COMPARED_BYTES = 65536  # of a chunk in the comparison
PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (1103515245, 1566083941, 1812433253)


class Fingerprinter:
    """Chunk hashes, and how they are put together."""

    def __init__(self, primes=PRIMES, bases=BASES, chunk: int = CHUNK_BYTES):
        self.primes, self.bases, self.chunk = primes, bases, chunk
        powers = [[pow(b, chunk - 1 - i, p) for i in range(chunk)] for p, b in zip(primes, bases, strict=True)]
        self._powers = np.array(powers, np.float64).T
        self._steps = [np.ones(1, np.uint64) for _ in primes]  # base**(chunk * k)

    def _shift(self, which: int, k: np.ndarray) -> np.ndarray:
        steps = self._steps[which]
        if len(k) and (most := int(k.max())) >= len(steps):
            p, step = self.primes[which], pow(self.bases[which], self.chunk, self.primes[which])
            more = [int(x) for x in steps]
            while len(more) <= most:
                more.append(more[-1] * step % p)
            self._steps[which] = steps = np.array(more, np.uint64)
        return steps[k]

    def chunk_hashes(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One row of residues for each chunk ``data[begin:end]`` (at most ``chunk`` bytes)."""
        out = np.empty((len(begins), len(self.primes)), np.uint64)
        padded = np.concatenate([np.zeros(self.chunk, np.uint8), data])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.chunk)
        place = np.arange(self.chunk)
        for i in range(0, len(begins), 256):
            b, e = begins[i : i + 256], ends[i : i + 256]
            block = np.where(place >= self.chunk - (e - b)[:, None], windows[e], 0)
            out[i : i + 256] = np.round(block.astype(np.float64) @ self._powers).astype(np.uint64)
        return out % np.array(self.primes, np.uint64)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of residues for each text; that of the empty text is 0."""
        lengths = np.diff(offsets)
        n_chunks = -(-lengths // self.chunk)
        first = np.cumsum(n_chunks) - n_chunks
        text = np.repeat(np.arange(len(lengths)), n_chunks)
        following = n_chunks[text] - 1 - (np.arange(len(text)) - first[text])  # chunks after this one
        ends = offsets[1:][text] - following * self.chunk
        begins = np.maximum(ends - self.chunk, offsets[:-1][text])
        hashes = self.chunk_hashes(data, begins, ends)
        out = np.zeros((len(lengths), len(self.primes)), np.uint64)
        full = np.flatnonzero(n_chunks)
        for which, p in enumerate(self.primes):
            shifted = hashes[:, which] * self._shift(which, following) % np.uint64(p)
            if len(full):
                out[full, which] = np.add.reduceat(shifted, first[full]) % np.uint64(p)
        return out

    def combine(self, left: tuple, right: tuple, right_length: int) -> tuple:
        """Fingerprint of two texts one after the other, from theirs."""
        return tuple(
            (int(a) * pow(b, right_length, p) + int(c)) % p
            for a, c, b, p in zip(left, right, self.bases, self.primes, strict=True)
        )


def fingerprint(text: str | Column, primes=PRIMES, bases=BASES) -> Column:
    """Fixed-length binary fingerprint of a whole text, with its length in bytes; null counts as empty."""
    made = []

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Fingerprinter(primes, bases))
        prints = []
        for part in slices(texts):
            data, offsets = utf8(part)
            rows = np.column_stack([made[0](data, offsets), np.diff(offsets).astype(np.uint64)])
            prints += [row.tobytes() for row in rows]
        return pa.array(prints, pa.binary())

    return of(F.col(text) if isinstance(text, str) else text)


def exact_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: list[str] | None = None,
    primes=PRIMES,
    bases=BASES,
) -> DataFrame:
    """Rows of ``df`` as ``row`` (all columns, or those of ``carry``, the id among them), with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts (identical bytes; null counts as empty) one row stays: that with the largest id,
    null ids last, any one of rows that also share the id. Nothing is dropped. ``row`` keeps columns
    of whatever name. An empty table gives no rows.

    Whole texts are shuffled only where the groups with copies are too many for the planner's
    broadcast limit; members of such groups are written once, so that their row numbers stay.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    kept_columns = [F.col(f"`{c}`") for c in carry or df.columns]
    rows = df.select(F.struct(*kept_columns).alias("row"), text.alias("text"))
    prints = rows.select(fingerprint("text", primes, bases).alias("print"))
    copied = prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print")
    copied = staged(copied, "copied").withColumn("copied", F.lit(True))
    marked = rows.withColumn("print", fingerprint("text", primes, bases)).join(copied, "print", "left")
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    both = staged(
        marked.select(
            "row",
            "print",
            sha.alias("text_sha256"),
            F.when(F.col("copied"), F.col("text")).alias("text"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "members",
    )
    id_of = F.col(f"row.`{id_column}`")
    alone = both.filter("text IS NULL").select(
        "row",
        id_of.alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    members = both.filter("text IS NOT NULL")
    order = F.struct(id_of.isNotNull().alias("known"), id_of.alias("id"), F.col("number"))
    heads = members.groupBy("print").agg(F.max(order).alias("head"))
    equal = _equal_to_head(members, heads)
    # The key of a class: equal to the head, or (fingerprints that collide) the content itself.
    seen = members.select("row", "print", "text_sha256", "number", "text").join(equal, "number")
    collided = seen.filter(~F.col("equal"))
    by_content = collided.withColumn("class", F.col("text")).drop("text")
    by_head = seen.filter("equal").withColumn("class", F.lit(None).cast("string")).drop("text")
    keyed = by_head.unionByName(by_content)
    classes = keyed.groupBy("print", "class").agg(
        F.max(order).alias("stays"), F.count(F.lit(1)).alias("group_size")
    )
    same = F.col("k.print").eqNullSafe(F.col("c.print")) & F.col("k.class").eqNullSafe(F.col("c.class"))
    grouped = (
        keyed.alias("k")
        .join(classes.alias("c"), same)
        .select(
            "k.row",
            F.col("c.stays.id").alias("keep_id"),
            "c.group_size",
            (F.col("k.number") == F.col("c.stays.number")).alias("kept"),
            "k.text_sha256",
        )
    )
    return alone.unionByName(grouped)


def _equal_to_head(members: DataFrame, heads: DataFrame) -> DataFrame:
    """``number`` of each member, and whether its text is that of its group's head.

    Both sides are cut into chunks, which meet by fingerprint and place.
    """
    pieces = F.expr(
        f"posexplode(transform(sequence(0, greatest(octet_length(text) - 1, 0) div {COMPARED_BYTES}), "
        f"i -> substring(encode(text, 'UTF-8'), i * {COMPARED_BYTES} + 1, {COMPARED_BYTES})))"
    )
    cut = members.select("print", "number", pieces.alias("place", "piece"))
    head_cut = members.join(
        heads.select(F.col("head.number").alias("number")), "number", "left_semi"
    ).select("print", pieces.alias("place", "head_piece"))
    met = cut.join(head_cut, ["print", "place"])
    return met.groupBy("number").agg(F.bool_and(F.col("piece") == F.col("head_piece")).alias("equal"))
