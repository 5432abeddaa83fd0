"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

The words of a source are dealt into shards (documents by the hash of seed and id), so that no
shard is large, and each shard is a ring of words in hash order. The mix is made of blocks of equal
length: seats are apportioned to the sources by the highest quotients ``target / (2 * seats + 1)``, then
the seats of a source to its shards in the same way by size. A shard takes its seats as consecutive
blocks from a seeded block on, around the ring as often as needed. Hash order is random, so a run of
blocks is a random choice of text, and what a document contributes follows from its interval alone:
no row is made for a block.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.staging import staged

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text: each word with the blanks around it becomes one character."""
    marks = F.length(F.regexp_replace(text, f"{BLANK}*+{WORD}++{BLANK}*+", "x"))
    return F.when(text.rlike(WORD), marks).otherwise(0).cast("bigint")


def targets(sources: DataFrame, weights: tuple = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source``, ``source_size`` -> with ``target``: the total shared by weight, at most ``most`` sizes each.

    Sources in code point order (null last) weigh ``weights`` in turn. The water level at which the
    targets add up is found on the sources sorted by the level at which each would be full. There is one row
    for each source, so the windows over all of them stay small.
    """
    # UTF-8 bytes sort like code points, whatever the collation.
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    everything = Window.partitionBy()
    weighed = sources.select("source", "source_size", weight.alias("weight"), F.row_number().over(by_name).alias("turn"))
    full = F.lit(float(most)) * F.col("source_size")
    filling = Window.orderBy(full / F.col("weight"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything).cast("double")
    left = total - F.coalesce(F.sum(full).over(filling), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0))
    levelled = weighed.withColumn("level", left / open_weight).withColumn("full_at", full / F.col("weight"))
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "turn", "level"))).over(everything)
    return levelled.select(
        "source",
        "source_size",
        F.least(full, F.col("weight") * level["level"]).alias("target"),
    )


def apportion(claims: DataFrame, within: list[str], names: list[str], share: str, seats: str) -> DataFrame:
    """Sainte-Lague: ``claims`` with an integer ``quota``; per group of ``within`` the quotas add up to ``seats``
    (which is the same in all rows of a group), unless all shares are 0.

    A divisor that is surely too large gives each claim seats that it has in any case, one that is
    surely too small the most it can get. Between the two lie about two seats for each claim; the
    highest quotients ``share / (2 * seat - 1)`` of these get what is left.
    """
    group = Window.partitionBy(*within)
    ahead = group.orderBy(
        F.col("_possible").desc(), (F.col(share) / (2 * F.col("_seat") - 1)).desc(), *names
    )
    total, n = F.sum(share).over(group).cast("double"), F.count(F.lit(1)).over(group)
    at = lambda number: F.floor(F.col(share) / total * number + 0.5)
    return (
        claims.withColumn("_sure", F.when(total > 0, at(F.greatest(F.col(seats) - n / 2 - 1, F.lit(0.0)))).otherwise(0))
        .withColumn("_most", F.when(total > 0, at(F.col(seats) + n / 2 + 1)).otherwise(0))
        .withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
        .withColumn("_seat", F.explode(F.sequence(F.col("_sure") + 1, F.greatest("_most", F.col("_sure") + 1))))
        .withColumn("_possible", F.col("_seat") <= F.col("_most"))
        .withColumn("_won", F.col("_possible") & (F.row_number().over(ahead) <= F.col("_left")))
        .groupBy(*claims.columns, "_sure")
        .agg(F.count_if("_won").alias("_won"))
        .select(*claims.columns, (F.col("_sure") + F.col("_won")).cast("bigint").alias("quota"))
    )


def _number(*parts) -> Column:
    """A reproducible number of 60 bits, the same in other engines: the head of an MD5."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def mix(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    carry: list[str] | None = None,
    weights: tuple = (1, 2, 3),
    most: int = 3,
    block_words: int = 1,
    seed: str = "mix",
    shard_rows: int = 2000,
) -> DataFrame:
    """``row`` (all columns of ``df``, or those of ``carry``), ``size``, ``source_size``, ``target``,
    ``taken``, and which words: ``passes`` over the whole text, then those from ``head`` and ``tail``
    intervals ``[first, last)`` of word numbers (empty where first >= last).

    A null text has no words. A null source is a source of its own. Rows without an id are spread by
    their text. A text of the mix is taken at most ``most`` times. No row is dropped; an empty table gives no rows.
    What a source gives is within one block and a word of its target, so by default small sources keep their share; larger blocks mean
    fewer, longer cuts of the seats, not of the texts. There is a row for each source in one task, so sources may be some millions.
    """
    text, source = F.col(f"`{text_column}`"), F.col(f"`{source_column}`")
    key = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.md5(text), F.lit(""))
    sized = staged(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("row"),
            source.alias("source"),
            F.coalesce(word_count(text), F.lit(0).cast("bigint")).alias("size"),
            key.alias("key"),
            _number(seed, key).alias("place"),
        ),
        "sized",
    )
    by_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    wanted = targets(by_source.select("source", "source_size"), weights, most)
    # Null sources meet as (true, '').
    named = [F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name")]
    blocks = F.sum("source_size").over(Window.partitionBy()) / block_words
    seats = apportion(
        wanted.select(*named, "source_size", "target", F.round(blocks).alias("blocks")),
        [], ["unnamed", "name"], "target", "blocks",
    )
    per_source = staged(
        seats.withColumn("seats", F.least("quota", F.expr(f"({most} * source_size + {block_words} - 1) div {block_words}")))
        .join(by_source.select(*named, F.ceil(F.col("rows") / shard_rows).alias("shards")), ["unnamed", "name"])
        .select("unnamed", "name", "source_size", "target", "seats", "shards"),
        "per-source",
    )
    dealt = (
        sized.select("row", *named, "size", "key", "place")
        .join(per_source, ["unnamed", "name"])
        .withColumn("shard", F.col("place") % F.col("shards"))
    )
    shard = ["unnamed", "name", "shard"]
    per_shard = apportion(
        dealt.groupBy(*shard).agg(F.sum("size").alias("shard_size"), F.first("seats").alias("seats")),
        ["unnamed", "name"], ["shard"], "shard_size", "seats",
    )
    words = F.least(F.col("quota") * block_words, F.expr(f"{most} * shard_size"))
    start = _number(seed, "start", F.col("name"), F.col("shard")) % F.greatest(
        F.expr(f"shard_size div {block_words}"), F.lit(1)
    )
    rings = per_shard.select(*shard, "shard_size", words.alias("words"), (start * block_words).alias("start"))
    before = F.sum("size").over(
        Window.partitionBy(*shard).orderBy("place", "key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("size")
    placed = (
        dealt.join(rings, shard)
        .withColumn("at", before)
        .withColumn("passes", F.when(F.col("shard_size") > 0, F.expr("words div nullif(shard_size, 0)")).otherwise(0))
        .withColumn("stop", F.col("start") + F.col("words") - F.col("passes") * F.col("shard_size"))
    )
    inside = lambda low, high: F.struct(
        F.greatest(low - F.col("at"), F.lit(0)).alias("first"),
        F.least(high - F.col("at"), F.col("size")).alias("last"),
    )
    length = lambda span: F.greatest(F.col(f"{span}.last") - F.col(f"{span}.first"), F.lit(0))
    return (
        placed.withColumn("tail", inside(F.col("start"), F.least("stop", "shard_size")))
        .withColumn("head", inside(F.lit(0), F.col("stop") - F.col("shard_size")))
        .select(
            "row", "size", "source_size", "target",
            (F.col("passes") * F.col("size") + length("head") + length("tail")).alias("taken"),
            "passes", "head", "tail",
        )
    )


def mixed_rows(mixture: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """The documents of a mixture, with the columns of its ``row``: as many whole copies as there are passes,
    then the words taken besides, as they stand in the text; only the first and last documents of a shard's run are cut.
    """
    pieces = F.regexp_extract_all(F.col(f"row.`{text_column}`"), F.lit(f"{BLANK}*+{WORD}++"), F.lit(0))
    part = lambda s: F.array_join(F.slice(pieces, F.col(f"{s}.first").cast("int") + 1, (F.col(f"{s}.last") - F.col(f"{s}.first")).cast("int")), "")
    text = F.col(f"row.`{text_column}`")
    whole = F.transform(F.sequence(F.lit(1), F.col("passes").cast("int")), lambda _: text)
    spans = [
        F.when(F.col(f"{s}.last") - F.col(f"{s}.first") == F.col("size"), F.array(text))
        .when(F.col(f"{s}.last") > F.col(f"{s}.first"), F.array(part(s)))
        .otherwise(F.array().cast("array<string>"))
        for s in ("head", "tail")
    ]
    copies = F.when(F.col("passes") > 0, whole).otherwise(F.array().cast("array<string>"))
    texts = mixture.filter("size > 0").select("row", F.explode(F.concat(copies, *spans)).alias("taken_text"))
    changed = [
        F.col("taken_text").alias(c) if c == text_column
        else F.length("taken_text").cast("bigint").alias(c) if c == length_column
        else F.col(f"row.`{c}`").alias(c)
        for c in mixture.select("row.*").columns
    ]
    return texts.select(*changed)
