"""Phrase collocations from one FM-index per shard of the corpus.

A shard is some megabytes of whole texts as a sequence of word ids, with a separator (0) wherever a phrase must end. It is
indexed in both directions by a Burrows-Wheeler transform whose rows are sorted as deep as the longest phrase. All phrases of one
length are a set of bidirectional intervals; extending all of them by one word to the right or left reads the transform once
and gives each longer phrase's interval, whose size is its count. Counts of a phrase are summed over shards.

Lengths are worked off one after the other. A phrase can only reach ``min_count`` if its words, and then all its shorter parts, do. So after
each length a shard learns which of its own phrases did, all shards together, and extends only those. No shard
holds a global table, and phrases are told apart by the ids of their parts, never by a hash.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.staging import staged
from reviewloom.llm.terms import pack, runs, unpack
from reviewloom.llm.textbytes import coded, lower_ascii, ragged, slices, span_values, utf8

SHARD_BYTES = 8_000_000
NO_LANGUAGE = "und"
SALTS = 64
_NUMBER_BITS = 30  # for the numbers of one shard's phrases; the others hold the shard
_SHARDS_OF_TASK = 1 << 12
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORDS = ~_BREAKS
_WORDS[[0x20, 0x09]] = False


def sequence(texts: pa.Array, languages: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """Word numbers (from 1; 0 before each piece), and language, word and count of each number.

    The same word in two languages has two numbers.
    """
    data, offsets = utf8(texts)
    data = lower_ascii(data)
    starts, ends, first = runs(_WORDS[data], offsets)
    word, words = coded(span_values(data, starts, ends))
    language, names = coded(languages)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs, codes = np.unique(language[owner] * max(len(words), 1) + word, return_inverse=True)
    breaks = np.cumsum(_BREAKS[data])
    piece = (breaks[starts] if len(starts) else breaks[:0]) + owner
    at = np.flatnonzero(np.diff(piece, prepend=-1))
    of_language, of_word = np.divmod(pairs, max(len(words), 1))
    return np.insert(codes + 1, at, 0), names.take(pa.array(of_language)), words.take(pa.array(of_word)), np.bincount(codes, minlength=len(pairs))


class Side:
    """One direction: rows of all positions, sorted by the ``depth`` symbols from there on, with the symbol before each.

    ``begin[c]`` is the first row that starts with ``c``, ``back[row]`` the row that starts one symbol earlier.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        padded = np.concatenate([text, np.zeros(depth, text.dtype)])
        if symbols ** depth < 2**63:
            key = padded[: len(text)].copy()
            for k in range(1, depth):
                key = key * symbols + padded[k : k + len(text)]
            order = np.argsort(key)
        else:
            order = np.lexsort([padded[k : k + len(text)] for k in reversed(range(depth))])
        self.before = text[order - 1]
        self.begin = np.searchsorted(text[order], np.arange(symbols + 1))
        self.back = np.empty(len(text), np.int64)
        # Rows of one symbol keep their order when that symbol is put in front.
        self.back[np.argsort(self.before, kind="stable")] = np.arange(len(text))


class ShardIndex:
    """Bidirectional FM-index of a sequence of symbols from 1 to ``symbols - 1``, with 0 as the separator."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        text = np.concatenate([[0], text, [0]]).astype(np.int64)  # so that what is before the first position is a separator
        self.symbols = symbols
        self.forward = Side(text, symbols, depth)
        self.reverse = Side(text[::-1], symbols, depth)

    def single(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval starts in both directions, and sizes, of the symbols from 1 on."""
        begin = self.forward.begin[1:-1]
        return begin, self.reverse.begin[1:-1], np.diff(self.forward.begin)[1:]

    def left(self, forward: np.ndarray, reverse: np.ndarray, size: np.ndarray):
        """All extensions of the intervals by one symbol before: parent, symbol, then the new intervals."""
        return self._extended(self.forward, forward, reverse, size)

    def right(self, forward: np.ndarray, reverse: np.ndarray, size: np.ndarray):
        parent, symbol, reverse, forward, size = self._extended(self.reverse, reverse, forward, size)
        return parent, symbol, forward, reverse, size

    def _extended(self, side: Side, own: np.ndarray, other: np.ndarray, size: np.ndarray):
        rows = ragged(own, size)
        parent = np.repeat(np.arange(len(own)), size)
        symbol = side.before[rows]
        order = np.argsort(parent * self.symbols + symbol, kind="stable")
        parent, symbol, rows = parent[order], symbol[order], rows[order]
        new = np.ones(len(order), bool)
        new[1:] = (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(order)))
        # In the other direction the extensions lie side by side inside the parent's interval, by symbol.
        within = at - (np.cumsum(size) - size)[parent[at]]
        real = symbol[at] > 0
        at, counts, within = at[real], counts[real], within[real]
        return parent[at], symbol[at], side.back[rows[at]], other[parent[at]] + within, counts


class Level:
    """The phrases of one length in a shard: their intervals and the numbers of their parts in the level before."""

    def __init__(self, intervals, prefix, suffix, first):
        self.intervals, self.prefix, self.suffix, self.first = intervals, prefix, suffix, first

    def keep(self, chosen: np.ndarray) -> "Level":
        return Level(tuple(part[chosen] for part in self.intervals), self.prefix[chosen], self.suffix[chosen], self.first[chosen])


def levels(text: np.ndarray, frequent: list[np.ndarray], max_words: int) -> Level:
    """The phrases of ``len(frequent) + 1`` words. ``frequent[0]`` holds the numbers of the words that are frequent in the corpus, the
    others the numbers, in these very lists, of frequent phrases of two, three, ... words."""
    count = int(text.max(initial=0)) + 1
    renumber = np.zeros(count, np.int64)
    renumber[frequent[0]] = np.arange(1, len(frequent[0]) + 1)
    # Rare words become separators: no phrase with them can be frequent.
    index = ShardIndex(renumber[text], len(frequent[0]) + 1, max_words)
    own = np.arange(len(frequent[0]))
    level = Level(index.single(), own, own, own)
    parent, symbol, *intervals = index.right(*level.intervals)
    level = Level(tuple(intervals), parent, symbol - 1, parent)
    for chosen in frequent[1:]:
        kept = level.keep(chosen)
        parent, symbol, *intervals = index.left(*kept.intervals)
        first = symbol - 1
        # The phrase without its last word must be frequent too: a phrase of ``kept`` that starts with the new word
        # and goes on with the prefix of the parent.
        width = len(frequent[0])
        keys = kept.suffix * width + kept.first
        order = np.argsort(keys)
        wanted = kept.prefix[parent] * width + first
        place = np.searchsorted(keys, wanted, sorter=order)
        place[place == len(keys)] = 0
        good = keys[order[place]] == wanted if len(keys) else np.zeros(len(wanted), bool)
        prefix = order[place] if len(keys) else place
        level = Level(tuple(intervals), prefix, parent, first).keep(good)
    return level


def _sequences(df: DataFrame, shard_bytes: int) -> DataFrame:
    """Rows of two kinds: one with the ``sequence`` of a shard, and one for each of its distinct words."""
    schema = "shard long, sequence binary, number int, lang string, word string, count long"
    names = ["shard", "sequence", "number", "lang", "word", "count"]

    def cut(batches):
        shard = TaskContext.get().partitionId() * _SHARDS_OF_TASK
        last = shard + _SHARDS_OF_TASK
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), shard_bytes):
                symbols, languages, words, counts = sequence(texts, batch.column(0).slice(at, len(texts)))
                at += len(texts)
                n = len(counts)
                if not n:
                    continue
                if shard == last:
                    raise ValueError(f"a task with more than {_SHARDS_OF_TASK} shards: read smaller splits, or make larger shards")
                head = [[shard], [pack(symbols.astype(np.int32))], [None], [None], [None], [None]]
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(head, kinds, strict=True)], names=names)
                columns = [np.full(n, shard), pa.nulls(n, pa.binary()), np.arange(1, n + 1, dtype=np.int32)]
                columns += [languages.cast(pa.string()), words.cast(pa.large_string()).cast(pa.string()), counts.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)
                shard += 1

    return staged(df.mapInArrow(cut, schema), "shards")


def _summed(found: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    """Rows of the shards whose phrase is frequent, with its count ``f`` over all shards, and an ``id``: that of one of its rows."""
    same = Window.partitionBy(*keys)
    own = F.col("shard") * (1 << _NUMBER_BITS) + F.col("number")
    totals = found.withColumn("own", own).select("*", F.sum("count").over(same).alias("f"), F.min("own").over(same).alias("id"))
    return totals.filter(F.col("f") >= min_count)


def _extended(sequences: DataFrame, answers: list[DataFrame], max_words: int) -> DataFrame:
    """Phrases one word longer than those of the last of ``answers``: ``shard``, ``number``, ``prefix``, ``suffix`` and ``count``."""
    schema = "shard long, number long, prefix long, suffix long, count long"
    known, depths = None, len(answers)
    for depth, answer in enumerate(answers):
        rows = answer.select("shard", F.lit(depth).alias("depth"), F.col("number").cast("long").alias("number"), "id")
        known = rows if known is None else known.unionByName(rows)

    def extend(shards: pa.Table, answered: pa.Table) -> pa.Table:
        if not len(shards) or not len(answered):
            return pa.table({name: pa.array([], pa.int64()) for name in ("shard", "number", "prefix", "suffix", "count")})
        depth, number, id_ = (answered[name].to_numpy() for name in ("depth", "number", "id"))
        frequent, ids = [], []
        for d in range(depths):
            order = np.argsort(number[depth == d])
            frequent.append(number[depth == d][order])
            ids.append(id_[depth == d][order])
        level = levels(unpack(shards["sequence"][0].as_py(), np.int32), frequent, max_words)
        n = len(level.prefix)
        return pa.table(
            {
                "shard": np.full(n, shards["shard"][0].as_py(), np.int64),
                "number": np.arange(n, dtype=np.int64),
                "prefix": ids[-1][level.prefix],
                "suffix": ids[-1][level.suffix],
                "count": level.intervals[2].astype(np.int64),
            }
        )

    return sequences.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(extend, schema)


def phrase_counts(
    df: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    max_words: int = 3,
    min_count: int = 10,
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, list[DataFrame]]:
    """``lang`` and ``n`` (all its word occurrences); and one table for each length from 1 to ``max_words``, of the phrases that occur at
    least ``min_count`` times: ``id``, ``lang``, ``phrase``, ``last`` word, ``a`` (its count), ``heads`` and ``tails`` (for each cut
    after 1, 2, ... words the counts of the part before it and of the part from there on), ``prefix`` and ``suffix`` (ids of the phrase
    without its last and without its first word)."""
    if not 1 <= max_words <= 16:
        raise ValueError("phrases have 1 to 16 words")
    rows = df.select(F.coalesce(F.col(f"`{language_column}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(f"`{text_column}`").alias("text"))
    shards = _sequences(rows, shard_bytes)
    sequences = shards.filter("sequence IS NOT NULL").select("shard", "sequence")
    words = shards.filter("sequence IS NULL").drop("sequence")
    sizes = words.groupBy("lang").agg(F.sum("count").alias("n"))
    answers = [staged(_summed(words, ["lang", "word"], min_count), "words")]
    empty = F.array().cast("array<long>")
    own = answers[0].filter("id = own").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("f").alias("a"))
    tables = [own.withColumns({"heads": empty, "tails": empty, "prefix": F.lit(None).cast("long"), "suffix": F.lit(None).cast("long")})]
    for length in range(2, max_words + 1):
        found = _extended(sequences, answers, max_words)
        if length < max_words:
            answers.append(staged(_summed(found, ["prefix", "suffix"], min_count), f"phrases-{length}"))
            counted = answers[-1].filter("id = own").select("id", "prefix", "suffix", F.col("f").alias("a"))
        else:
            counted = found.groupBy("prefix", "suffix").agg(F.sum("count").alias("a"), F.min(F.col("shard") * (1 << _NUMBER_BITS) + F.col("number")).alias("id"))
            counted = counted.filter(F.col("a") >= min_count).select("id", "prefix", "suffix", "a")
        tables.append(staged(_described(counted, tables[-1]), f"described-{length}"))
    return sizes, tables


def _described(counted: DataFrame, shorter: DataFrame) -> DataFrame:
    """Words and parts' counts of phrases, from those of their prefix and suffix."""
    p = shorter.select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("start"), F.col("heads").alias("p_heads"), F.col("a").alias("p_a"))
    s = shorter.select(F.col("id").alias("suffix"), "last", F.col("tails").alias("s_tails"), F.col("a").alias("s_a"))
    return counted.join(p, "prefix").join(s, "suffix").select(
        "id",
        "lang",
        F.concat_ws(" ", "start", "last").alias("phrase"),
        "last",
        "a",
        F.concat("p_heads", F.array("p_a")).alias("heads"),
        F.concat(F.array("s_a"), "s_tails").alias("tails"),
        "prefix",
        "suffix",
    )


def lowest_cut(a: Column, heads: Column, tails: Column) -> Column:
    """``score``, ``k``, ``l`` and ``r`` of the cut with the lowest score ``1000000 a a div (l r)``, ties to the smallest ``k``.

    Products are decimals of 38 digits, enough for counts up to 10**16.
    """

    def exact(count: Column) -> Column:
        return count.cast("decimal(19,0)")

    def cut(parts: Column, k: Column) -> Column:
        top = (exact(a) * exact(a)).cast("decimal(38,0)") * F.lit(1000000).cast("decimal(7,0)")
        score = F.call_function("div", top.cast("decimal(38,0)"), exact(parts["heads"]) * exact(parts["tails"]))
        return F.struct(score.alias("score"), (k + 1).alias("k"), parts["heads"].alias("l"), parts["tails"].alias("r"))

    return F.array_min(F.transform(F.arrays_zip(heads.alias("heads"), tails.alias("tails")), cut))


def collocations(
    df: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    max_words: int = 3,
    min_count: int = 10,
    percent: int = 50,
    top: int = 2000,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Candidates are phrases of 2 to ``max_words`` words, within pieces between punctuation and line ends, that occur at least ``min_count``
    times in their language. A phrase goes if a longer candidate that contains it has ``percent`` percent of its count. Order:
    score, count (both descending), phrase by its bytes.

    Null texts are empty, and texts without words add nothing. A null language is ``und``, together with rows that say so. Repeated rows count each
    time; texts of any length are read whole; ties are settled by the phrase, which is unique in its language. An empty table gives no rows.
    Other columns are not read, so their names cannot clash.
    """
    if max_words < 2:
        raise ValueError("a collocation has two words at least")
    sizes, tables = phrase_counts(df, text_column, language_column, max_words, min_count, shard_bytes)
    kept = None
    for length, table in enumerate(tables[1:], 2):
        if length < max_words:
            # What contains a phrase contains one of the next length that does, and occurs no more often than that.
            longer = tables[length]
            parts = longer.select(F.col("prefix").alias("id"), "a").unionByName(longer.select(F.col("suffix").alias("id"), "a"))
            most = parts.groupBy("id").agg(F.max("a").alias("longer"))
            table = table.join(most, "id", "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {percent} * a")).drop("longer")
        scored = table.select("lang", "phrase", "a", lowest_cut(F.col("a"), F.col("heads"), F.col("tails")).alias("cut"))
        scored = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
        kept = scored if kept is None else kept.unionByName(scored)
    order = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    some = some.filter(F.col("rank") <= top).drop("salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
