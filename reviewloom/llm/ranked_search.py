"""Ranked lexical search: term at a time over blocks of an inverted index, with a limit on accumulators.

Texts are read once. Each block of some megabytes becomes a small inverted index of the terms that the queries of a pass hold
(ids and lengths of its texts, and for each term the texts that hold it and how often). Sums over the blocks give the
corpus figures, and with them every term its weight. Then each block ranks its own texts for every query: terms go from
rare to frequent; a term's postings open accumulators as long as a text that has none yet could still come among the best, that is
until the sum of the remaining terms' highest contributions lies below the score that the k-th best text has so far. After
that, the remaining terms are added to the open accumulators only, so their scores are exact. The k-th best score of a task's earlier
blocks is the bar from the start. What leaves a task are the best texts of each query.

Queries are taken from their table in passes of bounded size; the index of a pass is read by it alone.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.llm.staging import staged
from reviewloom.llm.terms import pack, runs, unpack
from reviewloom.llm.textbytes import coded, lower_ascii, slices, span_values, utf8

BLOCK_BYTES = 8_000_000
PASS_BYTES = 8_000_000  # of the queries' texts in one pass
SALTS = 64
# Scale of the weights, and of a contribution with its saturation and length parts.
WEIGHT_SCALE, SCORE_SCALE, TF_SCALE, NORM_SCALE, LENGTH_PART = 1000, 1_000_000_000, 1000, 8, 75

_TERM_BYTES = np.ones(256, bool)
for _first, _last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM_BYTES[_first : _last + 1] = False


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts (letters, digits and all characters beyond ASCII; A-Z in lower case), and the first of each text."""
    data, offsets = utf8(texts)
    data = lower_ascii(data)
    starts, ends, first = runs(_TERM_BYTES[data], offsets)
    return span_values(data, starts, ends), first


class Queries:
    """Some queries: their numbers, the distinct terms of all, and the terms of each with their repeats."""

    def __init__(self, numbers: list[int], texts: list[str | None]):
        terms, first = terms_of(pa.array(texts, pa.string()))
        codes, self.vocabulary = coded(terms)
        self.numbers = numbers
        self.terms = [np.unique(codes[b:e], return_counts=True) for b, e in zip(first, first[1:], strict=False)]


class Postings:
    """The inverted index of one block: texts by their place in it; term ``i`` has the postings ``cuts[i]:cuts[i + 1]``."""

    def __init__(self, terms, cuts, texts, counts, lengths):
        self.terms, self.cuts, self.texts, self.counts, self.lengths = terms, cuts, texts, counts, lengths

    @classmethod
    def of(cls, texts: pa.Array, vocabulary: pa.Array) -> "Postings":
        found, first = terms_of(texts)
        codes, distinct = coded(found)
        known = pc.index_in(distinct, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        term = known[codes] if len(codes) else codes
        lengths = np.diff(first)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        hit = term >= 0
        pairs, counts = np.unique(term[hit] * len(lengths) + owner[hit], return_counts=True)
        term, text = np.divmod(pairs, max(len(lengths), 1))
        terms, begins = np.unique(term, return_index=True)
        return cls(terms, np.append(begins, len(term)), text, counts, lengths)

    def packed(self) -> dict:
        return {
            "terms": pack(self.terms.astype(np.int32)),
            "held": pack(np.diff(self.cuts).astype(np.int32)),
            "texts": pack(self.texts.astype(np.int32)),
            "counts": pack(self.counts.astype(np.int64)),
            "lengths": pack(self.lengths.astype(np.int64)),
        }

    @classmethod
    def opened(cls, terms: bytes, held: bytes, texts: bytes, counts: bytes, lengths: bytes) -> "Postings":
        cuts = np.concatenate([[0], np.cumsum(unpack(held, np.int32), dtype=np.int64)])
        return cls(unpack(terms, np.int32).astype(np.int64), cuts, unpack(texts, np.int32), unpack(counts, np.int64), unpack(lengths, np.int64))


def impacts(counts: np.ndarray, lengths: np.ndarray, texts: int, words: int) -> np.ndarray:
    """What one posting adds for each unit of weight: saturated frequency, by the text's length against the mean."""
    if len(lengths) and LENGTH_PART * int(lengths.max()) * texts >= 2**63:
        norm = np.array([LENGTH_PART * int(n) * texts // max(words, 1) for n in lengths], np.int64)
    else:
        norm = LENGTH_PART * lengths * texts // max(words, 1)
    return SCORE_SCALE * counts // (TF_SCALE * counts + NORM_SCALE * (100 - LENGTH_PART + norm))


class Ranking:
    """Best texts of some queries in one block after the other."""

    def __init__(self, queries: Queries, weights: np.ndarray, texts: int, words: int, k: int):
        self.queries, self.weights, self.texts, self.words, self.k = queries, weights, texts, words, k
        self.best: list[list[tuple]] = [[] for _ in queries.numbers]  # (-score, id is null, id)
        self.opened = self.touched = 0

    def add(self, block: Postings, ids: list) -> None:
        """Rank the texts of ``block``, which have these ``ids``."""
        impact = impacts(block.counts, block.lengths[block.texts], self.texts, self.words)
        highest = np.maximum.reduceat(impact, block.cuts[:-1]) if len(impact) else impact
        scores = np.zeros(len(block.lengths), np.int64)
        for query, (terms, repeats) in enumerate(self.queries.terms):
            at = np.searchsorted(block.terms, terms)
            at[at == len(block.terms)] = 0
            here = block.terms[at] == terms if len(block.terms) else np.zeros(len(terms), bool)
            at, factor = at[here], (self.weights[terms] * repeats)[here]
            order = np.argsort(-self.weights[terms[here]], kind="stable")  # rare terms weigh most
            at, factor = at[order], factor[order]
            bound = factor * highest[at]
            rest = np.cumsum(bound[::-1])[::-1]
            opened = self._accumulate(block, impact, at, factor, rest, scores, self._bar(query))
            self._keep(query, opened, scores, ids)
            scores[opened] = 0

    def _bar(self, query: int) -> int:
        """No text below this score is among the best."""
        best = self.best[query]
        return -best[-1][0] if len(best) == self.k else 0

    def _accumulate(self, block, impact, at, factor, rest, scores, bar) -> np.ndarray:
        """Adds up ``scores`` and returns the texts that have an accumulator."""
        opened, creating = np.zeros(0, np.int64), True
        for i, (term, weight) in enumerate(zip(at.tolist(), factor.tolist(), strict=True)):
            postings = slice(block.cuts[term], block.cuts[term + 1])
            texts, gain = block.texts[postings], weight * impact[postings]
            if creating and len(opened) >= self.k:
                # Partial scores only grow, so the k-th of them is a bar as well.
                bar = max(bar, int(np.partition(scores[opened], -self.k)[-self.k]))
            creating = creating and rest[i] >= max(bar, 1)
            if creating:
                opened = np.concatenate([opened, texts[(scores[texts] == 0) & (gain > 0)]])
            else:
                going = scores[texts] > 0
                texts, gain = texts[going], gain[going]
            scores[texts] += gain
            self.touched += len(texts)
        self.opened += len(opened)
        return opened

    def _keep(self, query: int, opened: np.ndarray, scores: np.ndarray, ids: list) -> None:
        bar = self._bar(query)
        if len(opened) > self.k:
            bar = max(bar, int(np.partition(scores[opened], -self.k)[-self.k]))
        good = opened[scores[opened] >= max(bar, 1)]
        new = [(-int(scores[t]), ids[t] is None, ids[t] or 0) for t in good.tolist()]
        if new:
            self.best[query] = sorted(self.best[query] + new)[: self.k]


def _passes(queries: DataFrame, pass_bytes: int) -> Iterator[Queries]:
    """The queries one after the other, in groups of bounded size."""
    numbers, texts, size = [], [], 0
    for row in queries.toLocalIterator():
        if texts and size + len(row["text"] or "") > pass_bytes:
            yield Queries(numbers, texts)
            numbers, texts, size = [], [], 0
        numbers.append(row["number"])
        texts.append(row["text"])
        size += len(row["text"] or "") + 100
    if texts:
        yield Queries(numbers, texts)


def _index(documents: DataFrame, vocabulary: pa.Array, block_bytes: int) -> DataFrame:
    schema = "ids array<long>, n_texts long, n_words long, terms binary, held binary, texts binary, counts binary, lengths binary"

    def build(batches):
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), block_bytes):
                block = Postings.of(texts, vocabulary)
                yield pa.RecordBatch.from_pydict(
                    {
                        "ids": pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column(0).slice(at, len(texts))),
                        "n_texts": [int((block.lengths > 0).sum())],
                        "n_words": [int(block.lengths.sum())],
                    }
                    | {name: [value] for name, value in block.packed().items()}
                )
                at += len(texts)

    return staged(documents.mapInArrow(build, schema), "index")


def _weights(index: DataFrame, terms: int, texts: int) -> np.ndarray:
    """Weight of each of ``terms`` terms, from the texts of all blocks that hold it."""

    def add(batches):
        held = np.zeros(terms, np.int64)
        for batch in batches:
            for found, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[unpack(found, np.int32)] += unpack(counts, np.int32)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": used, "held": held[used]})

    totals = index.select("terms", "held").mapInArrow(add, "term long, held long")
    held = np.zeros(terms, np.int64)
    table = totals.groupBy("term").agg(F.sum("held").alias("held")).toArrow()  # a row for each term of the pass
    held[table["term"].to_numpy()] = table["held"].to_numpy()
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * texts + 2) / (2 * h + 1))) for h in held.tolist()], np.int64)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def ranked_search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    query_column: str = "item_id",
    query_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``doc_id`` and ``score`` (long) of the ``k`` best rows of ``df`` for each row of ``queries``.

    Only rows with a score above 0 are listed; equal scores go by ascending id, null ids last. Terms are runs of letters, digits and
    characters beyond ASCII, A-Z in lower case; null texts have none. Rows that repeat an id or a text are ranked each by themselves; queries that repeat an id, or
    have none, are answered each by themselves. Empty tables, and queries without a term that occurs, give no rows. Texts of any
    length are read whole; other columns are not read, so their names cannot clash.
    """
    documents = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text"))
    asked = staged(
        queries.select(
            F.monotonically_increasing_id().alias("number"), F.col(f"`{query_column}`").alias("query_id"), F.col(f"`{query_text_column}`").alias("text")
        ),
        "queries",
    )
    schema = StructType().add("number", "long").add("doc_id", "long").add("score", "long")
    found = None
    for group in _passes(asked.select("number", "text"), pass_bytes):
        index = _index(documents, group.vocabulary, block_bytes)
        corpus = index.agg(F.sum("n_texts").alias("texts"), F.sum("n_words").alias("words")).first()
        texts, words = corpus["texts"] or 0, corpus["words"] or 0
        best = _ranked(index, group, _weights(index, len(group.vocabulary), texts), texts, words, k, schema)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = df.sparkSession.createDataFrame([], schema)
    some = _first(found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), ["number", "salt"], k).drop("rank", "salt")
    ranked = _first(some, ["number"], k).join(asked.select("number", "query_id"), "number")
    return ranked.select("query_id", "rank", "doc_id", "score")


def _ranked(index: DataFrame, queries: Queries, weights: np.ndarray, texts: int, words: int, k: int, schema: StructType) -> DataFrame:
    def rank(batches):
        ranking = Ranking(queries, weights, texts, words, k)
        for batch in batches:
            for ids, *parts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                ranking.add(Postings.opened(*parts), ids)
        for number, best in zip(queries.numbers, ranking.best, strict=True):
            if best:
                scores, unnamed, ids = zip(*best, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "number": np.full(len(best), number, np.int64),
                        "doc_id": pa.array(ids, pa.int64(), mask=np.array(unnamed)),
                        "score": -np.array(scores, np.int64),
                    }
                )

    return index.select("ids", "terms", "held", "texts", "counts", "lengths").mapInArrow(rank, schema)
