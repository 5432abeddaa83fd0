"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model with Dirichlet priors: ``p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m)``, where ``h'`` is ``h``
without its first word, and ``p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))``. As an automaton it has a state for each seen sequence of
fewer than ``order`` words (the beginning of a text counts as one), the empty one being the root; an arc of weight ``p(w | h)``
from ``h`` for each seen ``h w``, to the longest end of it that is a state; and from each state a failure arc of weight
``m / (c(h) + m)`` to ``h'``. The root has an arc for every word. A text is read once from left to right: from the current state the arc of the
word is taken if there is one, else the failure arc is followed and the word tried again; log weights of all arcs add up.

The whole automaton grows with the corpus and is nowhere in one place. Documents are read in blocks of
some megabytes. A block asks for the counts of the n-grams that occur in it: sorted 64-bit keys go to
ranges of the key space, where the training counts of all blocks are summed, and the totals come back in the
order in which they were asked for. Keys of n-grams have ``GRAM_BITS`` bits: of 10^13 different n-grams one in 30,000 shares its key with
another and is counted with it. Each block then builds the states and arcs that its own texts can walk, and walks all its
texts at once, a vector of current states moving on by a word at a time. A long text is cut into segments: an automaton of
order n is in the right state after n - 1 words wherever it began, so a segment reads the n - 1 words before it first.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from reviewloom.llm.staging import staged
from reviewloom.llm.textbytes import mix, slices, word_hashes

BLOCK_BYTES = 8_000_000
RANGE_KEYS = 2_000_000  # keys of one range, all blocks together
GRAM_BITS = 58  # of the keys of n-grams of two words and more; those of words have 64
SEGMENT_TOKENS = 512  # longest run of one text that is walked by itself
_DROPPED = np.uint64(64 - GRAM_BITS)
_END = np.uint64(0x2545F4914F6CDD1D)  # key of the end of a text
_BEGIN = np.uint64(0x9FB21C651E98DF25)  # key of the context before the first word


def _pack(values: np.ndarray) -> bytes:
    """Bytes of like weight side by side, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64), dtype=np.uint64)


class Block:
    """Words of some whole texts as codes into the block's own vocabulary; every text ends with the end token.

    ``grams[k]`` has the distinct keys of the k-grams that end at some token, ``number[k]`` for each token which of them ends there
    (-1: too near to the beginning of its text), ``first[k]`` the first token of each.
    """

    def __init__(self, vocabulary: np.ndarray, codes: np.ndarray, ends: np.ndarray, train: np.ndarray, order: int):
        self.codes, self.ends, self.train, self.order = codes, ends, train, order
        self.begins = np.concatenate([[0], ends[:-1]])
        counts = np.diff(ends, prepend=0)
        self.in_training = np.repeat(train, counts)
        self.place = np.arange(len(codes)) - np.repeat(self.begins, counts)
        words = vocabulary[codes]
        first = np.zeros(len(vocabulary), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        self.grams, self.number, self.first = {1: vocabulary}, {1: codes}, {1: first}
        keys = words
        for k in range(2, order + 1):
            context = np.concatenate([[_BEGIN], keys[:-1]]).astype(np.uint64)
            if k == 2:
                context[self.begins] = _BEGIN
            keys = mix(context * np.uint64(0xD6E8FEB86659FD93) + words)
            real = np.flatnonzero(self.place >= k - 2)
            kept = keys[real] >> _DROPPED << _DROPPED
            self.grams[k], at, inverse = np.unique(kept, return_index=True, return_inverse=True)
            self.first[k] = real[at]
            self.number[k] = np.full(len(codes), -1, np.int32)
            self.number[k][real] = inverse

    @staticmethod
    def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary, codes, and the end of each text."""
        keys, first = word_hashes(texts)
        keys = np.insert(keys, first[1:], _END)
        vocabulary, codes = np.unique(keys, return_inverse=True)
        return vocabulary, codes, first[1:] + np.arange(1, len(texts) + 1)

    def asked(self):
        """(length of the n-grams, sorted keys, training counts)"""
        for k, keys in self.grams.items():
            used = self.number[k][self.in_training]
            yield k, keys, np.bincount(used[used >= 0], minlength=len(keys))

    def scores(self, totals: dict[int, np.ndarray], all_words: int, all_kinds: int, texts: int, prior: float, segment_tokens: int):
        """Per text: tokens, known tokens, base score and score, from the totals of this block's n-grams."""
        p = (totals[1] + 0.5) / (all_words + 0.5 * (all_kinds + 1))
        automaton = Automaton(self, totals, p, texts, prior)
        self.grams, self.number, self.first = {}, {}, {}  # the walk needs the memory
        weights = automaton.walk(self, segment_tokens)
        per_text = lambda values: np.add.reduceat(values, self.begins)
        known = (totals[1][self.codes] > 0).astype(np.int64)
        return np.diff(self.ends, prepend=0), per_text(known), per_text(np.log10(p)[self.codes]), per_text(weights)


class Automaton:
    """States, arcs and failure arcs for the n-grams of a block.

    State 0 is the root, 1 the beginning of a text, then come the seen n-grams by length. An arc's key is its state times the size of the
    vocabulary plus its word; keys are sorted. The root's arcs are an array over the vocabulary.
    """

    ROOT, BEGIN = 0, 1

    def __init__(self, block: Block, totals: dict[int, np.ndarray], p: np.ndarray, texts: int, prior: float):
        self.order, self.words = block.order, len(p)
        fail_to, fail_count = [np.array([self.ROOT, self.ROOT])], [np.array([0, texts])]
        states, n_states = {}, 2
        for k in range(1, self.order):
            seen = totals[k] > 0
            states[k] = np.where(seen, n_states + np.cumsum(seen) - 1, self.ROOT)
            n_states += int(seen.sum())
            at = block.first[k][seen]
            fail_to.append(states[k - 1][block.number[k - 1][at]] if k > 1 else np.zeros(len(at), np.int64))
            fail_count.append(totals[k][seen])
        self.fail_to = np.concatenate(fail_to)
        self.fail_weight = np.log10(prior / (np.concatenate(fail_count) + prior))
        self.root_weight = np.log10(p)
        self.root_to = states[1] if self.order > 1 else np.zeros(self.words, np.int64)
        keys, weights, targets = [], [], []
        for k in range(2, self.order + 1):
            at = block.first[k]
            begins = block.place[at] == 0  # of pairs only
            before = block.number[k - 1][at - 1]  # looked at where a token comes before
            shorter = block.number[k - 1][at]
            count = np.where(begins, texts, totals[k - 1][before])
            p = (totals[k] + prior * p[shorter]) / (count + prior)
            seen = totals[k] > 0
            source = np.where(begins, self.BEGIN, states[k - 1][before])
            keys.append((source * self.words + block.codes[at])[seen])
            weights.append(np.log10(p[seen]))
            targets.append((states[k] if k < self.order else states[k - 1][shorter])[seen])
        # The last entry matches no key, so that a search beyond the end is a miss.
        keys = np.concatenate([*keys, [np.iinfo(np.int64).max]])
        order = np.argsort(keys)
        self.arc_keys = keys[order]
        self.arc_weight = np.concatenate([*weights, [0.0]])[order]
        self.arc_to = np.concatenate([*targets, [self.ROOT]]).astype(np.int64)[order]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a word from each of ``state``, and the weights of the arcs taken."""
        state, after, weight = state.copy(), np.zeros_like(state), np.zeros(len(state))
        left = np.arange(len(state))
        while len(left):
            root = state[left] == self.ROOT
            done = left[root]
            weight[done] += self.root_weight[word[done]]
            after[done] = self.root_to[word[done]]
            left = left[~root]
            wanted = state[left] * self.words + word[left]
            at = np.searchsorted(self.arc_keys, wanted)
            found = self.arc_keys[at] == wanted
            done, at = left[found], at[found]
            weight[done] += self.arc_weight[at]
            after[done] = self.arc_to[at]
            left = left[~found]
            weight[left] += self.fail_weight[state[left]]
            state[left] = self.fail_to[state[left]]
        return after, weight

    def walk(self, block: Block, segment_tokens: int) -> np.ndarray:
        """The weight that each token adds."""
        ends = np.repeat(block.ends, -(-np.diff(block.ends, prepend=0) // segment_tokens))
        cut = np.flatnonzero(block.place % segment_tokens == 0)
        begin = cut - np.minimum(block.place[cut], self.order - 1)  # words before the segment set the state
        length = np.minimum(cut + segment_tokens, ends) - begin
        longest = np.argsort(-length, kind="stable")
        begin, cut, length = begin[longest], cut[longest], length[longest]
        at_text = (block.place[begin] == 0) & (self.order > 1)
        state = np.where(at_text, self.BEGIN, self.ROOT)
        weights = np.zeros(len(block.codes))
        for step in range(int(length[0])):
            active = int(np.searchsorted(-length, -step, side="left"))
            token = begin[:active] + step
            state[:active], weight = self.step(state[:active], block.codes[token])
            own = token >= cut[:active]
            weights[token[own]] = weight[own]
        return weights


def _blocks(given: DataFrame, block_bytes: int) -> DataFrame:
    schema = StructType().add("block", "long").add("rows", ArrayType(given.schema["row"].dataType))
    schema.add("train", "binary").add("ends", "binary").add("vocabulary", "binary").add("codes", "binary")
    schema.add("n_tokens", "long").add("n_train", "long")

    def cut(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), block_bytes):
                train = batch.column(2).slice(at, len(texts)).to_numpy(zero_copy_only=False).astype(bool)
                vocabulary, codes, ends = Block.coded(texts)
                rows = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column(0).slice(at, len(texts)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        rows,
                        pa.array([np.packbits(train).tobytes()]),
                        pa.array([_pack(ends.astype(np.int64))]),
                        pa.array([_pack_sorted(vocabulary)]),
                        pa.array([_pack(codes.astype(np.uint32))]),
                        pa.array([len(codes)]),
                        pa.array([int(train.sum())]),
                    ],
                    names=schema.names,
                )
                number += 1
                at += len(texts)

    return staged(given.mapInArrow(cut, schema), "blocks")


def _opened(order: int, train: bytes, ends: bytes, vocabulary: bytes, codes: bytes) -> Block:
    ends = _unpack(ends, np.int64)
    used = np.unpackbits(np.frombuffer(train, np.uint8))[: len(ends)].astype(bool)
    return Block(_unpack_sorted(vocabulary), _unpack(codes, np.uint32).astype(np.int64), ends, used, order)


_PARTS = ["train", "ends", "vocabulary", "codes"]


def _totals(blocks: DataFrame, ranges: int, order: int) -> DataFrame:
    """Per block, kind (the length of the n-grams) and range of keys: the totals of the keys that the block asked for. Rows of block -1
    hold how many keys of a range occur in training, and how often."""

    bits = np.uint64(64 - ranges.bit_length() + 1)

    def ask(batches):
        for batch in batches:
            for number, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for kind, keys, counts in _opened(order, *parts).asked():
                    borders = (np.arange(1, ranges).astype(np.uint64) << bits) if ranges > 1 else np.zeros(0, np.uint64)
                    bounds = [0, *np.searchsorted(keys, borders).tolist(), len(keys)]
                    found = [(i, b, e) for i, (b, e) in enumerate(zip(bounds, bounds[1:], strict=False)) if e > b]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "kind": [kind] * len(found),
                            "range": [i for i, _, _ in found],
                            "block": [number] * len(found),
                            "keys": [_pack_sorted(keys[b:e] if kind == 1 else keys[b:e] >> _DROPPED) for _, b, e in found],
                            "counts": [_pack(counts[b:e].astype(np.uint32)) for _, b, e in found],
                        },
                        schema=pa.schema({"kind": pa.int32(), "range": pa.int32(), "block": pa.int64(), "keys": pa.binary(), "counts": pa.binary()}),
                    )

    def add(table: pa.Table) -> pa.Table:
        lists = [_unpack_sorted(x) for x in table["keys"].to_pylist()]
        counts = np.concatenate([_unpack(x, np.uint32) for x in table["counts"].to_pylist()])
        keys, which = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(which, weights=counts, minlength=len(keys)).astype(np.int64)
        answers, at = [], 0
        for keys_of_block in lists:
            answers.append(_pack(totals[which[at : at + len(keys_of_block)]]))
            at += len(keys_of_block)
        n = len(lists)
        return pa.table(
            {
                "kind": pa.array([*table["kind"].to_pylist(), table["kind"][0].as_py()], pa.int32()),
                "range": pa.array([*table["range"].to_pylist(), table["range"][0].as_py()], pa.int32()),
                "block": pa.array([*table["block"].to_pylist(), -1], pa.int64()),
                "totals": pa.array([*answers, None], pa.binary()),
                "known": pa.array([None] * n + [int((totals > 0).sum())], pa.int64()),
                "counted": pa.array([None] * n + [int(totals.sum())], pa.int64()),
            }
        )

    asked = blocks.select("block", *_PARTS).mapInArrow(
        ask, "kind int, range int, block long, keys binary, counts binary"
    )
    return staged(
        asked.groupBy("kind", "range").applyInArrow(
            add, "kind int, range int, block long, totals binary, known long, counted long"
        ),
        "totals",
    )


def language_scores(
    df: DataFrame,
    train: Column,
    text_column: str = "text",
    carry: list[str] | None = None,
    prior: float = 64.0,
    block_bytes: int = BLOCK_BYTES,
    order: int = 3,
    segment_tokens: int = SEGMENT_TOKENS,
) -> DataFrame:
    """``row`` (all columns, or those of ``carry``), ``in_training``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 probabilities) of every row; the model learns from rows where ``train`` is true.

    Words are runs of other than ASCII blanks, A-Z in lower case; a text of none, or null, is its end token. Without training
    rows every token has the probability that the prior gives an unknown one. An empty table gives no rows. Repeated rows are learned from and
    scored as often as they occur; columns of any names stay within ``row``. ``order`` is the length of the longest n-grams; one of 1 is
    the model of single words. A long text takes memory in proportion to it, in one task.
    """
    if order < 1 or prior <= 0 or segment_tokens < 1:
        raise ValueError("order and segment_tokens are at least 1, and the prior is above 0")
    given = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("row"),
        F.col(f"`{text_column}`").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    blocks = _blocks(given, block_bytes)
    sums = blocks.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_train").alias("texts")).first()
    ranges = 1 << max(0, (sums["tokens"] or 0) // RANGE_KEYS).bit_length()
    totals = _totals(blocks, ranges, order)
    corpus = totals.filter(f"block = -1 AND kind = 1").agg(F.sum("known").alias("kinds"), F.sum("counted").alias("words")).first()
    all_words, all_kinds, texts = corpus["words"] or 0, corpus["kinds"] or 0, sums["texts"] or 0

    schema = StructType().add("row", given.schema["row"].dataType).add("in_training", "boolean")
    schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")

    def walk(block_table: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [block_table[name][0].as_py() for name in _PARTS]
        block = _opened(order, *parts)
        by_kind = {k: [] for k in range(1, order + 1)}
        for kind, number, packed in zip(*(answers[c].to_pylist() for c in ("kind", "range", "totals")), strict=True):
            by_kind[kind].append((number, packed))
        joined = {k: np.concatenate([np.zeros(0, np.int64), *(_unpack(p, np.int64) for _, p in sorted(v))]) for k, v in by_kind.items()}
        n, known, base, score = block.scores(joined, all_words, all_kinds, texts, prior, segment_tokens)
        rows = block_table["rows"].combine_chunks()
        return pa.table(
            [rows.flatten(), pa.array(block.train), pa.array(n), pa.array(known), pa.array(base), pa.array(score)],
            schema=pa.schema(list(zip(schema.names, [rows.type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], strict=True))),
        )

    answers = totals.filter("block >= 0").select("block", "kind", "range", "totals")
    scored = (
        blocks.select("block", "rows", *_PARTS).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, schema)
    )
    return scored.withColumn("train_tokens", F.lit(all_words).cast("bigint"))
