"""Token counts of a byte-fallback piece model by rank-synchronous merging of arrays.

Texts become chunks between which no piece can reach: two neighbouring characters that stand
side by side in no piece are a safe cut. The chunks a task has not counted before lie in one ragged
array of symbols. In each round every sequence applies its own lowest-rank pair, at all its places,
and all sequences do so at once; what is left when no pair has a rank are the tokens.

Applying a pair at all places at once equals one merge at a time where its merge only makes pairs of higher
rank; for the few other pieces only the first place counts. Runs of blanks are the exception: their pieces share one rank, the last, so they are counted by run length.
"""

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.textbytes import ragged, slices, span_hashes, utf8

SPACE = "▁"
_NONE = np.iinfo(np.int32).max
_KEPT_COUNTS = 2_000_000  # about 24 MB


class PairTable:
    """(left, right) -> (rank, merged) by open addressing, for whole arrays of pairs."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self._bits = max(10, (4 * len(pairs)).bit_length())
        size = 1 << self._bits
        self._keys = np.full(size, -1, np.int64)
        self._ranks = np.full(size, _NONE, np.int32)
        self._merged = np.zeros(size, np.int32)
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        slots = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self._keys[slots[left]] == -1]
            _, one = np.unique(slots[free], return_index=True)
            put = free[one]
            self._keys[slots[put]] = keys[put]
            self._ranks[slots[put]], self._merged[slots[put]] = values[put, 0], values[put, 1]
            left = left[self._keys[slots[left]] != keys[left]]
            slots[left] = (slots[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slots = self._slot(keys)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self._keys[slots[open_]]
            open_ = open_[(found != keys[open_]) & (found != -1)]
            slots[open_] = (slots[open_] + 1) & (len(self._keys) - 1)
        hit = self._keys[slots] == keys
        return np.where(hit, self._ranks[slots], _NONE), self._merged[slots]


def _blank_run_counts(lengths: set[int], up_to: int) -> np.ndarray:
    """Tokens of a run of k blanks, k < up_to: the leftmost two neighbours that make a piece are joined, again and again."""
    counts = np.zeros(up_to, np.int64)
    for k in range(1, up_to):
        run = [1] * k
        while (i := next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in lengths), None)) is not None:
            run[i : i + 2] = [run[i] + run[i + 1]]
        counts[k] = len(run)
    return counts


class PieceCounter:
    """Token counts of the texts of an Arrow array."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [
            i for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        piece = {model.id_to_piece(i): i for i in normal}
        by_rank = sorted((i for i in normal), key=lambda i: (-model.get_score(i), i))
        rank = {model.id_to_piece(i): r for r, i in enumerate(by_rank)}
        blanks = {len(p) for p in piece if len(p) > 1 and not p.strip(SPACE)}
        self._blank_most = max(blanks, default=1)
        self._blank_counts = _blank_run_counts(blanks, 4 * self._blank_most)
        pairs = {}
        self._early = early = np.zeros(model.vocab_size(), bool)  # pieces with which a pair has a lower rank than theirs
        for text, i in piece.items():
            if len(text) > 1 and text.strip(SPACE):
                for cut in range(1, len(text)):
                    left, right = text[:cut], text[cut:]
                    if left in piece and right in piece:
                        for part in (left, right):
                            if len(part) > 1 and rank[part] > rank[text]:
                                early[piece[part]] = True
                        pairs[piece[left], piece[right]] = (rank[text], i)
        self._pairs = PairTable(pairs)
        self._symbol = np.full(0x110000, -1, np.int32)
        for text, i in piece.items():
            if len(text) == 1:
                self._symbol[ord(text)] = i
        self._symbol[0x20] = self._space = piece[SPACE]
        beside = np.zeros((256, 256), bool)
        for text in piece:
            for a, b in zip(text, text[1:], strict=False):
                last, next_ = (x.replace(SPACE, " ").encode() for x in (a, b))
                beside[last[-1], next_[0]] = True
        beside[:, 0x80:0xC0] = True  # within a character
        beside[0x20, 0x20] = True
        self._apart = ~beside
        self._seed = secrets.randbits(64)  # the hashes do not leave this worker
        self._keys, self._counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _symbols(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of whole characters (-1: in no piece), their bytes, and where they begin."""
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        width = np.diff(np.append(begins, len(data)))
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
        lead = padded[begins]
        code = np.where(width == 1, lead, lead & (0x7F >> width).astype(np.uint32))
        for k in (1, 2, 3):
            longer = width > k
            code[longer] = (code[longer] << 6) | (padded[begins[longer] + k] & 0x3F)
        return self._symbol[code], width, begins

    def _count_chunks(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each chunk."""
        flat = data[ragged(starts, lengths)]
        symbols, width, begins = self._symbols(flat)
        sequence = np.searchsorted(np.cumsum(lengths), begins, side="right").astype(np.int64)
        # A character in no piece gives its bytes, and a pair with it has no rank.
        counts = np.bincount(sequence, weights=np.where(symbols < 0, width, 0), minlength=len(starts)).astype(np.int64)
        last = np.append(sequence[1:] != sequence[:-1], True)
        ranks, merged = self._pairs(symbols, np.append(symbols[1:], -1))
        ranks[last] = _NONE
        while len(symbols):
            first = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
            least = np.minimum.reduceat(ranks, first)
            size = np.diff(np.append(first, len(symbols)))
            done = np.repeat(least == _NONE, size)
            if done.any():
                self._add_finished(symbols[done], sequence[done], counts)
                keep = ~done
                symbols, sequence, ranks, merged = symbols[keep], sequence[keep], ranks[keep], merged[keep]
                if not len(symbols):
                    break
                least, size = least[least != _NONE], size[least != _NONE]
            apply = ranks == np.repeat(least, size)
            at = np.flatnonzero(apply)
            # Neighbouring places of one pair overlap: every other one counts, from the left.
            run_start = np.append(True, at[1:] != at[:-1] + 1)
            in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
            at = at[in_run % 2 == 0]
            # A merge that makes a pair of lower rank is done alone, so that this pair comes next.
            lead = np.append(True, sequence[at[1:]] != sequence[at[:-1]])
            at = at[lead | ~self._early[merged[at]]]
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, sequence = symbols[keep], sequence[keep]
            ranks, merged = ranks[keep], merged[keep]
            new = place[at]
            new = np.unique(np.concatenate([new, new[new > 0] - 1]))
            inside = new + 1 < len(symbols)
            inside[inside] = sequence[new[inside] + 1] == sequence[new[inside]]
            ranks[new[~inside]] = _NONE
            new = new[inside]
            ranks[new], merged[new] = self._pairs(symbols[new], symbols[new + 1])
        return counts

    def _add_finished(self, symbols: np.ndarray, sequence: np.ndarray, counts: np.ndarray) -> None:
        blank = symbols == self._space
        plain = (symbols >= 0) & ~blank
        np.add.at(counts, sequence[plain], 1)
        at = np.flatnonzero(blank)
        if len(at):
            fresh = np.append(True, (at[1:] != at[:-1] + 1) | (sequence[at[1:]] != sequence[at[:-1]]))
            begin = np.flatnonzero(fresh)
            run = np.diff(np.append(begin, len(at)))
            beyond = np.maximum(run - 2 * self._blank_most, 0) // self._blank_most
            tokens = beyond + self._blank_counts[run - beyond * self._blank_most]
            np.add.at(counts, sequence[at[begin]], tokens)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        data, offsets = utf8(texts)
        if SPACE.encode() in data.tobytes():
            replaced = [(x or "").replace(SPACE, " ") for x in texts.to_pylist()]
            data, offsets = utf8(pa.array(replaced, pa.large_string()))
        filled = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[filled], 0x20)  # a text begins with a blank
        offsets = offsets + np.searchsorted(filled, np.arange(len(offsets)))
        here = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            here[1:-1] = self._apart[data[:-1], data[1:]]
        here[offsets] = True
        at = np.flatnonzero(here)
        starts, ends = at[:-1], at[1:]
        keys, example, which = np.unique(span_hashes(data, starts, ends, self._seed), return_index=True, return_inverse=True)
        fresh = ~np.isin(keys, self._keys, kind="sort")
        if len(self._keys) + fresh.sum() > _KEPT_COUNTS:
            self._keys, self._counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            fresh[:] = True
        if fresh.any():
            some = example[fresh]
            new = self._count_chunks(data, starts[some], ends[some] - starts[some])
            all_keys = np.concatenate([self._keys, keys[fresh]])
            order = np.argsort(all_keys, kind="stable")
            self._keys, self._counts = all_keys[order], np.concatenate([self._counts, new])[order]
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64)
        counts = self._counts[np.searchsorted(self._keys, keys)][which]
        before = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(before[np.searchsorted(starts, offsets)])


def token_counts(df: DataFrame, model: str, text_column: str = "text", name: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each whole text, as the library gives them without begin or end
    (null and empty texts have none). A column called ``name`` is replaced; all others stay."""
    made = []

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(PieceCounter(model))
        parts = [made[0](part) for part in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return df.withColumn(name, counted(F.col(f"`{text_column}`")))
