"""Token ids of whole texts by the tokenizers library, each distinct chunk encoded once per worker.

A text is cut where no token and no normalization can reach across: before blanks that follow a
character that surely is none, and before a few marks that follow an ASCII letter or digit. Chunks
are found, hashed and gathered by numpy; only chunks that a worker has not met before go to the library, which
keeps them apart by a special token of its own. Chunks that may hold the text of a special
token are encoded alone, so that the library decides what they mean.
"""

import os
import secrets
from functools import lru_cache

import numpy as np
import pyarrow as pa

from reviewloom.llm.textbytes import ragged, span_hashes, utf8

_KEPT_CHUNKS = 2_000_000  # about 80 MB; a full store starts anew, which costs time only
_AT_ONCE = 500
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_WORDLIKE = np.zeros(256, bool)
_WORDLIKE[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_PRINTABLE = np.zeros(256, bool)
_PRINTABLE[0x21:0x7F] = True
# The last two bytes of blanks beyond ASCII: C2 85, C2 A0, and three-byte ones that end 80/81/9A xx.
_BEFORE_LAST = np.zeros(256, bool)
_BEFORE_LAST[[0xC2, 0x80, 0x81, 0x9A]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which chunks begin, the beginnings of texts among them, and the end."""
    here = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        previous, current = data[:-1], data[1:]
        solid = _PRINTABLE[previous]
        beyond = np.flatnonzero(previous >= 0x80)
        beyond = beyond[beyond > 0]
        solid[beyond] = ~_BEFORE_LAST[data[beyond - 1]]
        here[1:-1] = _BLANK[current] & solid | _MARK[current] & _WORDLIKE[previous]
    here[offsets] = True
    return np.flatnonzero(here)


@lru_cache(maxsize=2)
def encoder_for(path: str) -> "ChunkEncoder":
    """The encoder of this Python worker, which serves one task after the other."""
    return ChunkEncoder(path)


class ChunkEncoder:
    """``(ids, first)`` of the texts of an Arrow array: all ids, and where each text's ids begin."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        special = {token.content: number for number, token in added.items()}
        self._separator, self._separator_id = next(iter(special.items()))
        self._suspicious = os.path.commonprefix(list(special) * (1 + (len(special) == 1)))[:2].encode()
        self._seed = secrets.randbits(64)  # the hashes do not leave this worker
        self._forget()

    def _forget(self):
        self._keys = np.zeros(0, np.uint64)  # sorted
        self._first = np.zeros(0, np.int64)
        self._count = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode(self, chunks: list[bytes]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(chunks)
        alone = [i for i, chunk in enumerate(chunks) if self._suspicious in chunk]
        for i in alone:
            out[i] = self._tokenizer.encode(chunks[i].decode(), add_special_tokens=False).ids
        plain = [i for i, ids in enumerate(out) if ids is None]
        for begin in range(0, len(plain), _AT_ONCE):
            some = plain[begin : begin + _AT_ONCE]
            joined = self._separator.join(chunks[i].decode() for i in some)
            ids = np.array(self._tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            at = np.flatnonzero(ids == self._separator_id)
            assert len(at) == len(some) - 1
            for i, part in zip(some, np.split(ids, at), strict=True):
                out[i] = part
            for i in some[1:]:
                out[i] = out[i][1:]  # without the separator before it
        return out

    def _learn(self, keys: np.ndarray, chunks: list[bytes]):
        encoded = self._encode(chunks)
        count = np.array([len(x) for x in encoded], np.int64)
        new_ids = np.concatenate([np.asarray(x, np.uint32) for x in encoded])
        first = np.cumsum(count) - count + len(self._ids)
        at = np.searchsorted(self._keys, keys)  # both are sorted
        self._keys = np.insert(self._keys, at, keys)
        self._first = np.insert(self._first, at, first)
        self._count = np.insert(self._count, at, count)
        self._ids = np.concatenate([self._ids, new_ids])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = utf8(texts)
        at = cuts(data, offsets)
        starts, ends = at[:-1], at[1:]
        keys, example, which = np.unique(span_hashes(data, starts, ends, self._seed), return_index=True, return_inverse=True)
        place = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self._keys)
        known[inside] = self._keys[place[inside]] == keys[inside]
        if not known.all():
            fresh = ~known
            if len(self._keys) + fresh.sum() > _KEPT_CHUNKS:
                fresh[:] = True  # the store starts anew, so all chunks of this batch are needed
                self._forget()
            whole = data.tobytes()
            chunks = [whole[b:e] for b, e in zip(starts[example[fresh]].tolist(), ends[example[fresh]].tolist(), strict=True)]
            self._learn(keys[fresh], chunks)
            place = np.searchsorted(self._keys, keys)
        counts = self._count[place][which]
        ids = self._ids[ragged(self._first[place][which], counts)]
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, before[np.searchsorted(starts, offsets)] if len(starts) else np.zeros(len(offsets), np.int64)
