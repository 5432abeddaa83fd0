"""Texts of an Arrow batch as one array of UTF-8 bytes, cut into words or chunks without a loop over rows.

Spans of bytes are hashed all at once, or told apart by their bytes through a dictionary.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SHORT_BYTES = 64
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and the offsets at which each text begins (one more than there are texts); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = texts.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = wide.buffers()[2]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of each ``data[start:end]``. Spans are in ascending order and do not overlap."""
    lengths = ends - starts
    filled = lengths > 0
    change = np.zeros(len(data) + 1, np.int8)
    change[starts[filled]] += 1
    change[ends[filled]] -= 1
    packed = data[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each value among the distinct ones, and these."""
    encoded = pc.dictionary_encode(values)
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``; equal bytes give equal hashes wherever they stand.

    A span of up to ``_SHORT_BYTES`` is taken in eight bytes at a time, all spans at once; between two steps the state is mixed, so
    that (unlike with polynomials) no rearrangement of bytes cancels out. Longer ones are hashed by XXH3 one by one.
    """
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each position on
    for step in range(0, _SHORT_BYTES, 8):
        left = lengths - step
        at = np.flatnonzero((left > 0) & (lengths <= _SHORT_BYTES))
        if not len(at):
            break
        taken = eights[starts[at] + step] & _FIRST_BYTES[np.minimum(left[at], 8)]
        out[at] = mix(out[at] ^ (taken * np.uint64(0x9E3779B97F4A7C15)))
    for i in np.flatnonzero(lengths > _SHORT_BYTES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+``, and the number of the first word of each text
    (one more than there are texts)."""
    blank = _BLANKS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = blank[1:] != blank[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = ~blank[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z in lower case, and each text's first word."""
    data, offsets = utf8(texts)
    data = lower_ascii(data)
    starts, ends, first = words(data, offsets)
    return span_hashes(data, starts, ends), first


def slices(texts: pa.Array, most_bytes: int = 4_000_000):
    """The batch in runs of whole texts of about ``most_bytes``, so that work arrays stay small."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets = utf8(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + most_bytes, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield texts.slice(begin, end - begin)
        begin = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of all runs, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - before, lengths)
