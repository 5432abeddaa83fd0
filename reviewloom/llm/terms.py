"""Runs of bytes that belong together, and arrays as compressed bytes."""

import numpy as np
import zstandard


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true values, none across a text's edge, and the first run of each text (one
    more than there are texts)."""
    edge = np.ones(len(member) + 1, bool)
    edge[1:-1] = member[1:] != member[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = member[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(starts, offsets)


def pack(values: np.ndarray) -> bytes:
    """Bytes of like weight side by side, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
