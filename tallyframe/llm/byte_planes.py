"""Arrays of numbers as compressed bytes."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    kind = np.dtype(kind)
    planes = np.ascontiguousarray(numbers.astype(kind)).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes | memoryview, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()
