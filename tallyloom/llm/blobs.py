"""Arrays of whole numbers as compressed bytes, for shuffles of many small numbers."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Byte planes of non-negative numbers, as many as the largest needs, compressed: small numbers cost little."""
    v = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.int64)
