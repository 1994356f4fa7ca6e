"""Compressed bundles: what one task sends to one bucket, as one binary value."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_HEAD = 8


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def pack(arrays: list[np.ndarray], payload: bytes) -> bytes:
    """Arrays of equal length and bytes. Integers are stored plane by plane, which compresses well."""
    n = len(arrays[0])
    planes = [np.ascontiguousarray(x.astype("<i8", copy=False)).view(np.uint8).reshape(n, 8).T.tobytes() for x in arrays]
    plain = n.to_bytes(_HEAD, "little") + b"".join(planes) + payload
    return len(plain).to_bytes(_HEAD, "little") + _codec().compress(plain, asbytes=True)


def unpack(blob: bytes, count: int) -> tuple[list[np.ndarray], bytes]:
    """The `count` arrays, as int64, and the bytes."""
    plain = _codec().decompress(blob[_HEAD:], int.from_bytes(blob[:_HEAD], "little"), asbytes=True)
    n = int.from_bytes(plain[:_HEAD], "little")
    arrays, at = [], _HEAD
    for _ in range(count):
        plane = np.frombuffer(plain, np.uint8, 8 * n, at).reshape(8, n)
        arrays.append(np.ascontiguousarray(plane.T).view("<i8").reshape(n))
        at += 8 * n
    return arrays, plain[at:]
