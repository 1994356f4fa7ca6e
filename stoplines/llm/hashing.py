"""Words and hashes of whole batches of texts, in numpy.

Hashes are sums of powers of an odd number modulo 2^64. Since odd numbers have inverses there,
the hash of any stretch follows from two running sums, and a window costs the same whatever its
length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
SECOND = 0xC2B2AE3D27D4EB4F
BLOCK = 1 << 18


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers."""
    return _powers(base, 1 << max(16, int(n - 1).bit_length()))[:n]


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits; different values stay different."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of values[start:end] for each pair; unsigned values, ends exclusive, starts ascending."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # As many stretches as begin within one block: memory doesn't grow with the whole.
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(starts, low + BLOCK)))
        high = ends[at:to].max()
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((values[low:high].astype(np.uint64) + np.uint64(1)) * powers(base, high - low), out=sums[1:])
        first, last = starts[at:to] - low, ends[at:to] - low
        back = powers(pow(base, -1, 1 << 64), high - low + 1)
        out[at:to] = mix((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))
        at = to
    return out


def window_hashes(values: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Hash of every `width` consecutive values."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=sums[1:])
    out = sums[width:] - sums[:-width]
    out *= powers(pow(base, -1, 1 << 64), n - width + 1)
    return mix(out)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return np.frombuffer(raw.tobytes().lower(), np.uint8)


def class_table(*allowed: tuple[int, int]) -> np.ndarray:
    """A lookup of 256 booleans, true for bytes within the given inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in allowed:
        out[low : high + 1] = True
    return out


# Words by white space: anything but space and the controls 09-0D. Bytes of 80 and above belong to
# characters beyond ASCII and so to words.
NOT_SPACE = ~class_table((0x20, 0x20), (0x09, 0x0D))
# Words by letters: a-z, 0-9 and everything beyond ASCII.
LETTERS = class_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def words(raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words of the texts, and the n + 1 places of each text's words."""
    # Translating bytes takes a part of the time of indexing by them.
    inside = np.frombuffer(raw.tobytes().translate(word_bytes.tobytes()), bool)
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean array of n: true within any of the stretches."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
