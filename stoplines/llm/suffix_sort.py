"""External induced suffix sorting of one shard.

The text is a row of byte strings, each followed by a 0 that no byte has. The leftmost S-suffixes
(LMS) are sorted by the names of the stretches between them, doubled until the names cover the
depth asked for. All other suffixes are induced: L-suffixes in ascending, then S-suffixes in
descending order of their first byte. Each byte value has a queue of suffix places; a queue is
first in, first out, and the values are visited in order, so that together they are one priority
queue. Queues beyond a memory limit are kept in an unlinked temporary file of the worker, which a
lost executor takes with it: the task is then run again from the shuffle.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 18  # suffixes taken from a queue at a time
MEMORY = 64 << 20  # bytes that the queues of a shard hold in memory
VALUES = 257


class Spool:
    """Memory and the file that the queues of a shard share."""

    def __init__(self, memory: int = MEMORY):
        self.left = memory
        self.file = None
        self.end = 0

    def keep(self, places: np.ndarray) -> np.ndarray | tuple[int, int]:
        if places.nbytes <= self.left:
            self.left -= places.nbytes
            return places
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        self.file.write(places.tobytes())
        at, self.end = self.end, self.end + places.nbytes
        return at, len(places)

    def take(self, part: np.ndarray | tuple[int, int], drop: bool) -> np.ndarray:
        if isinstance(part, np.ndarray):
            if drop:
                self.left += part.nbytes
            return part
        self.file.seek(part[0])
        return np.frombuffer(self.file.read(8 * part[1]), np.int64)


class Queue:
    def __init__(self, spool: Spool):
        self.spool = spool
        self.parts: list = []
        self.small: list[np.ndarray] = []
        self.waiting = 0

    def push(self, places: np.ndarray) -> None:
        if len(places):
            self.small.append(places)
            self.waiting += len(places)
            if self.waiting >= CHUNK:
                self.flush()

    def flush(self) -> None:
        if self.small:
            whole = np.concatenate(self.small) if len(self.small) > 1 else self.small[0]
            for at in range(0, len(whole), CHUNK):
                self.parts.append(self.spool.keep(whole[at : at + CHUNK]))
            self.small, self.waiting = [], 0

    def pull(self) -> Iterator[np.ndarray]:
        """All places, first in first out; the queue is then empty."""
        self.flush()
        parts, self.parts = self.parts, []
        for part in parts:
            yield self.spool.take(part, True)

    def read(self, backwards: bool = False) -> Iterator[np.ndarray]:
        self.flush()
        for part in reversed(self.parts) if backwards else self.parts:
            places = self.spool.take(part, False)
            yield places[::-1] if backwards else places


def _is_small(text: np.ndarray) -> np.ndarray:
    """True for S-suffixes: smaller than the suffix after them. The last place is one."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16)))
    # The next step that is not level decides.
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = np.append(step, 1)[following] > 0
    return small


def _names(text: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """For each LMS place the rank of its stretch up to the next LMS place, that included.

    Where one stretch begins another, its last byte is followed by a greater one, and the other's
    same byte by a smaller one: the end sorts last, but for the end of the text.
    """
    per, bits = 7, 9
    ended = np.full(len(lms), (1 << bits) - 1)
    ended[-1] = 0
    size = np.diff(np.append(lms, len(text) - 1)) + 1
    padded = np.concatenate((text, np.zeros(per + 1, text.dtype)))

    def key(which: np.ndarray, done: int) -> np.ndarray:
        out = np.zeros(len(which), np.int64)
        left = size[which] - done
        for k in range(per):
            value = np.where(k < left, padded[np.minimum(lms[which] + done + k, len(text))].astype(np.int64) + 1, ended[which])
            out = (out << bits) | value
        return out

    order = np.argsort(first := key(np.arange(len(lms)), 0), kind="stable")
    keys = first[order]
    fresh = np.ones(len(lms), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(fresh)
    done, at = per, np.arange(len(lms))
    while True:
        # Equal so far and not ended: look at the next bytes of these.
        tied = np.zeros(len(at), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        tied &= size[order[at]] >= done  # the end itself is yet to be compared
        if not tied.any():
            break
        at, group = at[tied], group[tied]
        keys = key(order[at], done)
        new = np.lexsort((keys, group))
        order[at] = order[at[new]]
        keys, group = keys[new], group[new]
        cut = np.ones(len(at), bool)
        cut[1:] = (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])
        fresh[at] |= cut
        group = np.cumsum(cut)
        done += per
    names = np.empty(len(lms), np.int64)
    names[order] = np.cumsum(fresh)
    return names


def _sorted_lms(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """The LMS places in the order of their suffixes, to `depth` bytes at least."""
    rank = _names(text, lms)
    n, step = len(lms), 1
    ends = np.append(lms, np.full(1, len(text)))
    while True:
        order = np.argsort(rank, kind="stable")
        sorted_rank = rank[order]
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied = np.zeros(n, bool)
        tied[1:] |= same
        tied[:-1] |= same
        tied &= ends[np.minimum(order + step, n)] - lms[order] < depth
        if not tied.any():
            return lms[order]
        at = np.flatnonzero(tied)
        own = order[at]
        second = np.where(own + step < n, rank[np.minimum(own + step, n - 1)], 0)
        new = np.lexsort((second, sorted_rank[at]))
        order[at] = own[new]
        # Ranks are first places of their groups, so that the rest need not change.
        first, second = sorted_rank[at][new], second[new]
        cut = np.ones(len(at), bool)
        cut[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        base = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
        base[at] |= cut
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(base)
        step *= 2


def suffixes(text: np.ndarray, depth: int, memory: int = MEMORY) -> Iterator[np.ndarray]:
    """The places of `text` (values 0 to 256, the last a 0) sorted by the next `depth` values, in chunks.

    Suffixes that agree that far are next to each other, in any order.
    """
    small = _is_small(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        lms = np.array([len(text) - 1])
    seeds = _sorted_lms(text, lms, depth)
    seed_ends = np.searchsorted(text[seeds], np.arange(VALUES), "right")
    spool = Spool(memory)
    large = [Queue(spool) for _ in range(VALUES)]
    done_large = [Queue(spool) for _ in range(VALUES)]

    def deal(places: np.ndarray, queues: list[Queue], keep) -> np.ndarray:
        """Push the places before these under their bytes, if `keep` says so of the byte; return the bytes' equals."""
        before = places[places > 0] - 1
        values = text[before]
        chosen = keep(values)
        before, values = before[chosen[0]], values[chosen[0]]
        order = np.argsort(values, kind="stable")
        before, values = before[order], values[order]
        cuts = np.flatnonzero(np.diff(values)) + 1
        for part in np.split(before, cuts) if len(before) else []:
            queues[text[part[0]]].push(part)
        return (places[places > 0] - 1)[chosen[1]]

    for value in range(VALUES):
        waiting = large[value]
        while waiting.parts or waiting.small:
            level = Queue(spool)
            for places in waiting.pull():
                done_large[value].push(places)
                level.push(deal(places, large, lambda v: (v > value, v == value)))
            waiting = level
        begin = seed_ends[value - 1] if value else 0
        for at in range(begin, seed_ends[value], CHUNK):
            deal(seeds[at : min(at + CHUNK, seed_ends[value])], large, lambda v: (v > value, v < 0))

    little = [Queue(spool) for _ in range(VALUES)]
    done_little = [Queue(spool) for _ in range(VALUES)]
    for value in range(VALUES - 1, -1, -1):
        waiting = little[value]
        while waiting.parts or waiting.small:
            level = Queue(spool)
            for places in waiting.pull():
                done_little[value].push(places)
                level.push(deal(places, little, lambda v: (v < value, v == value)))
            waiting = level
        for places in done_large[value].read(backwards=True):
            deal(places, little, lambda v: (v < value, v < 0))
        if value == 0:
            done_little[0].push(np.array([len(text) - 1]))
    for value in range(VALUES):
        yield from done_large[value].read()
        yield from done_little[value].read(backwards=True)


def common_prefixes(data: np.ndarray, one: np.ndarray, two: np.ndarray, most: int) -> np.ndarray:
    """Common prefix, in whole steps of 8 bytes and at most `most`, of the strings at each pair of places.

    `data` needs 8 spare bytes after the last byte compared.
    """
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = np.zeros(len(one), np.int32)
    live = np.arange(len(one))
    for done in range(0, most, 8):
        step = min(done, most - 8)
        equal = words[one[live] + step] == words[two[live] + step]
        live = live[equal]
        if not len(live):
            break
        out[live] = step + 8
    return out
