"""Lattices of vocabulary pieces over many short texts at once, in numpy.

All texts lie one after the other in one array of code points. For each piece length one pass finds
the piece that starts at every place; then all texts advance together, place by place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from stoplines.llm import hashing as H

SPACE = 0x2581  # what stands for a space in pieces
LITERAL = 0x110000  # that character itself, in a text: no piece has it
FILTER = 1 << 20


@dataclass
class Vocabulary:
    """Pieces with scores; characters without a piece fall back to the pieces of their bytes.

    The scores of a file whose pieces are only ranked (0, -1, -2, ...) are used as they are.
    """

    ids: np.ndarray
    scores: np.ndarray
    pieces: list[str]
    byte_ids: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model file, which only the driver reads."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        byte_ids = np.array([model.piece_to_id(f"<0x{value:02X}>") for value in range(256)])
        special = {i for i in range(len(names)) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        ids = [i for i in range(len(names)) if i not in special]
        return cls(np.array(ids), np.array([model.get_score(i) for i in ids]), [names[i] for i in ids], byte_ids)

    def __post_init__(self) -> None:
        self.longest = max((len(piece) for piece in self.pieces), default=1)
        points = [np.array([ord(c) for c in piece], np.uint64) for piece in self.pieces]
        flat = np.concatenate(points) if points else np.empty(0, np.uint64)
        ends = np.cumsum([len(x) for x in points])
        hashes = H.stretch_hashes(flat, ends - [len(x) for x in points], ends) if points else np.empty(0, np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(FILTER, bool)
        self.seen[hashes & np.uint64(FILTER - 1)] = True
        # Without a piece that goes on after a space, words can be cut apart.
        self.cut_at_spaces = not any(chr(SPACE) in piece.lstrip(chr(SPACE)) for piece in self.pieces)
        self.fallback = float(self.scores.min() - 10) if len(self.scores) else -10.0

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that every id stands for, one after the other, and how many each has."""
        table = {int(i): piece.replace(chr(SPACE), " ").encode() for i, piece in zip(self.ids, self.pieces, strict=True)}
        table |= {int(i): bytes([value]) for value, i in enumerate(self.byte_ids)}
        texts = [table.get(i, b"") for i in range(max(table) + 1)]
        return np.frombuffer(b"".join(texts), np.uint8), np.array([len(x) for x in texts])

    @cached_property
    def slots(self) -> np.ndarray:
        """Where among `hashes` the one with these last bits is: -1 for none, -2 for several, which are then searched."""
        short, first, n = np.unique(self.hashes & np.uint64(FILTER - 1), return_index=True, return_counts=True)
        out = np.full(FILTER, -1, np.int32)
        out[short] = np.where(n == 1, first, -2)
        return out

    @cached_property
    def begun(self) -> np.ndarray:
        """As `seen`, of the hashes of all that pieces begin with and go on after."""
        points = np.array([ord(c) for piece in self.pieces for c in piece], np.uint64)
        sizes = np.array([len(piece) for piece in self.pieces], np.int64)
        starts = np.cumsum(sizes) - sizes
        out = np.zeros(FILTER, bool)
        for length in range(1, self.longest):
            some = starts[sizes > length]
            out[H.stretch_hashes(points, some, some + length) & np.uint64(FILTER - 1)] = True
        return out

    def matches(self, points: np.ndarray, room: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, places and numbers of all pieces at all places; a place is left as soon as no piece begins like it."""
        n = len(points)
        if not len(self.hashes):
            return
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * H.powers(H.BASE, n), out=sums[1:])
        back = H.powers(pow(H.BASE, -1, 1 << 64), n + 1)
        places = np.arange(n)
        for length in range(1, self.longest + 1):
            places = places[room[places] >= length]
            if not len(places):
                return
            hashes = H.mix((sums[places + length] - sums[places]) * back[places] + np.uint64(length))
            short = hashes & np.uint64(FILTER - 1)
            at = self.slots[short]
            maybe = np.flatnonzero(at != -1)
            at = at[maybe]
            several = np.flatnonzero(at == -2)
            at[several] = np.minimum(np.searchsorted(self.hashes, hashes[maybe[several]]), len(self.hashes) - 1)
            good = self.hashes[at] == hashes[maybe]
            yield length, places[maybe[good]], self.order[at[good]]
            places = places[self.begun[short]]

    def starting(self, points: np.ndarray, room: np.ndarray) -> np.ndarray:
        """[longest, n]: number of the piece of each length at each place, -1 for none; `room` is left up to the text's end."""
        n = len(points)
        out = np.full((self.longest, n), -1, np.int32)
        if not len(self.hashes):
            return out
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * H.powers(H.BASE, n), out=sums[1:])
        back = H.powers(pow(H.BASE, -1, 1 << 64), n + 1)
        for length in range(1, min(self.longest, n) + 1):
            hashes = H.mix((sums[length:] - sums[:-length]) * back[: n - length + 1] + np.uint64(length))
            maybe = np.flatnonzero(self.seen[hashes & np.uint64(FILTER - 1)] & (room[: len(hashes)] >= length))
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            good = self.hashes[at] == hashes[maybe]
            out[length - 1, maybe[good]] = self.order[at[good]]
        return out


class Lattice:
    """The pieces over texts [begin, end) of `points`; texts are longest first inside."""

    def __init__(self, vocabulary: Vocabulary, points: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes
        self.begin = np.cumsum(sizes) - sizes
        self.room = np.repeat(self.begin + sizes, sizes) - np.arange(len(points))
        self.piece = vocabulary.starting(points, self.room)
        self.none = len(vocabulary.pieces)  # the fallback's number
        self.bytes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + ((points >= 0x10000) & (points != LITERAL))
        self.piece[0, self.piece[0] < 0] = self.none

    def steps(self):
        """Place in the texts, and the first places of the texts that reach it, longest first."""
        begin, sizes = self.begin[self.order], self.sizes[self.order]
        for place in range(int(sizes[0]) if len(sizes) else 0):
            yield place, begin[: np.searchsorted(-sizes, -place, "left")] + place

    def weights(self, weight: np.ndarray, per_byte: float) -> np.ndarray:
        """Weight of the piece of each length at each place; a missing piece is -inf, a fallback pays per byte."""
        table = np.concatenate((weight, [-np.inf]))
        out = table[self.piece]
        lone = self.piece[0] == self.none
        out[0, lone] = weight[self.none] + per_byte * self.bytes[lone]
        return out

    def forward(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of the summed weights of all ways to reach each place, and of each text as a whole."""
        n = weights.shape[1]
        reach = np.full(n, -np.inf)
        total = np.full(len(self.sizes), -np.inf)
        reach[self.begin[self.sizes > 0]] = 0
        total[self.sizes == 0] = 0
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        for _, places in self.steps():
            here = reach[places]
            for k in range(len(weights)):
                way = weights[k, places]
                live = np.flatnonzero(way > -np.inf)
                if not len(live):
                    continue
                at, sum_ = places[live], here[live] + way[live]
                room = self.room[at]
                inner = room > k + 1
                reach[at[inner] + k + 1] = np.logaddexp(reach[at[inner] + k + 1], sum_[inner])
                last = text[at[~inner]]
                total[last] = np.logaddexp(total[last], sum_[~inner])
        return reach, total

    def expected(self, weights: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (the fallback last) over all segmentations, each text `times` times."""
        reach, total = self.forward(weights)
        n = weights.shape[1]
        ahead = np.full(n + len(weights) + 1, -np.inf)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        uses = np.zeros(self.none + 1)
        for _, places in reversed(list(self.steps())):
            own = np.full(len(places), -np.inf)
            for k in range(len(weights)):
                way = weights[k, places]
                live = np.flatnonzero(way > -np.inf)
                if not len(live):
                    continue
                at = places[live]
                rest = np.where(self.room[at] > k + 1, ahead[at + k + 1], 0.0)
                value = way[live] + rest
                own[live] = np.logaddexp(own[live], value)
                share = np.exp(reach[at] + value - total[text[at]]) * times[text[at]]
                uses += np.bincount(self.piece[k, at], share, minlength=self.none + 1)
            ahead[places] = own
        return uses

    def best(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best score of each text, and at each place the length of the piece on the best way that ends there.

        The second array has one more place per text, for its end: place i of text t is at i + t.
        Of equally good ways the one with the longer last piece is taken.
        """
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        score = np.full(weights.shape[1] + len(self.sizes), -np.inf)
        length = np.zeros(len(score), np.int32)
        score[self.begin + np.arange(len(self.sizes))] = 0
        for _, places in self.steps():
            own = places + text[places]
            here = score[own]
            for k in range(len(weights)):
                way = weights[k, places]
                live = np.flatnonzero(way > -np.inf)
                if not len(live):
                    continue
                value, at = here[live] + way[live], own[live] + k + 1
                better = (value > score[at]) | ((value == score[at]) & (k + 1 > length[at]))
                score[at[better]] = value[better]
                length[at[better]] = k + 1
        return score[self.begin + self.sizes + np.arange(len(self.sizes))], length


class Ways:
    """The pieces over many short texts as a list of ways from place to place, for sums over all segmentations.

    A text has one place more than letters. Ways are in the order of the letter of their text that they begin at, then of
    texts and lengths, so that a step takes all ways from one letter of all texts; no two of them lead to the same place.
    """

    def __init__(self, vocabulary: Vocabulary, points: np.ndarray, sizes: np.ndarray):
        n = len(points)
        start = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        letter = np.arange(n) - start[text]
        self.none = len(vocabulary.pieces)  # the fallback's number
        single = np.full(n, self.none)
        longer = []
        for length, at, pieces in vocabulary.matches(points, sizes[text] - letter):
            if length == 1:
                single[at] = pieces
            else:
                longer.append((length, at, pieces))
        number = np.ones(n, np.int64)
        for _, at, _ in longer:
            number[at] += 1
        # Two bytes are sorted faster; a longer text is rare.
        order = np.argsort(letter.astype(np.uint16) if sizes.max(initial=0) <= 1 << 16 else letter, kind="stable")
        ends = np.cumsum(number[order])
        total = int(ends[-1]) if n else 0
        to = np.empty(n, np.int64)
        to[order] = ends - number[order]
        begin, length_of, self.piece = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int64)
        firsts = to[order]
        for length, at, pieces in [(1, np.arange(n), single), *longer]:
            way = to[at]
            begin[way], length_of[way], self.piece[way] = at, length, pieces
            to[at] += 1
        self.text = text[begin]
        self.lone = np.flatnonzero(self.piece == self.none)
        bare = points[begin[self.lone]]
        self.bytes = 1 + (bare >= 0x80).astype(np.int8) + (bare >= 0x800) + ((bare >= 0x10000) & (bare != LITERAL))
        self.begin = begin + self.text
        self.end = self.begin + length_of
        self.first = start + np.arange(len(sizes))
        self.last = self.first + sizes
        places = np.concatenate(([0], np.cumsum(np.bincount(letter)))) if n else np.zeros(1, np.int64)
        edges = np.append(firsts, total)[places].tolist()
        # The ways of each step, and the first way of each place among them.
        self.steps = [
            (slice(a, b), firsts[p:q] - a)
            for a, b, p, q in zip(edges[:-1], edges[1:], places[:-1].tolist(), places[1:].tolist(), strict=True)
        ]

    def weights(self, table: np.ndarray, per_byte: float, number: np.ndarray | None = None) -> np.ndarray:
        """Weight of each way: the row of the table for its piece, or with that `number`; a fallback pays per byte."""
        out = table[self.piece if number is None else number]
        out[self.lone] += (per_byte * self.bytes).reshape(-1, *[1] * (out.ndim - 1))
        return out

    def forward(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of the summed weights of all ways to reach each place, and of each text as a whole; for each column of weights."""
        reach = np.full((int(self.last[-1]) + 1 if len(self.last) else 0, *weights.shape[1:]), -np.inf)
        reach[self.first] = 0
        for step, _ in self.steps:
            end = self.end[step]
            reach[end] = np.logaddexp(reach[end], reach[self.begin[step]] + weights[step])
        return reach, reach[self.last]

    def expected(self, weights: np.ndarray) -> np.ndarray:
        """How often each way is expected to be taken."""
        reach, total = self.forward(weights)
        ahead = np.full(len(reach), -np.inf)
        ahead[self.last] = 0
        for step, firsts in reversed(self.steps):
            value = weights[step] + ahead[self.end[step]]
            ahead[self.begin[step][firsts]] = np.logaddexp.reduceat(value, firsts)
        return np.exp(reach[self.begin] + weights + ahead[self.end] - total[self.text])
