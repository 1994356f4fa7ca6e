"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

The features are densities of lexicon words and stems, how near they stand to a second person, and
rates of capitals, punctuation and obfuscation. Lexicon, trees and calibration are fitted on the
driver, on at most SAMPLE labelled documents of each class, the first by a hash of their ids, none
longer than 64 kB. Features for the trees, and scores for the calibration, come from parts
of the sample that the document is not in; in the calibration the classes have their share among all
training labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.common import arrow_map, labelled_sample, slices, string_buffer

SAMPLE = 3000
FOLDS = 3
PART = 1 << 20  # bytes of text worked on at a time
STEMS = (4, 5, 6, 7, 8)  # bytes at the start of a word
HOLDERS = 3  # documents of the sample that an entry of the lexicon needs
ODDS = 1.5  # and its least log odds, one way or the other
STRONG = 3.0
NEAR = 5  # words

# Second-person words of the four languages.
SECOND_PERSON = (
    "you your yours yourself du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes tus"
).split()
# Characters that stand for letters in obfuscated words.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_PLAIN = np.arange(256, dtype=np.uint8)
_LETTERS_OF = _PLAIN.copy()
for _sign, _letter in LOOKALIKES.items():
    _LETTERS_OF[ord(_sign)] = ord(_letter)
_PERSON = np.unique(
    H.stretch_hashes(*(lambda raw, ends: (np.frombuffer(raw, np.uint8), ends - [len(w.encode()) for w in SECOND_PERSON], ends))(
        "".join(SECOND_PERSON).encode(), np.cumsum([len(w.encode()) for w in SECOND_PERSON])
    ))
)
_PUNCTUATION = H.class_table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_UPPER = H.class_table((0x41, 0x5A))
_DIGITS = H.class_table((0x30, 0x39))


def _parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts a bounded number of bytes at a time, with the place of the first."""
    batch, at = pa.RecordBatch.from_arrays([texts], names=["text"]), 0
    for part in slices(batch, "text", PART):
        yield at, part.column("text")
        at += part.num_rows


def _keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words and of their stems; a word shorter than a stem has none (0)."""
    out = [H.stretch_hashes(raw, starts, ends)]
    for stem in STEMS:
        full = ends - starts >= stem
        keys = np.zeros(len(starts), np.uint64)
        keys[full] = H.stretch_hashes(raw, starts[full], starts[full] + stem, H.SECOND)
        out.append(keys)
    return out


@dataclass
class Lexicon:
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.empty(0))

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.odds[at], 0.0)

    @classmethod
    def fit(cls, texts: pa.Array, labels: np.ndarray) -> Lexicon:
        """Log odds of every word and stem that enough documents hold, one count per document."""
        found: list[list[np.ndarray]] = [[] for _ in range(1 + len(STEMS))]
        whose: list[list[np.ndarray]] = [[] for _ in found]
        for first, part in _parts(texts):
            raw, offsets = string_buffer(part)
            raw = H.lower_ascii(raw)
            starts, ends, places = H.words(raw, offsets, H.LETTERS)
            for kind, keys in enumerate(_keys(raw, starts, ends)):
                for doc, (low, high) in enumerate(zip(places[:-1].tolist(), places[1:].tolist(), strict=True)):
                    own = np.unique(keys[low:high])
                    found[kind].append(own[own > 0])
                    whose[kind].append(np.full(len(found[kind][-1]), labels[first + doc], np.int8))
        # The hashes of words and of each stem are apart, so that each kind is counted by itself.
        counts = []
        for own, of in zip(found, whose, strict=True):
            keys, which = np.unique(np.concatenate(own), return_inverse=True) if own else (np.empty(0, np.uint64), np.empty(0, int))
            counts.append((keys, np.bincount(which, np.concatenate(of) if of else None, len(keys)), np.bincount(which, minlength=len(keys))))
        keys, bad, all_ = (np.concatenate(x) for x in zip(*counts, strict=True))
        order = np.argsort(keys)
        keys, bad, all_ = keys[order], bad[order], all_[order]
        n_bad, n = labels.sum(), len(labels)
        odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((all_ - bad + 0.5) / (n - n_bad + 1))
        keep = (all_ >= HOLDERS) & (np.abs(odds) >= ODDS)
        return cls(keys[keep], odds[keep])


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of numbers for each text; empty and null texts have zeros."""
    raw, offsets = string_buffer(texts)
    n = len(offsets) - 1
    size = np.diff(offsets)

    def rate(mask: np.ndarray, most: np.ndarray = size) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask)))
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(most, 1)

    columns = [rate(_UPPER[raw]), rate(_PUNCTUATION[raw]), rate(raw == 0x21), rate(_DIGITS[raw]), rate(raw >= 0x80)]
    again = np.zeros(len(raw), bool)
    again[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])
    columns.append(rate(again))
    lower = H.lower_ascii(raw)
    for signs in (_PLAIN, _LETTERS_OF):
        text = signs[lower]
        starts, ends, places = H.words(text, offsets, H.LETTERS)
        doc = np.repeat(np.arange(n), np.diff(places))
        count = np.maximum(np.diff(places), 1)
        keys = _keys(text, starts, ends)
        each = np.stack([lexicon.of(k) for k in keys])
        most = each.max(0, initial=0.0)

        def by_doc(values: np.ndarray, doc=doc) -> np.ndarray:
            return np.bincount(doc, values, n)

        strong = most >= STRONG
        hits = by_doc(strong)
        top = np.zeros(n)
        np.maximum.at(top, doc, most)
        columns += [hits, hits / count, top, by_doc(np.maximum(each[0], 0)) / count, by_doc(np.maximum(most, 0)) / count]
        columns += [by_doc(x >= STRONG) / count for x in each[1:]]
        if signs is _PLAIN:
            plain = hits
            # Words around each hit of the same text.
            person = np.isin(keys[0], _PERSON)
            sums = np.concatenate(([0], np.cumsum(person)))
            at = np.flatnonzero(strong)
            low, high = np.maximum(at - NEAR, places[doc[at]]), np.minimum(at + NEAR + 1, places[doc[at] + 1])
            near = np.zeros(len(starts))
            near[at] = sums[high] > sums[low]
            columns += [by_doc(near), by_doc(near) / np.maximum(hits, 1), by_doc(person) / count, by_doc(np.minimum(each.min(0, initial=0.0), 0)) / count]
            single = ends - starts == 1
            columns += [by_doc(single) / count, np.log1p(np.diff(places))]
            mixed = np.concatenate(([0], np.cumsum(_DIGITS[raw])))
            letters = mixed[ends] - mixed[starts]
            columns.append(by_doc((letters > 0) & (letters < ends - starts)) / count)
        else:
            columns.append(np.maximum(hits - plain, 0) / count)
    return np.stack(columns, 1)


BINS = 32
DEPTH = 3
TREES = 60
RATE = 0.15


@dataclass
class Trees:
    """Complete trees: an inner node sends values above its threshold to the right."""

    base: float
    split_on: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for on, at, leaf in zip(self.split_on, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, on[node]] > at[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1)
        mean = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        base = float(np.log(mean / (1 - mean)))
        score = np.full(n, base)
        trees = ([], [], [])
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            slope, bend = weight * (y - p), weight * p * (1 - p) + 1e-9
            on, at = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
            node = np.zeros(n, np.int64)
            for inner in range(2**DEPTH - 1):
                here = np.flatnonzero(node == inner)
                if len(here):
                    on[inner], at[inner] = cls._split(binned[here], slope[here], bend[here], edges)
                node[here] = 2 * inner + 1 + (x[here, on[inner]] > at[inner])
            place = node - (2**DEPTH - 1)
            leaf = RATE * np.bincount(place, slope, 2**DEPTH) / (np.bincount(place, bend, 2**DEPTH) + 1.0)
            score += leaf[place]
            for part, value in zip(trees, (on, at, leaf), strict=True):
                part.append(value)
        return cls(base, *(np.stack(part) for part in trees))

    @staticmethod
    def _split(binned: np.ndarray, slope: np.ndarray, bend: np.ndarray, edges: list[np.ndarray]) -> tuple[int, float]:
        best, found = 1e-6, (0, np.inf)
        total, all_ = slope.sum(), bend.sum()
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            g = np.cumsum(np.bincount(binned[:, f], slope, len(cuts) + 1))[:-1]
            h = np.cumsum(np.bincount(binned[:, f], bend, len(cuts) + 1))[:-1]
            gain = g**2 / (h + 1) + (total - g) ** 2 / (all_ - h + 1) - total**2 / (all_ + 1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = gain[k], (f, float(cuts[k]))
        return found


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising function nearest to y: neighbours that fall are pooled."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum of weighted y, weight, sum of weighted score
    for s, v, w in zip(score[order], y[order], weight[order], strict=True):
        pools.append([v * w, w, s * w])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: np.ndarray
    values: np.ndarray

    def probability(self, texts: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.values[0])
        raw = self.trees.raw(features(texts, self.lexicon))
        # Between the knots on a line; the rank within a level stays by a millionth of the score.
        level = np.interp(raw, self.knots, self.values)
        return np.clip(level + 1e-6 * np.tanh(raw / 10), 0.0, 1.0)


def fit(texts: list[str], labels: np.ndarray, share: float, part: np.ndarray) -> Model:
    """`share`: of label 1 among all training labels; `part`: the part, of FOLDS, of each document."""
    if not 0 < labels.sum() < len(labels):
        return Model(Lexicon(), None, np.zeros(1), np.array([share if len(labels) else 0.0]))
    column = pa.array(texts, pa.string())
    parts = [np.flatnonzero(part == i) for i in range(FOLDS)]
    if any(not 0 < labels[np.setdiff1d(np.arange(len(labels)), own)].sum() < len(labels) - len(own) for own in parts):
        parts = [np.arange(len(labels))]
    # A document's own words must not speak for it: its features come from a lexicon of the others.
    x = None
    for own in parts:
        others = np.setdiff1d(np.arange(len(labels)), own) if len(parts) > 1 else own
        lexicon = Lexicon.fit(column.take(pa.array(others)), labels[others])
        found = np.concatenate([features(part, lexicon) for _, part in _parts(column.take(pa.array(own)))])
        x = np.zeros((len(labels), found.shape[1])) if x is None else x
        x[own] = found
    raw = np.zeros(len(labels))
    for own in parts:
        others = np.setdiff1d(np.arange(len(labels)), own) if len(parts) > 1 else own
        raw[own] = Trees.fit(x[others], labels[others], np.ones(len(others))).raw(x[own])
    seen = labels.mean()
    weight = np.where(labels == 1, share / seen, (1 - share) / (1 - seen))
    knots, values = isotonic(raw, labels, weight)
    return Model(Lexicon.fit(column, labels), Trees.fit(x, labels, np.ones(len(labels))), knots, values)


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on the labelled documents that are `usable`; rows with a null or other label than 0, 1 are left out."""
    rows, share = labelled_sample(docs, labels, usable, label, sample)
    part = np.array([row.turn % FOLDS for row in rows], int)
    return fit([row.text.decode() for row in rows], np.array([row.label for row in rows], float), share, part)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score`, the probability of label 1, from 0 to 1.

    Null and empty texts are scored as a text without words; ids play no part; other columns are
    kept, one named `score` is replaced.
    """
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        result = shared.value.probability(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(result, pa.float64())], names=["row", "score"])

    frame = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), "text")
    schema = f"row {frame.schema['row'].dataType.simpleString()}, score double"
    return arrow_map(frame, run, schema, limit=PART).select("row.*", "score")
