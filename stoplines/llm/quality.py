"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it. Filters of 8 bytes run over learned byte
vectors and over one fixed channel, the share of 8-byte strings that came before in the same
kilobyte. The greatest response of each filter in a chunk is kept; the greatest and the mean over
all chunks of a document go through one hidden layer to a probability.

The network is fitted on the driver on at most SAMPLE labelled documents of each class, the first by
a hash of their ids, none longer than 64 kB; the class shares that set its bias are counted over all training labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoplines.llm.common import arrow_map, labelled_sample, string_buffer

SAMPLE = 1500  # labelled documents of each class at most
WIDTH = 8  # bytes of a filter
VECTOR = 5  # learned numbers for each byte
FILTERS = 16
HIDDEN = 12
BLOCK = 64
CELL = 1024  # a chunk is a kilobyte; each starts half a kilobyte after the one before
SEGMENT = 1 << 18
SLICE = 1 << 21
EPOCHS = 8
TABLE = 4096


class Layout:
    """Texts in one flat array of whole cells; long texts in several segments."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        pieces = np.maximum(1, -(-lengths // SEGMENT))
        self.doc = np.repeat(np.arange(len(lengths)), pieces)
        part = np.arange(len(self.doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = offsets[:-1][self.doc] + part * SEGMENT
        # Segments overlap by a filter's width less one byte.
        end = np.minimum(begin + SEGMENT + WIDTH - 1, offsets[1:][self.doc])
        self.begin, self.size = begin, np.maximum(end - begin, 0)
        self.slots = np.maximum(1, -(-self.size // CELL)) * CELL
        self.raw = raw

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of segments of about SLICE bytes: document of each segment, flat bytes, ends of slots."""
        at = 0
        while at < len(self.doc):
            ends = np.cumsum(self.slots[at:])
            n = max(1, int(np.searchsorted(ends, SLICE, "right")))
            ends = ends[:n]
            flat = np.zeros(ends[-1], np.uint8)
            size = self.size[at : at + n]
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            flat[np.repeat(ends - self.slots[at : at + n], size) + within] = self.raw[np.repeat(self.begin[at : at + n], size) + within]
            yield self.doc[at : at + n], flat, ends
            at += n


def repeats(flat: np.ndarray) -> np.ndarray:
    """For each block the share of places whose next 8 bytes came before in their cell."""
    n = len(flat)
    padded = np.concatenate((flat, np.zeros(8, np.uint8)))
    grams = np.ndarray(n, "<u8", padded, strides=(1,)).copy()
    slot = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int32)
    place = np.arange(n, dtype=np.int32)
    slot += (place // CELL) * TABLE
    first = np.zeros(n // CELL * TABLE, np.int32)
    first[slot[::-1]] = place[::-1]  # the earliest place is written last
    before = first[slot]
    again = (before < place) & (grams[before] == grams) & (flat > 0)
    return again.reshape(-1, BLOCK).mean(1, dtype=np.float32)


class Network:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        channels = VECTOR + 1
        self.p = {
            "vectors": rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
            "filters": rng.normal(0, (WIDTH * channels) ** -0.5, (WIDTH * channels, FILTERS)).astype(np.float32),
            "offset": np.zeros(FILTERS, np.float32),
            "inner": rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)).astype(np.float32),
            "inner0": np.zeros(HIDDEN, np.float32),
            "outer": rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
            "outer0": np.zeros(1, np.float32),
        }
        self.shift = 0.0

    def channels(self, flat: np.ndarray) -> np.ndarray:
        out = np.empty((len(flat), VECTOR + 1), np.float32)
        out[:, :VECTOR] = self.p["vectors"][flat]
        out[:, VECTOR] = np.repeat(repeats(flat), BLOCK)
        return out

    def blocks(self, values: np.ndarray, ends: np.ndarray, places: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Greatest response of each filter in each block, and where it is."""
        n, filters = len(values), self.p["filters"]
        line = np.concatenate((values.reshape(-1), np.zeros(WIDTH * values.shape[1], np.float32)))
        best = np.full((n // BLOCK, FILTERS), -np.inf, np.float32)
        where = np.zeros((n // BLOCK, FILTERS), np.int32) if places else None
        last = ends // WIDTH - 1
        for shift in range(WIDTH):
            at = shift * values.shape[1]
            response = line[at : at + n * values.shape[1]].reshape(n // WIDTH, -1) @ filters
            if shift:
                response[last] = -np.inf  # these would reach into the next slot
            response = response.reshape(-1, BLOCK // WIDTH, FILTERS)
            if places:
                index = response.argmax(1)
                top = np.take_along_axis(response, index[:, None], 1)[:, 0]
                better = top > best
                where[better] = (np.arange(n // BLOCK)[:, None] * BLOCK + index * WIDTH + shift)[better]
                best[better] = top[better]
            else:
                np.maximum(best, response.max(1), out=best)
        return best, where

    @staticmethod
    def chunks(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end block of each chunk, and its slot; two chunks begin in each cell but the last."""
        stops = ends // BLOCK
        starts = np.concatenate(([0], stops[:-1]))
        step = CELL // BLOCK // 2
        counts = np.maximum(1, (stops - starts) // step - 1)
        slot = np.repeat(np.arange(len(ends)), counts)
        first = starts[slot] + step * (np.arange(len(slot)) - np.repeat(np.cumsum(counts) - counts, counts))
        return first, np.minimum(first + 2 * step, stops[slot]), slot

    def pooled(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        top, total, count = np.zeros((n, FILTERS), np.float32), np.zeros((n, FILTERS)), np.zeros(n)
        for doc, flat, ends in Layout(raw, offsets).groups():
            best, _ = self.blocks(self.channels(flat), ends, False)
            first, stop, slot = self.chunks(ends)
            best = np.concatenate((best, best[-1:]))
            chunk = np.maximum.reduceat(best, np.stack((first, stop), 1).reshape(-1), axis=0)[::2]
            chunk = np.maximum(chunk + self.p["offset"], 0)
            np.maximum.at(top, doc[slot], chunk)
            np.add.at(total, doc[slot], chunk)
            np.add.at(count, doc[slot], 1)
        return np.concatenate((top, (total / count[:, None]).astype(np.float32)), 1)

    def probability(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        features = self.pooled(raw, offsets)
        inner = np.maximum(features @ self.p["inner"] + self.p["inner0"], 0)
        return 1 / (1 + np.exp(-(inner @ self.p["outer"] + self.p["outer0"][0] + self.shift).astype(np.float64)))

    def gradients(self, raw: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        top = np.zeros((len(labels), FILTERS), np.float32)
        total = np.zeros((len(labels), FILTERS), np.float32)
        count = np.zeros(len(labels), np.float32)
        parts = []
        for doc, flat, ends in Layout(raw, offsets).groups():
            values = self.channels(flat)
            best, where = self.blocks(values, ends, True)
            first, stop, slot = self.chunks(ends)
            index = np.minimum(first[:, None] + np.arange(CELL // BLOCK), stop[:, None] - 1)
            choice = best[index].argmax(1)
            block = np.take_along_axis(index, choice, 1)
            columns = np.arange(FILTERS)
            chunk = np.maximum(best[block, columns] + p["offset"], 0)
            owner = doc[slot]
            np.maximum.at(top, owner, chunk)
            np.add.at(total, owner, chunk)
            np.add.at(count, owner, 1)
            parts.append((flat, values, owner, chunk, where[block, columns]))
        ties = np.zeros_like(top)
        for _, _, owner, chunk, _ in parts:
            np.add.at(ties, owner, chunk >= top[owner])
        ties = np.maximum(ties, 1)
        features = np.concatenate((top, total / count[:, None]), 1)
        inner = np.maximum(features @ p["inner"] + p["inner0"], 0)
        error = (1 / (1 + np.exp(-(inner @ p["outer"] + p["outer0"][0]))) - labels).astype(np.float32) / len(labels)
        back = error[:, None] * p["outer"] * (inner > 0)
        g = {"outer": inner.T @ error, "outer0": error.sum(keepdims=True), "inner": features.T @ back, "inner0": back.sum(0)}
        back = back @ p["inner"].T
        g["filters"], g["offset"], g["vectors"] = np.zeros_like(p["filters"]), np.zeros_like(p["offset"]), np.zeros_like(p["vectors"])
        for flat, values, owner, chunk, where in parts:
            # Overlapping chunks often share their greatest response; they share its slope too.
            best = chunk >= top[owner]
            slope = back[owner, FILTERS:] / count[owner, None] + back[owner, :FILTERS] * best / ties[owner]
            slope *= chunk > 0
            g["offset"] += slope.sum(0)
            # Vectors of the bytes under each filter's best place.
            at = np.minimum(where[:, :, None] + np.arange(WIDTH), len(flat) - 1)
            seen = values[at].reshape(len(chunk), FILTERS, -1)
            g["filters"] += np.einsum("cf,cfk->kf", slope, seen, optimize=True)
            pull = (slope[:, :, None] * p["filters"].T).reshape(len(chunk), FILTERS, WIDTH, VECTOR + 1)
            live = np.abs(slope) > 0
            np.add.at(g["vectors"], flat[at[live]].reshape(-1), pull[live][..., :VECTOR].reshape(-1, VECTOR))
        return g


def fit(texts: list[bytes], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """`share`: of label 1 among all training labels; the sample may be balanced otherwise."""
    network = Network(seed)
    clipped = min(max(share, 1e-6), 1 - 1e-6)
    prior = np.log(clipped / (1 - clipped))
    if not 0 < labels.sum() < len(labels):
        network.p["outer"][:] = 0
        network.shift = prior if len(labels) else 0.0
        return network
    rng = np.random.default_rng(seed)
    steps = {name: (np.zeros_like(x), np.zeros_like(x)) for name, x in network.p.items()}
    t, size = 0, 32
    rounds = epochs * -(-len(texts) // size)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), size):
            chosen = order[i : i + size]
            raw = np.frombuffer(b"".join(texts[k] for k in chosen), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(texts[k]) for k in chosen])))
            t += 1
            rate = 0.01 * (1 - 0.95 * t / rounds)
            for name, g in network.gradients(raw, offsets, labels[chosen]).items():
                mean, square = steps[name]
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                network.p[name] -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    seen = labels.mean()
    network.shift = float(prior - np.log(seen / (1 - seen)))
    return network


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", sample: int = SAMPLE) -> Network:
    """Fit on the labelled documents that are `usable`; rows with a null or other label than 0, 1 are left out."""
    rows, share = labelled_sample(docs, labels, usable, label, sample)
    return fit([bytes(row.text) for row in rows], np.array([row.label for row in rows], np.float32), share)


def score(docs: DataFrame, network: Network) -> DataFrame:
    """`docs` with `score`, the probability of label 1, from 0 to 1.

    Null and empty texts are scored as an empty document; every row has a score, whatever its id;
    other columns are kept, one named `score` is replaced.
    """
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        result = shared.value.probability(*string_buffer(batch.column("text")))
        return batch.append_column("score", pa.array(result, pa.float64()))

    frame = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), "text")
    out = arrow_map(frame, lambda b: run(b).drop_columns(["text"]), f"row {frame.schema['row'].dataType.simpleString()}, score double")
    return out.select("row.*", "score")


def keep_good(docs: DataFrame, network: Network) -> DataFrame:
    """The documents with a probability of one half or more, with their own columns."""
    plain = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("whole"), F.col("text"))
    return score(plain, network).where("score >= 0.5").select("whole.*")
