"""Encoding into the pieces of a SentencePiece vocabulary, and back, by a max-plus parallel scan.

The encoding of a text is the segmentation with the greatest sum of scores: a Viterbi path, that is a
product of matrices in which max takes the place of plus and plus that of times. Documents longer
than CHUNK characters are cut into chunks that are worked on apart: each gives the matrix of best
scores from every state at its start (characters of a piece begun before) to every state at its end.
A scan over the matrices, associative and in blocks of BLOCK chunks, gives the best score of every
state before each chunk. From these each chunk tells, for every state at its end, by which state at
its start the path to it came in; a scan over these maps, from the end, gives each chunk's two
states, and the chunk is traced back by itself. Shorter documents are one chunk.

Pieces don't depend on the chunks, also where segmentations are equally good: from the end of the text, the
longest last piece of all best ways to a place is taken, and a piece that comes in from before a chunk is
longer than any that ends at the same place and begins in the chunk. Scores are rounded to 2^-20, so that sums
are exact in any order (whole numbers, as in the given vocabulary, stay as they are).

Where no piece goes on after a space, no best path depends on what lies beyond the start of a word.
Words are then segmented once for all their places in a slice, and a chunk's matrix is the sum of
a column, from its start to its first word, and a row, from its last word to its end.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.common import arrow_map
from stoplines.llm.lattice import LITERAL, SPACE, Lattice, Vocabulary
from stoplines.storage import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 16
LETTERS = 1 << 15  # characters in one lattice
SLICE = 1 << 21  # bytes of text whose words are segmented together
BLOCK = 256  # chunks of a document whose matrices or maps one task combines
EXACT = 1 << 20  # scores are multiples of 1 / EXACT


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters as pieces have them: one space before each text that isn't empty, spaces marked."""
    joined = np.frombuffer("".join(f" {text}" if text else "" for text in texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    joined[joined == SPACE] = LITERAL
    joined[joined == 0x20] = SPACE
    return joined, np.array([len(text) + 1 if text else 0 for text in texts])


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.weight = np.round(np.append(vocabulary.scores, vocabulary.fallback) * EXACT) / EXACT

    def _lattice(self, points: np.ndarray, sizes: np.ndarray) -> tuple[Lattice, np.ndarray]:
        lattice = Lattice(self.vocabulary, points, sizes)
        return lattice, lattice.weights(self.weight, 0.0)

    def segment(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, their numbers and the scores of the best paths."""
        if not len(points):
            return np.empty(0, np.int32), np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
        unit, text_of = self._units(points, sizes)
        unit_sizes = np.diff(np.append(unit, len(points)))
        hashes = H.stretch_hashes(points, unit, unit + unit_sizes)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        # Each distinct unit once, a bounded number of characters at a time.
        size = unit_sizes[first]
        ends, parts, at = np.cumsum(size), [], 0
        while at < len(first):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + LETTERS, "right")))
            own = size[at:to]
            place = np.repeat(unit[first[at:to]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            parts.append(self._distinct(points[place], own))
            at = to
        ids, counts, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        begin = np.cumsum(counts) - counts
        per_unit = counts[which]
        take = np.repeat(begin[which] - (np.cumsum(per_unit) - per_unit), per_unit) + np.arange(per_unit.sum())
        n = len(sizes)
        return (
            ids[take], np.bincount(text_of, per_unit, n).astype(np.int64), np.bincount(text_of, scores[which], n),
        )

    def _units(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First places of the units that can be segmented apart, and their texts."""
        ends = np.cumsum(sizes)
        fresh = np.zeros(len(points), bool)
        if self.vocabulary.cut_at_spaces:
            space = points == SPACE
            fresh = space.copy()
            fresh[1:] &= ~space[:-1]
        fresh[(ends - sizes)[sizes > 0]] = True
        unit = np.flatnonzero(fresh)
        return unit, np.searchsorted(ends, unit, "right")

    def _distinct(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lattice, weights = self._lattice(points, sizes)
        scores, length = lattice.best(weights)
        # Back from the ends, all units at once.
        end = lattice.begin + sizes + np.arange(len(sizes))
        at, unit = end.copy(), np.arange(len(sizes))
        owners, places, lengths = [], [], []
        start = lattice.begin + np.arange(len(sizes))
        while len(at):
            back = length[at]
            at = at - back
            owners.append(unit)
            places.append(at - unit)
            lengths.append(back)
            more = at > start[unit]
            at, unit = at[more], unit[more]
        owner, place, back = (np.concatenate(x) for x in (owners, places, lengths))
        order = np.argsort(place, kind="stable")
        owner, place, back = owner[order], place[order], back[order]
        piece = lattice.piece[back - 1, place]
        lone = piece == lattice.none
        width = np.where(lone, lattice.bytes[place], 1)
        begin = np.cumsum(width) - width
        ids = np.empty(width.sum(), np.int32)
        ids[begin[~lone]] = self.vocabulary.ids[piece[~lone]]
        for at, point in zip(begin[lone].tolist(), points[place[lone]].tolist(), strict=True):
            raw = chr(SPACE if point == LITERAL else point).encode("utf-8", "surrogatepass")
            ids[at : at + len(raw)] = self.vocabulary.byte_ids[list(raw)]
        return ids, np.bincount(owner, width, len(sizes)).astype(np.int64), scores

    def transfer(self, points: np.ndarray, size: int) -> np.ndarray:
        """[states, states] of a chunk: `size` characters and as many after it as a piece can reach.

        Entry (s, t): the best score of pieces from character s to character size + t, each of which
        starts within the chunk.
        """
        words = self._words(points, size)
        if not len(words):
            return self._full(points, size)
        first, last = int(words[0]), int(words[-1])
        head = self._full(points[:first], first)[:, 0]
        middle = self.segment(points[first:last], np.array([last - first]))[2][0]
        tail = self._full(points[last:], size - last)[0]
        return head[:, None] + middle + tail[None, :]

    def _words(self, points: np.ndarray, size: int) -> np.ndarray:
        """Places of a chunk at which every path begins a piece, beyond the states at its start."""
        if not self.vocabulary.cut_at_spaces:
            return np.empty(0, np.int64)
        unit, _ = self._units(points[:size], np.array([size]))
        return unit[(unit >= self.vocabulary.longest) & (points[unit] == SPACE)]

    def entering(self, points: np.ndarray, size: int, row: np.ndarray) -> np.ndarray:
        """For every state at the end of a chunk the state at its start on the path to it.

        `row` has the best score of every state at the start, over the text before.
        """
        states = self.vocabulary.longest
        words = self._words(points, size)
        # All paths meet at the first word.
        end = int(words[0]) if len(words) else size
        score = np.full(end + 2 * states + 1, -np.inf)
        length = np.zeros(len(score), np.int64)
        origin = np.zeros(len(score), np.int32)
        score[:states] = row
        length[1:states] = np.where(row[1:] > -np.inf, states + 1, 0)  # a piece from before is the longest
        origin[:states] = np.arange(states)
        own = points[:end] if len(words) else points
        if len(own):
            _, weights = self._lattice(own, np.array([len(own)]))
            for place in range(end):
                if score[place] == -np.inf:
                    continue
                for k in np.flatnonzero(weights[:, place] > -np.inf).tolist():
                    value, at = score[place] + weights[k, place], place + k + 1
                    if value > score[at] or (value == score[at] and k + 1 > length[at]):
                        score[at], length[at], origin[at] = value, k + 1, origin[place]
        return np.full(states, origin[end], np.int32) if len(words) else origin[size : size + states]

    def _full(self, points: np.ndarray, size: int) -> np.ndarray:
        states = self.vocabulary.longest
        out = np.full((size + states + 1, states), -np.inf)
        out[np.arange(states), np.arange(states)] = 0
        if len(points):
            _, weights = self._lattice(points, np.array([len(points)]))
            for place in range(size):
                for k in np.flatnonzero(weights[:, place] > -np.inf).tolist():
                    np.maximum(out[place + k + 1], out[place] + weights[k, place], out=out[place + k + 1])
        return out[size : size + states].T


def combine(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The max-plus product: associative, so that any grouping of a document's chunks is right."""
    return (one[:, :, None] + two[None, :, :]).max(1)


def advance(row: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The best scores of all states after a chunk, from those before it."""
    return combine(row[None, :], matrix)[0]


def folded(values: list[np.ndarray], product: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The product of all values in their order, neighbours first."""
    while len(values) > 1:
        pairs = [product(a, b) for a, b in zip(values[::2], values[1::2], strict=False)]
        values = pairs + values[len(pairs) * 2 :]
    return values[0]


def scan(
    elements: DataFrame, start: np.ndarray, shape: tuple[int, ...],
    product: Callable[[np.ndarray, np.ndarray], np.ndarray], act: Callable[[np.ndarray, np.ndarray], np.ndarray],
    backward: bool = False, block: int = BLOCK,
) -> DataFrame:
    """n, part, state: what `start` has become before each part of n, if every part acts on it in turn.

    `elements` has n, part and value, an array of `shape` as bytes. `product` is associative, and acting
    by a product is acting by its factors. Blocks of parts are combined first, then the products of a
    document's blocks are gone through (a text of 2 GB has 128), then each block's parts.
    """

    def in_order(group: pd.DataFrame, place: str) -> tuple[pd.DataFrame, list[np.ndarray]]:
        group = group.sort_values(place, ascending=not backward)
        return group, [np.frombuffer(x, start.dtype).reshape(shape) for x in group["value"]]

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        group, values = in_order(group, "part")
        return pd.DataFrame({"n": [group["n"].iloc[0]], "block": [group["block"].iloc[0]], "value": [folded(values, product).tobytes()]})

    def states_before(place: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(group: pd.DataFrame) -> pd.DataFrame:
            group, values = in_order(group, place)
            state = np.frombuffer(group["state"].iloc[0], start.dtype) if "state" in group else start
            states = []
            for value in values:
                states.append(state.tobytes())
                state = act(state, value)
            return pd.DataFrame({"n": group["n"], place: group[place], "state": states})

        return run

    parts = elements.withColumn("block", F.floor(F.col("part") / block).cast("int"))
    blocks = parts.groupBy("n", "block").applyInPandas(whole, "n long, block int, value binary")
    starts = blocks.groupBy("n").applyInPandas(states_before("block"), "n long, block int, state binary")
    return parts.join(starts, ["n", "block"]).groupBy("n", "block").applyInPandas(states_before("part"), "n long, part int, state binary")


def encode(docs: DataFrame, path: str = VOCABULARY, chunk: int = CHUNK, check: bool = False) -> DataFrame:
    """`docs` with `pieces`, an array of ids; decode(encode(text)) is the text.

    With `check` also `exact`, whether the pieces decode to the text (an empty one for null).

    Spaces become part of pieces, one more stands before the text; characters without a piece become
    byte pieces. Of equally good segmentations the one with longer pieces at the end is taken, whatever
    `chunk` is. A null or empty text has no pieces. Rows need no ids; columns named like
    the results are replaced.
    """
    vocabulary = Vocabulary.load(path)
    results = ["pieces", "exact"] if check else ["pieces"]
    docs = docs.drop(*results)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"]).alias("row"), "text"
    )
    reach = vocabulary.longest
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, pieces array<int>"
    schema += ", exact boolean" if check else ""

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").fill_null("")
        points, sizes = code_points(texts.to_pylist())
        ids, counts, _ = Encoder(shared.value).segment(points, sizes)
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        pieces = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
        batch = batch.append_column("pieces", pieces)
        return batch.append_column("exact", pc.equal(decoded(pieces, shared.value), texts)) if check else batch

    long = F.length("text") > chunk
    short = arrow_map(rows.where(F.coalesce(~long, F.lit(True))), whole, schema, limit=SLICE)

    giants = materialize(rows.where(long).withColumn("n", F.monotonically_increasing_id()), "giants")
    spread = giants.select("n", "text", F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / chunk).cast("int") - 1)).alias("part"))
    # Each chunk with what a piece can reach beyond it; the first has the space before the text.
    cut = F.substring("text", F.col("part") * chunk + 1, F.lit(chunk + reach)).alias("text")
    chunks = materialize(
        spread.select("n", "part", cut, F.least(F.lit(chunk), F.length("text") - F.col("part") * chunk).alias("size"))
        .repartition("n", "part"), "chunks",
    )

    def points_of(text: str, part: int, size: int) -> tuple[np.ndarray, int]:
        points, _ = code_points([text])
        return (points, size + 1) if part == 0 else (points[1:], size)

    def matrices(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = Encoder(shared.value)
        out = [
            encoder.transfer(*points_of(text, part, size)).tobytes()
            for text, part, size in zip(*(batch.column(c).to_pylist() for c in ("text", "part", "size")), strict=True)
        ]
        return batch.select(["n", "part"]).append_column("value", pa.array(out, pa.binary()))

    def entered(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = Encoder(shared.value)
        columns = (batch.column(c).to_pylist() for c in ("text", "part", "size", "state"))
        out = [
            encoder.entering(*points_of(text, part, size), np.frombuffer(state)).tobytes()
            for text, part, size, state in zip(*columns, strict=True)
        ]
        return batch.select(["n", "part"]).append_column("value", pa.array(out, pa.binary()))

    def traced(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = Encoder(shared.value)
        out = []
        columns = (batch.column(c).to_pylist() for c in ("text", "part", "size", "value", "state"))
        for text, part, size, value, state in zip(*columns, strict=True):
            leave = int(np.frombuffer(state, np.int32)[0])
            enter = int(np.frombuffer(value, np.int32)[leave])
            points, end = points_of(text, part, size)
            out.append(encoder.segment(points[enter : end + leave], np.array([end + leave - enter]))[0])
        return batch.select(["n", "part"]).append_column("ids", pa.array(out, pa.list_(pa.int32())))

    by_chunk = materialize(arrow_map(chunks, matrices, "n long, part int, value binary"), "matrices")
    begin = np.where(np.arange(reach) == 0, 0.0, -np.inf)
    rows_before = scan(by_chunk, begin, (reach, reach), combine, advance)
    maps = materialize(arrow_map(chunks.join(rows_before, ["n", "part"]), entered, "n long, part int, value binary"), "maps")
    # From the end: the state after a chunk is the one that the next chunk's path enters by.
    leaving = scan(maps, np.zeros(1, np.int32), (reach,), lambda later, own: own[later], lambda state, own: own[state], backward=True)
    ids = arrow_map(chunks.join(maps, ["n", "part"]).join(leaving, ["n", "part"]), traced, "n long, part int, ids array<int>")
    pieces = ids.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    pieces = pieces.select("n", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("pieces"))
    long_rows = giants.join(pieces, "n")
    if check:
        long_rows = decode(long_rows, path).withColumn("exact", F.col("decoded") == F.col("text"))
    return short.unionByName(long_rows.select("row", "text", *results)).select("row.*", "text", *results)


def decoded(pieces: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """The texts of the lists of ids; null lists are null."""
    flat, width = vocabulary.spelled
    begin = np.cumsum(width) - width
    ids = pieces.flatten().to_numpy()
    each = width[ids]
    data = flat[np.repeat(begin[ids] - (np.cumsum(each) - each), each) + np.arange(each.sum())].tobytes()
    counts = np.where(pieces.is_valid().to_numpy(zero_copy_only=False), pieces.value_lengths().fill_null(0).to_numpy(), 0)
    ends = np.concatenate(([0], np.cumsum(each)))[np.cumsum(counts)]
    starts = np.concatenate(([0], ends[:-1]))
    texts = [data[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return pa.array(texts, pa.string(), mask=~pieces.is_valid().to_numpy(zero_copy_only=False))


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """`encoded` (any columns, with `pieces`) with `decoded`, the text of the ids; null for null."""
    encoded = encoded.drop("decoded")
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    rows = encoded.select(F.struct(*[F.col(f"`{name}`") for name in encoded.columns]).alias("row"), "pieces")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("row"), decoded(batch.column("pieces"), shared.value)], names=["row", "decoded"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, decoded string"
    return arrow_map(rows, run, schema, None).select("row.*", "decoded")
