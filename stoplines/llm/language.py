"""Language-model scores of whole texts: the marginal likelihood of subword lattices.

A text is its words, lower-cased in A-Z, and an end. A word's probability is the sum over all ways
to segment it into pieces of an existing vocabulary, by a forward recursion in log space; the
pieces' probabilities start from the vocabulary's scores and are re-estimated by expectation
maximisation over the distinct words of all training documents. Only the weights are fitted, the
pieces stay.

Texts are of several kinds (languages, say): a mixture over the most frequent words, fitted by
expectation maximisation on all training texts, each of which is counted once for those words; a round
is one aggregation. A text's probability is the sum over the kinds. A word of the training texts has one more way through its lattice, the word as a whole,
by its count less a discount in texts of the kind and then of all kinds; what the discounts leave is
the weight of the piecewise ways.

Each distinct word is scored once. Words are counted over all documents; the most frequent, at most
FREQUENT of them by their share of all tokens, are sent to every task, and a text's other words meet
their scores in a join, counted per document before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.common import arrow_map, string_buffer, text_key
from stoplines.llm.lattice import LITERAL, SPACE, Vocabulary, Ways
from stoplines.storage import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 1 << 18
ROUNDS = 4
KINDS = 6
KIND_WORDS = 2048
KIND_COMMON = 200
KIND_TRIES = 8
KIND_STEPS = 10  # of the spherical k-means that the kinds start from
KIND_ROUNDS = 20
KIND_ROWS = 1024  # texts in one dense table
END = b" "
WORDS = 20_000  # words in one lattice
LETTERS = 1 << 18  # and letters
LAST = np.iinfo(np.int64).max
SMOOTHING = 0.1
PER_BYTE = -float(np.log(256))
MARK = chr(SPACE).encode()


def _ways(words: list[bytes], vocabulary: Vocabulary) -> Iterator[tuple[slice, Ways]]:
    """The ways through the words, each with a space before, a bounded number of words and letters at a time."""
    ends = np.cumsum([len(word) for word in words])
    at = 0
    while at < len(words):
        base = ends[at - 1] if at else 0
        stop = min(at + WORDS, max(at + 1, int(np.searchsorted(ends, base + LETTERS, "right"))))
        some = words[at:stop]
        spelled = MARK + MARK.join(some)
        points = np.frombuffer(spelled.decode().encode("utf-32-le"), np.uint32).copy()
        # Letters are the bytes that go on with none.
        begins = (np.frombuffer(spelled, np.uint8) & 0xC0) != 0x80
        before = ends[at:stop] - base + len(MARK) * np.arange(1, len(some) + 1)
        sizes = np.add.reduceat(begins, np.append(0, before[:-1]), dtype=np.int64)
        points[points == SPACE] = LITERAL
        points[np.cumsum(sizes) - sizes] = SPACE
        yield slice(at, stop), Ways(vocabulary, points, sizes)
        at = stop


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


def _start(vocabulary: Vocabulary) -> np.ndarray:
    """Log weights of the pieces and the fallback: the scores, or by Zipf's law where they are ranks."""
    scores = vocabulary.scores
    if len(scores) and (scores == np.round(scores)).all():
        scores = -np.log(10 + np.argsort(np.argsort(-scores, kind="stable"), kind="stable"))
    weights = np.append(scores, scores.min(initial=0.0) - 1)
    return weights - np.logaddexp.reduce(weights)


def _tokens_of(texts: pa.Array):
    """Lower-cased bytes, starts and ends of words, their texts, their hashes."""
    raw, offsets = string_buffer(texts)
    raw = H.lower_ascii(raw)
    starts, ends, places = H.words(raw, offsets, H.NOT_SPACE)
    doc = np.repeat(np.arange(len(texts)), np.diff(places))
    return raw, starts, ends, doc, H.stretch_hashes(raw, starts, ends)


def _equal(hashes: np.ndarray, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal hashes (of the same document) lie together, and which of them are the first ones."""
    order = np.argsort(hashes)
    if doc is not None and len(doc):
        # Two bytes are sorted faster.
        order = order[np.argsort(doc[order].astype(np.uint16 if doc[-1] < 1 << 16 else np.int64), kind="stable")]
    cut = np.ones(len(order), bool)
    cut[1:] = hashes[order][1:] != hashes[order][:-1]
    if doc is not None:
        cut[1:] |= doc[order][1:] != doc[order][:-1]
    return order, cut


def _spelled(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    text = raw.tobytes()
    return pa.array([text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())


def _frequent(texts: DataFrame, most: int) -> np.ndarray:
    """Hashes of the most frequent words of all texts, most frequent first."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, n = np.unique(_tokens_of(batch.column("text"))[4], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

    counts = arrow_map(texts, counted, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), "hash").limit(most).select("hash").toArrow().column("hash").to_numpy().view(np.uint64)


def _columns(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes among the sorted words, len(words) for other words."""
    if not len(words):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at, len(words))


def _vectors(batch: pa.RecordBatch, words: np.ndarray) -> pa.RecordBatch:
    """The texts of the batch as one row: how many columns each has, the columns and their counts, compressed."""
    n, width = batch.num_rows, len(words) + 1
    _, _, _, doc, hashes = _tokens_of(batch.column("text"))
    key, count = np.unique(doc * width + _columns(words, hashes), return_counts=True)
    lengths = np.bincount(key // width, minlength=n).astype("<u2")
    parts = [lengths, (key % width).astype("<u2"), count.astype("<u4")]
    codec = pa.Codec("zstd", compression_level=3)
    blobs = [pa.array([codec.compress(part.tobytes(), asbytes=True)], pa.binary()) for part in parts]
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([len(key)], pa.int32()), *blobs], names=["texts", "cells", "lengths", "columns", "counts"])


def _tables(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """[texts, width]: word counts of at most KIND_ROWS texts at a time."""
    codec = pa.Codec("zstd")
    for batch in batches:
        for n, cells, *blobs in zip(*(batch.column(name).to_pylist() for name in ("texts", "cells", "lengths", "columns", "counts")), strict=True):
            lengths, columns, counts = (
                np.frombuffer(codec.decompress(blob, size * int(kind[-1]), asbytes=True), kind)
                for blob, size, kind in zip(blobs, (n, cells, cells), ("<u2", "<u2", "<u4"), strict=True)
            )
            edges = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
            for at in range(0, n, KIND_ROWS):
                to = min(at + KIND_ROWS, n)
                some = slice(edges[at], edges[to])
                table = np.zeros((to - at, width), np.float32)
                table[np.repeat(np.arange(to - at), lengths[at:to]), columns[some]] = counts[some]
                yield table


def _units(table: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors over the most common words, and which texts have enough of them."""
    unit = np.sqrt(table[:, common])
    full = (unit**2).sum(1) >= KIND_COMMON / 10
    return unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9), full


def _shares(each: np.ndarray) -> np.ndarray:
    part = np.exp(each - each.max(1, keepdims=True))
    return part / part.sum(1, keepdims=True)


def _totals(vectors: DataFrame, width: int, size: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all texts of what `add` gives for a table of them, an array of `size`."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for table in _tables(batches, width):
            sums += add(table)
        cell = np.flatnonzero(sums)
        if len(cell):
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(sums[cell])], names=["cell", "mass"])

    rows = vectors.mapInArrow(summed, "cell int, mass double").groupBy("cell").agg(F.sum("mass").alias("mass")).toArrow()
    out = np.zeros(size)
    out[rows.column("cell").to_numpy()] = rows.column("mass").to_numpy()
    return out


def _first_centres(vectors: DataFrame, width: int, common: np.ndarray, kinds: int, seed: int) -> tuple[np.ndarray, bool]:
    """[tries, kinds, common]: texts to start from, by a hash of their counts, and whether only texts with enough common words count."""
    most = kinds * KIND_TRIES
    factors = H.mix(np.arange(1, len(common) + 1, dtype=np.uint64)) | np.uint64(1)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bool, dict[int, bytes]] = {True: {}, False: {}}
        for table in _tables(batches, width):
            unit, full = _units(table, common)
            turn = H.mix((table[:, common].astype(np.uint64) * factors).sum(1, dtype=np.uint64)).view(np.int64)
            for value, own in best.items():
                at = np.flatnonzero(full == value)
                at = at[np.unique(turn[at], return_index=True)[1][:most]]
                own.update((int(turn[i]), unit[i].tobytes()) for i in at)
                best[value] = dict(sorted(own.items())[:most])
        rows = [(value, turn, unit) for value, own in best.items() for turn, unit in own.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["full", "turn", "unit"])

    rows = vectors.mapInArrow(first, "full boolean, turn long, unit binary").dropDuplicates(["full", "turn"])
    found = {value: rows.where(F.col("full") == value).orderBy("turn").limit(most).collect() for value in (True, False)}
    full = len(found[True]) >= kinds
    use = found[True] if full else found[True] + found[False]
    units = np.stack([np.frombuffer(row.unit, np.float32) for row in use])
    rng = np.random.default_rng(seed)
    if len(units) >= most:
        return units[rng.permutation(len(units))[:most]].reshape(KIND_TRIES, kinds, -1), full
    return np.stack([units[rng.choice(len(units), min(kinds, len(units)), replace=False)] for _ in range(KIND_TRIES)]), full


@dataclass
class Kinds:
    """A mixture of word distributions over the most frequent words of the training texts: the kind of each text."""

    words: np.ndarray  # hashes, sorted
    logs: np.ndarray  # [kinds, words + 1], other words last
    prior: np.ndarray

    def of(self, doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        at = _columns(self.words, hashes)
        return np.stack([prior + np.bincount(doc, logs[at], n) for prior, logs in zip(self.prior, self.logs, strict=True)]).argmax(0)

    @classmethod
    def fit(cls, texts: DataFrame, kinds: int, rounds: int = KIND_ROUNDS, seed: int = 1) -> Kinds:
        """By expectation maximisation over all texts, one aggregation a round; only word distributions reach the driver."""
        frequent = _frequent(texts, KIND_WORDS)
        words, width = np.sort(frequent), len(frequent) + 1
        if not len(words):
            return cls(words, np.zeros((1, 1)), np.zeros(1))
        common = np.sort(np.searchsorted(words, frequent[:KIND_COMMON]))
        vectors = materialize(
            arrow_map(texts, lambda batch: _vectors(batch, words), "texts int, cells int, lengths binary, columns binary, counts binary"),
            "vectors",
        )
        # Starts: the best of some spherical k-means over the most common of these words, where a text has enough of them.
        centres, only = _first_centres(vectors, width, common, kinds, seed)
        tries, k, m = centres.shape

        def nearest(table: np.ndarray) -> np.ndarray:
            unit, full = _units(table, common)
            unit = unit[full] if only else unit
            near = (unit @ centres.reshape(-1, m).T).reshape(-1, tries, k)
            own = (near.argmax(2)[:, :, None] == np.arange(k)).reshape(-1, tries * k).astype(np.float32)
            return np.concatenate((near.max(2).sum(0), (own.T @ unit).ravel()))

        for step in range(KIND_STEPS + 1):
            sums = _totals(vectors, width, tries + tries * k * m, nearest)
            best = int(sums[:tries].argmax())
            sums = sums[tries:].reshape(centres.shape)
            size = np.linalg.norm(sums, axis=2, keepdims=True)
            moved = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres).astype(np.float32)
            if step == KIND_STEPS or np.allclose(moved, centres, rtol=0, atol=1e-6):
                break
            centres = moved
        chosen = centres[best]
        logs = prior = None

        def expected(table: np.ndarray) -> np.ndarray:
            each = 30 * (_units(table, common)[0] @ chosen.T) if logs is None else prior + table @ logs.T
            part = _shares(each.astype(np.float64))
            return np.concatenate((part.sum(0), (part.T.astype(np.float32) @ table).ravel()))

        for _ in range(rounds):
            sums = _totals(vectors, width, k + k * width, expected)
            prior = np.log((sums[:k] + 1) / (sums[:k].sum() + k))
            mass = sums[k:].reshape(k, width) + 0.1
            logs = np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)
        return cls(words, logs.astype(np.float64), prior)


def _counted(batch: pa.RecordBatch, kinds: Kinds) -> pa.RecordBatch:
    raw, starts, ends, doc, hashes = _tokens_of(batch.column("text"))
    train = batch.column("train").to_numpy(zero_copy_only=False)
    k = len(kinds.prior)
    kind = kinds.of(doc, hashes, batch.num_rows)
    order, cut = _equal(hashes)
    first, of = order[cut], doc[order]
    counts = np.bincount((np.cumsum(cut) - 1) * k + kind[of], train[of].astype(float), len(first) * k).astype(np.int64).reshape(-1, k)
    # The ends, under the name that no word has.
    lasts = np.bincount(kind, train.astype(float), k).astype(np.int64)
    counts = np.concatenate((counts, lasts[None, :]))
    word = pa.concat_arrays([_spelled(raw, starts[first], ends[first]), pa.array([END], pa.binary())])
    return pa.RecordBatch.from_arrays([word, *(pa.array(counts[:, i]) for i in range(k))], names=["word", *(f"n{i}" for i in range(k))])


def word_counts(docs: DataFrame, train: Column, kinds: Kinds) -> DataFrame:
    """word (bytes), n0, n1, ...: every distinct word of all texts and its number in training texts of each kind, 0 included.

    The word b" " stands for the end.
    """
    names = [f"n{i}" for i in range(len(kinds.prior))]
    shared = docs.sparkSession.sparkContext.broadcast(kinds)
    schema = "word binary, " + ", ".join(f"{name} long" for name in names)
    rows = arrow_map(docs.select("text", train.alias("train")), lambda batch: _counted(batch, shared.value), schema)
    return rows.groupBy("word").agg(*[F.sum(name).alias(name) for name in names])


def _expected(words: list[bytes], kind: np.ndarray, vocabulary: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """[kinds, pieces + 1]: expected uses in the words, each of which is of one kind."""
    table = weights.ravel()
    uses = np.zeros(table.size)
    for part, ways in _ways(words, vocabulary):
        number = kind[part][ways.text] * weights.shape[1] + ways.piece
        uses += np.bincount(number, ways.expected(ways.weights(table, PER_BYTE, number)), minlength=table.size)
    return uses.reshape(weights.shape)


def fit(counts: DataFrame, vocabulary: Vocabulary, kinds: int, rounds: int = ROUNDS) -> np.ndarray:
    """[kinds, pieces + 1]: log probabilities of the pieces and the fallback, from each distinct training word of a kind once.

    Each of `rounds` + 1 rounds goes over all words of all training texts.
    """
    sc = counts.sparkSession.sparkContext
    shared = sc.broadcast(vocabulary)
    weights = np.tile(_start(vocabulary), (kinds, 1))
    for _ in range(rounds + 1):
        now = sc.broadcast(weights)

        def expected(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            uses = np.zeros(now.value.shape)
            for batch in batches:
                # A word of several kinds comes once for each.
                own = [batch.column("word").filter(pc.greater(batch.column(f"n{kind}"), 0)) for kind in range(len(uses))]
                kind = np.repeat(np.arange(len(own)), [len(words) for words in own])
                uses += _expected(pa.concat_arrays(own).to_pylist(), kind, shared.value, now.value)
            kind, piece = np.nonzero(uses)
            if len(kind):
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(piece, pa.int32()), pa.array(uses[kind, piece])], names=["kind", "piece", "uses"])

        # One row for each piece and kind: bounded by the vocabulary.
        rows = (
            counts.where("n > 0").mapInArrow(expected, "kind int, piece int, uses double")
            .groupBy("kind", "piece").agg(F.sum("uses").alias("uses")).toArrow()
        )
        uses = np.full(weights.shape, SMOOTHING / 10)
        uses[rows.column("kind").to_numpy(), rows.column("piece").to_numpy()] += rows.column("uses").to_numpy()
        weights = np.log(uses / uses.sum(1, keepdims=True))
        now.destroy()
    return weights


def score(docs: DataFrame, train: Column, path: str = VOCABULARY, rounds: int = ROUNDS, n_kinds: int = KINDS) -> DataFrame:
    """doc_id, k, train, n_tokens, n_known, train_tokens, base_score, score; one row per document.

    `train` marks the documents to learn from. score is the model's log10 probability of the whole
    text, base_score that of a word unigram model smoothed by 0.1. Words are runs of anything but
    space and the controls 09-0D; the end is a token. Null and empty texts have the end only. k is a
    hash of 128 bits of the text; null ids stay null; rows with one text are scored alike, up to the order of sums.
    """
    vocabulary = Vocabulary.load(path)
    sc = docs.sparkSession.sparkContext
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), text_key().alias("k"), "text",
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    kinds = Kinds.fit(rows.where("train").select("text"), n_kinds)
    range_ = range(len(kinds.prior))
    every = sum(F.col(f"n{i}") for i in range_)
    counts = materialize(word_counts(rows, F.col("train"), kinds).withColumn("n", every), "words")
    is_end = F.col("word") == F.lit(END)
    sums = counts.agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v"),
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range_], *[F.count_if(F.col(f"n{i}") > 0).alias(f"v{i}") for i in range_],
        F.sum(F.when(is_end, F.col("n"))).alias("texts"), *[F.sum(F.when(is_end, F.col(f"n{i}"))).alias(f"texts{i}") for i in range_],
    ).first()
    total, distinct, texts = sums.n or 0, sums.v or 0, sums.texts or 0
    weights = fit(counts.where(~is_end), vocabulary, len(kinds.prior), rounds)
    discount = sums.once / (sums.once + 2 * sums.twice) if sums.once and sums.twice else 0.5
    tokens = np.array([sums[f"n{i}"] or 0 for i in range_]) + SMOOTHING
    spare = (discount * np.array([sums[f"v{i}"] or 0 for i in range_]) + SMOOTHING) / tokens
    spare_all = (discount * distinct + SMOOTHING) / (total + SMOOTHING)
    # The end is never discounted; a kind's weight is its share of training texts.
    ends_of = np.array([sums[f"texts{i}"] or 0 for i in range_]) + SMOOTHING
    end = np.log10(ends_of / (tokens + SMOOTHING)) + np.log10(ends_of / ends_of.sum())
    shared, fitted = sc.broadcast(vocabulary), sc.broadcast(weights)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column("word").to_pylist()
        table = np.ascontiguousarray(fitted.value.T)
        p = np.empty((len(kinds.prior), len(words)))
        for part, ways in _ways(words, shared.value):
            p[:, part] = ways.forward(ways.weights(table, PER_BYTE))[1].T

        def whole(name: str, over: float) -> np.ndarray:
            return np.maximum(batch.column(name).to_numpy() - discount, 0) / over

        p = np.logaddexp(_log(whole("n", total + SMOOTHING)), p + np.log(spare_all))
        each = [np.logaddexp(_log(whole(f"n{i}", tokens[i])), p[i] + np.log(spare[i])) / np.log(10) for i in range_]
        raw, offsets = string_buffer(batch.column("word"))
        hashes = H.stretch_hashes(raw, offsets[:-1], offsets[1:]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array(hashes), *(pa.array(x) for x in each)],
            names=["word", "n", "hash", *p_names],
        )

    p_names = [f"p{i}" for i in range_]

    def scores(words: DataFrame) -> DataFrame:
        return arrow_map(words, scored, "word binary, n long, hash long, " + ", ".join(f"{name} double" for name in p_names), None)

    # Fewer than FREQUENT words can have more than that part of all tokens. The others are scored on their way to the join.
    frequent = F.col("n") > F.lit(total / FREQUENT)
    top = scores(counts.where(~is_end & frequent)).select("hash", "n", *p_names).toArrow().sort_by("hash")
    top = sc.broadcast([top.column(name).to_numpy() for name in ("hash", "n", *p_names)])
    norm = float(np.log10(total + SMOOTHING * (distinct + 1)))

    def summed(batch: pa.RecordBatch) -> pa.RecordBatch:
        """One row per document with the sums over frequent words, one per document and other word."""
        raw, starts, ends, doc, hashes = _tokens_of(batch.column("text"))
        n = batch.num_rows
        known, count, *p = top.value
        at = np.minimum(np.searchsorted(known, hashes.view(np.int64)), max(0, len(known) - 1))
        here = known[at] == hashes.view(np.int64) if len(known) else np.zeros(len(hashes), bool)
        at, owner = at[here], doc[here]
        base = np.bincount(owner, np.log10(count[at] + SMOOTHING) - norm, n) + np.log10(texts + SMOOTHING) - norm
        model = [np.bincount(owner, x[at], n) + last for x, last in zip(p, end, strict=True)]
        n_known = np.bincount(owner, minlength=n) + (texts > 0)
        rest = np.flatnonzero(~here)
        order, cut = _equal(hashes[rest], doc[rest])
        order, first = rest[order], np.flatnonzero(cut)
        times = np.diff(np.append(first, len(order)))
        some = order[first]
        number = batch.column("number").to_numpy()
        # A space begins no word, so that these rows meet no other; each has a key of its own.
        word = pa.concat_arrays([pa.array([b" %d" % i for i in number.tolist()], pa.binary()), _spelled(raw, starts[some], ends[some])])
        k = np.ascontiguousarray(string_buffer(batch.column("k"))[0]).view(">i8").astype(np.int64).reshape(-1, 2)
        own = pa.StructArray.from_arrays(
            [
                batch.column("id"), pa.array(k[:, 0]), pa.array(k[:, 1]), batch.column("train"),
                pa.array(np.bincount(doc, minlength=n) + 1), pa.array(n_known), pa.array(base), *(pa.array(x) for x in model),
            ],
            names=own_names,
        )
        return pa.RecordBatch.from_arrays(
            [
                word, pa.array(np.concatenate((number, number[doc[some]]))),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(times)]), pa.concat_arrays([own, pa.nulls(len(some), own.type)]),
            ],
            names=["word", "number", "times", "own"],
        )

    m_names = [f"m{i}" for i in range_]
    own_names = ["id", "k1", "k2", "train", "tokens", "known", "base", *m_names]
    types = ["long", "long", "long", "boolean", "long", "long", "double", *["double"] * len(m_names)]
    schema = f"word binary, number long, times long, own struct<{', '.join(f'{n}: {t}' for n, t in zip(own_names, types, strict=True))}>"
    # A row is known by its number in the scan from here on: half as long as its key, and far shorter when compressed.
    parts = arrow_map(rows.withColumn("number", F.monotonically_increasing_id()), summed, schema)
    others = scores(counts.where(~is_end & ~frequent)).select("word", "n", *p_names)
    counted = F.coalesce("n", F.lit(0))
    # Scores take far more room than the table of counts that the planner knows, hence the hint.
    per_document = parts.join(others.hint("merge"), "word", "left").groupBy("number").agg(
        *[F.first(f"own.{name}", ignorenulls=True).alias(name) for name in own_names[:5]],
        F.sum(F.coalesce("own.known", F.when(counted > 0, F.col("times")).otherwise(0))).alias("n_known"),
        F.sum(F.coalesce("own.base", F.col("times") * (F.log10(counted + SMOOTHING) - norm))).alias("base_score"),
        *[F.sum(F.coalesce(f"own.{m}", F.col("times") * F.col(p))).alias(m) for m, p in zip(m_names, p_names, strict=True)],
    )
    most = F.greatest(*m_names) if len(m_names) > 1 else F.col("m0")
    marginal = most + F.log10(sum(F.pow(F.lit(10.0), F.col(m) - most) for m in m_names))
    key = F.unhex(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in ("k1", "k2")]))
    return per_document.select(
        F.nullif("id", F.lit(LAST)).alias("doc_id"), key.alias("k"), "train", F.col("tokens").alias("n_tokens"), "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", marginal.alias("score"),
    )
