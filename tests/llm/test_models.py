"""Classifiers and the language model: held-out accuracy, probabilities by brute force, edge cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stoplines.llm import language, quality, toxicity
from stoplines.llm import hashing as H
from stoplines.llm.common import string_buffer
from stoplines.llm.lattice import Lattice, Vocabulary, Ways
from stoplines.llm.queries import QUERIES
from tests.llm.cases import SCHEMA, documents, frame

DATA = "/root/testdata/sf0.01"


def accuracy(spark, name, label):
    got = QUERIES[name](spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()
    assert held[1] > 50
    return held[0]


def test_quality_of_held_out_documents(spark):
    assert accuracy(spark, "op4_convolutional_quality", "quality") > 0.95


def test_toxicity_of_held_out_documents(spark):
    assert accuracy(spark, "op8_boosted_toxicity", "toxic") > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_odd_rows(spark, module):
    docs = frame(spark)
    for labels in ([(0, 1, 1), (3, 0, 0), (6, None, None), (None, 1, 1), (9, 5, 7)], []):
        known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        model = module.train(docs, known, F.lit(True))
        rows = module.score(docs, model).collect()
        assert len(rows) == len(documents())
        assert all(0 <= row.score <= 1 for row in rows)
    assert module.score(frame(spark, []), model).count() == 0


def test_chunks_cover_long_texts():
    """A filter finds its bytes wherever they stand, across chunks and segments."""
    network = quality.Network()
    network.p["vectors"][:] = 0
    network.p["vectors"][ord("#"), 0] = 1
    network.p["filters"][:] = 0
    network.p["filters"][:: quality.VECTOR + 1, 0] = 1
    for size in (10, 1024, 5000, quality.SEGMENT + 3000):
        for place in {0, size // 2, size - 8, min(size, quality.SEGMENT) - 4}:
            text = bytearray(b"a" * size)
            text[place : place + 8] = b"########"
            raw, offsets = string_buffer(pa.array([bytes(text[:size]), b"", b"b" * 70]))
            most = network.pooled(raw, offsets)[:, 0]
            assert most[0] == min(8, size - place) and most[1] == most[2] == 0


def test_gradients_agree_with_differences():
    network = quality.Network(3)
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 110, n, dtype=np.uint8)) for n in (3000, 40, 0)]
    raw, offsets = string_buffer(pa.array(texts))
    labels = np.array([1.0, 0.0, 1.0], np.float32)
    got = network.gradients(raw, offsets, labels)

    def loss():
        p = np.clip(network.probability(raw, offsets), 1e-9, 1 - 1e-9)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name in ("outer", "inner", "filters", "offset", "vectors"):
        at = np.unravel_index(np.abs(got[name]).argmax(), got[name].shape)
        old, step = network.p[name][at], 3e-4
        network.p[name][at] = old + step
        high = loss()
        network.p[name][at] = old - step
        low = loss()
        network.p[name][at] = old
        assert (high - low) / (2 * step) == pytest.approx(got[name][at], rel=0.2, abs=2e-4)


def test_isotonic_levels():
    rng = np.random.default_rng(1)
    score, y = np.sort(rng.normal(size=200)), (rng.random(200) < np.linspace(0, 1, 200)).astype(float)
    knots, values = toxicity.isotonic(score, y, np.ones(200))
    assert (np.diff(knots) > 0).all() and (np.diff(values) > 0).all()


PIECES = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "c"]


def small_vocabulary():
    scores = -np.linspace(1, 3, len(PIECES))
    return Vocabulary(np.arange(len(PIECES)) + 256, scores, PIECES, np.arange(256))


def ways(text, weights):
    """All segmentations with their weights."""
    if not text:
        yield [], 0.0
    for k in range(1, len(text) + 1):
        if text[:k] in weights:
            for rest, weight in ways(text[k:], weights):
                yield [text[:k], *rest], weight + weights[text[:k]]


def test_lattice_sums_all_segmentations():
    vocabulary = small_vocabulary()
    rng = random.Random(1)
    texts = ["▁" + "".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in range(50)]
    points = np.array([ord(c) for c in "".join(texts)], np.uint32)
    sizes = np.array([len(t) for t in texts])
    lattice = Lattice(vocabulary, points, sizes)
    table = dict(zip(PIECES, vocabulary.scores, strict=True))
    weights = lattice.weights(np.append(vocabulary.scores, -9.0), -1.0)
    _, total = lattice.forward(weights)
    best, _ = lattice.best(weights)
    uses = lattice.expected(weights, np.ones(len(texts)))
    expected = np.zeros(len(PIECES))
    for i, text in enumerate(texts):
        found = list(ways(text, table))
        whole = math.log(sum(math.exp(w) for _, w in found))
        assert total[i] == pytest.approx(whole) and best[i] == pytest.approx(max(w for _, w in found))
        for pieces, weight in found:
            for piece in pieces:
                expected[PIECES.index(piece)] += math.exp(weight - whole)
    assert uses[:-1] == pytest.approx(expected)


def test_ways_of_several_kinds_agree_with_the_lattice():
    vocabulary = small_vocabulary()
    rng = random.Random(3)
    texts = ["▁" + "".join(rng.choice("abcé𐍈") for _ in range(rng.randint(0, 30))) for _ in range(200)] + ["", "▁" + "a" * 900]
    points = np.array([ord(c) for c in "".join(texts)], np.uint32)
    sizes = np.array([len(t) for t in texts])
    tables = np.stack([np.append(vocabulary.scores, -9.0) * factor for factor in (1, 2, 5)])
    kind = np.array([rng.randrange(3) for _ in texts])
    lattice, ways = Lattice(vocabulary, points, sizes), Ways(vocabulary, points, sizes)
    # All kinds at once, one step for each letter of the longest text.
    assert len(ways.steps) == 901
    total = ways.forward(ways.weights(np.ascontiguousarray(tables.T), -1.0))[1]
    number = kind[ways.text] * tables.shape[1] + ways.piece
    uses = np.bincount(number, ways.expected(ways.weights(tables.ravel(), -1.0, number)), minlength=tables.size).reshape(tables.shape)
    for i, table in enumerate(tables):
        weights = lattice.weights(table, -1.0)
        assert (lattice.forward(weights)[1] == total[:, i]).all()
        assert lattice.expected(weights, (kind == i).astype(float)) == pytest.approx(uses[i])


def test_language_stores_no_scores_and_keeps_keys(spark):
    got = language.score(frame(spark, documents(n=30)), F.lit(True), rounds=0, n_kinds=2)
    # Words are scored on their way to the join, from the stored table of counts.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "hash#" not in plan[plan.index("Join LeftOuter"):].split("MapInArrow")[0]
    keys = frame(spark, documents(n=30)).select("doc_id", language.text_key().alias("k"))
    assert sorted(map(str, got.select("doc_id", "k").collect())) == sorted(map(str, keys.collect()))


def test_language_scores(spark):
    rows = documents(n=60)
    train = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) != 0
    got = language.score(frame(spark, rows), train, rounds=2, n_kinds=2).collect()
    assert len(got) == len(rows)
    words = [((i or 0) % 4 != 0, (text or "").encode().lower().split() + [None], i) for i, text, *_ in rows]
    count, n = {}, 0
    for learn, tokens, _ in words:
        for token in tokens if learn else []:
            count[token] = count.get(token, 0) + 1
            n += 1
    base = lambda t: math.log10((count.get(t, 0) + 0.1) / (n + 0.1 * (len(count) + 1)))
    expected = sorted(
        (learn, len(tokens), sum(t in count for t in tokens), round(sum(map(base, tokens)), 6), str(i)) for learn, tokens, i in words
    )
    assert sorted((r.train, r.n_tokens, r.n_known, round(r.base_score, 6), str(r.doc_id)) for r in got) == expected
    assert {r.train_tokens for r in got} == {n}
    assert all(-1e6 < r.score < 0 for r in got)


def test_language_probabilities_sum_below_one(spark):
    """Over all words of the training texts and the end, for one kind of texts."""
    rows = [(i, f"{a} {b}", "en", "s", 1, 0.0, "r") for i, (a, b) in enumerate([("ab", "ba"), ("ab", "cab"), ("x", "ab")] * 5)]
    singles = [(100 + i, w, "en", "s", 1, 0.0, "r") for i, w in enumerate(["ab", "ba", "cab", "x", "new"])] + [(200, "", "en", "s", 0, 0.0, "r")]
    got = language.score(spark.createDataFrame(rows + singles, SCHEMA), F.col("doc_id") < 100, n_kinds=1).where("doc_id >= 100").collect()
    end = next(r.score for r in got if r.doc_id == 200)
    assert sum(10 ** (r.score - end) for r in got if r.doc_id < 200) + 10**end < 1


def test_language_of_no_documents(spark):
    assert language.score(frame(spark, []), F.lit(True)).count() == 0
    only = language.score(frame(spark), F.lit(False)).collect()
    assert len(only) == len(documents()) and all(r.train_tokens == 0 for r in only)


def test_kinds_learn_from_all_training_texts(spark):
    """Words beyond the first 4,000 texts, and of long texts only, have their part in the mixture."""
    rows = [(i, f"w{i % 7} w{i % 5}", "en", "s", 1, 0.0, "r") for i in range(4100)]
    rows += [(5000 + i, "sole " * 7000, "en", "s", 1, 0.0, "r") for i in range(3)]
    kinds = language.Kinds.fit(spark.createDataFrame(rows, SCHEMA).repartition(3).select("text"), 2)
    sole = H.stretch_hashes(np.frombuffer(b"sole", np.uint8), np.array([0]), np.array([4]))
    assert len(kinds.words) == 8 and sole[0] in kinds.words
    at = int(np.searchsorted(kinds.words, sole[0]))
    shares = np.exp(kinds.logs[:, at])
    assert shares.max() > 0.99 and shares.min() < 0.01
    assert np.exp(kinds.prior).min() == pytest.approx(4 / 4105)
