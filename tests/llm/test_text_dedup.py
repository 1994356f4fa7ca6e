"""Removal of repeats and near-duplicates against plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stoplines.llm import language, minhash, passages, repeats
from stoplines.llm.common import components
from stoplines.llm.suffix_sort import suffixes
from tests.llm.cases import SCHEMA, documents, frame, groups, order


def as_rows(df, *names):
    return Counter(tuple(row[name] for name in names) for row in df.collect())


def kept_words(rows, window):
    first = {}
    split = [(order(i), (text or "").encode().split()) for i, text, *_ in rows]
    for i, words in split:
        for j in range(len(words) - window + 1):
            key = tuple(words[j : j + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for (i, text, *_), (own, words) in zip(rows, split, strict=True):
        gone = set()
        for j in range(len(words) - window + 1):
            if first[tuple(words[j : j + window])] < own:
                gone.update(range(j, j + window))
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone).decode()
        out[(i, text, len(words), len(gone), kept)] += 1
    return out


@pytest.mark.parametrize("window", [4, 13])
def test_super_kmers(spark, window):
    rows = documents()
    found = repeats.remove_repeats(frame(spark, rows), window)
    assert as_rows(found, "doc_id", "text", "n_words", "n_removed", "kept") == kept_words(rows, window)
    assert found.columns[:2] == ["doc_id", "lang"] and "row" in found.columns


def kept_bytes(rows, window):
    texts = [(text or "").encode() for _, text, *_ in rows]
    count = Counter(text[j : j + window] for text in texts for j in range(len(text) - window + 1))
    out = Counter()
    for (i, text, *_), raw in zip(rows, texts, strict=True):
        gone = np.zeros(len(raw) + 1, bool)
        for j in range(len(raw) - window + 1):
            if count[raw[j : j + window]] > 1:
                gone[j : j + window] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[(i, text, len(raw), int(gone.sum()), spans, bytes(b for b, g in zip(raw, gone) if not g))] += 1
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_induced_sorting(spark, hot):
    rows = documents()
    window = 40
    # Short stretches and a low bound on hot ones, so that every branch is taken.
    passages_of = passages.repeated_stretches
    found = passages_of(frame(spark, rows), window, 8, hot)
    assert found.columns == ["id", "k", "start", "end"]
    kept = passages.remove_repeats(frame(spark, rows), window, 8, hot)
    got = Counter((r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in kept.collect())
    assert got == kept_bytes(rows, window)


def test_suffixes_of_random_texts():
    rng = np.random.default_rng(0)
    for _ in range(60):
        parts = [np.append(rng.integers(1, rng.integers(2, 5), rng.integers(1, 40)), 0) for _ in range(rng.integers(1, 5))]
        text, depth = np.concatenate(parts).astype(np.int16), int(rng.integers(1, 30))
        for memory in (0, 1 << 20):
            places = np.concatenate(list(suffixes(text, depth, memory)))
            keys = [tuple(text[p : p + depth].tolist()) for p in places]
            assert sorted(places.tolist()) == list(range(len(text))) and keys == sorted(keys)


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


@pytest.mark.parametrize(("size", "similarity", "rounds", "block"), [(3, 85, 2, 512), (3, 60, 0, 4), (5, 80, 1, 512)])
def test_minhash(spark, size, similarity, rounds, block):
    rows = [row for row in documents() if row[0] is not None]
    sets = [shingles(text, size) for _, text, *_ in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
    ]
    root = groups(links, range(len(rows)))
    least = defaultdict(lambda: float("inf"))
    for i, r in root.items():
        least[r] = min(least[r], rows[i][0])
    expected = Counter((rows[i][0], len(sets[i]), least[root[i]]) for i in range(len(rows)))
    found = minhash.near_duplicates(frame(spark, rows), size, similarity, rounds=rounds, short=2, block=block)
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == expected


def test_minhash_null_ids(spark):
    found = minhash.near_duplicates(frame(spark)).collect()
    assert len(found) == len(documents())
    assert all(row.component_id is not None for row in found if row.doc_id is not None)


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text), (3, text + " more"), (9, "other words here"), (4, None), (5, ""), (3, text + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 0.0, "r") for i, t in rows], SCHEMA)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == [3, 4, 5, 9]


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(50, 60), (60, 55), (70, 70)]
    got = {row.node: row.component for row in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    links = [(a, b) for a, b in pairs if a != b]
    expected = groups(links, {x for pair in links for x in pair})
    assert got == expected


@pytest.mark.parametrize("operator", [repeats.remove_repeats, passages.remove_repeats, minhash.near_duplicates, minhash.drop_near_duplicates])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def test_texts_with_one_32_bit_hash(spark):
    """Different texts under one null id stay apart though Spark's hash gives both the same number."""
    one, two = (" ".join(f"w{i * 20 + j}" for j in range(20)) for i in (2033, 116493))
    texts = spark.createDataFrame([(one,), (two,)], "text string")
    assert texts.select(F.hash("text")).distinct().count() == 1
    docs = frame(spark, [(i, text, "en", "s", len(text), 0.0, "r") for i, text in [(1, one), (None, one), (None, two)]])
    assert {row.text for row in minhash.drop_near_duplicates(docs.where("doc_id is null")).collect()} == {one, two}
    assert as_rows(repeats.remove_repeats(docs), "doc_id", "text", "n_removed") == Counter([(1, one, 0), (None, one, 20), (None, two, 0)])
    removed = as_rows(passages.remove_repeats(docs, 40, 8), "doc_id", "text", "n_removed")
    assert removed == Counter([(1, one, len(one)), (None, one, len(one)), (None, two, 0)])
    scored = language.score(docs, F.col("doc_id") == 1, rounds=0, n_kinds=1).where("doc_id is null").collect()
    assert sorted((row.n_tokens, row.n_known) for row in scored) == [(21, 1), (21, 21)]
