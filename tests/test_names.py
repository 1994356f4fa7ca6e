"""Name resolution against plain edit distance over the whole dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from stoplines.operators import names, similarity
from stoplines.operators.dims import station_dictionary

WORDS = ["alexanderplatz", "hauptbahnhof", "spandau", "südkreuz", "westend", "wedding", "steglitz"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + row
        for j, y in enumerate(b, 1):
            row[j] = min(row[j - 1] + 1, row[j + 1] + 1, row[j] + (x != y))
        row = row[: len(b) + 1]
    return row[-1]


def best(norm, entries):
    return min((distance(norm, e) / max(len(norm), len(e), 1), e) for e in entries)[1]


def dictionary(spark, entries):
    return spark.createDataFrame([(e, i) for i, e in enumerate(entries)], "name string, eva long")


def messy_names(count):
    rng = random.Random(5)
    found = set()
    while len(found) < count:
        letters = list(rng.choice(WORDS))
        for _ in range(rng.randint(0, 5)):
            letters[rng.randrange(len(letters))] = rng.choice("aehnrst ")
        found.add("".join(letters).strip() or "x")
    return sorted(found)


@pytest.mark.parametrize(("rounds", "slice_entries", "broadcast_entries"), [
    (similarity.ROUNDS, 2000, 200_000), (((2, 2), (2, 3)), 2, 3), ((), 2, 200_000), ((), 2, 3),
])
def test_same_best_match_for_any_rounds_and_slices(spark, monkeypatch, rounds, slice_entries, broadcast_entries):
    monkeypatch.setattr(similarity, "ROUNDS", rounds)
    monkeypatch.setattr(similarity, "DIRECT_PAIRS", 0)
    monkeypatch.setattr(similarity, "SLICE_ENTRIES", slice_entries)
    monkeypatch.setattr(similarity, "BROADCAST_ENTRIES", broadcast_entries)
    monkeypatch.setattr(similarity, "TEXTS_PER_COPY", 10)
    messy = messy_names(60) + ["zzzz", "aaaaaaaaaaaaaaaa", "alexanderplatzalexanderplatz"]
    df = spark.createDataFrame([(n,) for n in messy], "name string")
    resolved = names.fuzzy_resolve(df, dictionary(spark, WORDS)).collect()
    assert {r.name: r.match for r in resolved} == {n: best(n, WORDS) for n in messy}
    assert all(WORDS[r.eva] == r.match and 0 <= r.score <= 1 for r in resolved)


def test_every_pair_within_a_bound_is_found(spark):
    """Pairs within each bound, by plain distance, are all among those that a round compares."""
    rng = random.Random(2)
    texts = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(90)})
    entries = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(90)})
    frames = [spark.createDataFrame([(t,) for t in some], "text string") for some in (texts, entries)]
    for q, eighths in ((2, 1), (2, 2), (2, 3), (3, 1), (3, 2)):
        rows = [similarity._gram_rows(frame, q) for frame in frames]
        often = rows[1].groupBy("gram", "nth").agg(F.count("*").alias("times"))
        ranked = [similarity._ranked(one, often, q, eighths, "grams") for one in rows]
        pairs = [tuple(r) for r in similarity.pairs_within(*ranked, q, eighths).collect()]
        within = {(t, e) for t in texts for e in entries if 8 * distance(t, e) <= eighths * max(len(t), len(e))}
        assert within <= set(pairs) and len(pairs) == len(set(pairs)) and within


def test_few_distances_for_many_names(spark, monkeypatch):
    """Of 10,000 names and as many entries, each name is compared with a small share of the entries."""
    rng = random.Random(3)
    entries = sorted({" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(2))
                      for _ in range(10_000)})
    messy = []
    for entry in entries:
        letters = list(entry)
        for _ in range(rng.randint(1, 2)):
            letters[rng.randrange(len(letters))] = rng.choice("xyz")
        messy.append("".join(letters).strip())
    compared, scanned = [], []
    one, rest = similarity._distances, similarity._among_all
    monkeypatch.setattr(similarity, "_distances", lambda pairs: compared.append(pairs.count()) or one(pairs))
    monkeypatch.setattr(similarity, "_among_all", lambda texts, names: scanned.append(texts.count()) or rest(texts, names))
    df = spark.createDataFrame([(m,) for m in messy], "text string")
    found = similarity.most_similar(df, dictionary(spark, entries)).collect()
    assert len(found) == len(set(messy))
    calculated = sum(compared) + sum(scanned) * len(entries)
    assert calculated < len(set(messy)) * len(entries) / 100
    own = dict(zip(messy, entries, strict=True))
    better = [r for r in found if r.name != own[r.text]]
    assert all(1 - r.score <= distance(r.text, own[r.text]) / max(len(r.text), len(own[r.text])) for r in better)


def test_nothing_to_compare(spark):
    some, none = spark.createDataFrame([("a",), (None,), ("a",)], "text string"), spark.createDataFrame([], "text string")
    assert similarity.most_similar(none, dictionary(spark, WORDS)).count() == 0
    assert similarity.most_similar(some, dictionary(spark, [])).count() == 0
    assert [tuple(r) for r in similarity.most_similar(some, dictionary(spark, ["b", "c"])).collect()] == [("a", "b", 0.0)]


def test_ties_go_to_the_smaller_name(spark):
    df = spark.createDataFrame([("abx",)], "name string")
    assert names.fuzzy_resolve(df, dictionary(spark, ["abz", "aby"])).first().match == "aby"


def test_minimum_score_leaves_names_open(spark):
    df = spark.createDataFrame([("Alexanderplaz",), ("zzz",), ("Alexanderplaz",)], "name string")
    resolved = names.fuzzy_resolve(df, dictionary(spark, WORDS), min_score=0.8).collect()
    assert {r.name: r.eva for r in resolved} == {"Alexanderplaz": 0, "zzz": None}


def test_alias_wins(spark):
    stations = spark.createDataFrame(
        [("spandau", 5), ("spandau", 3), ("yorckstra_e__gro_g_rschenstra_e_", 1)],
        "station_name string, station_eva long",
    )
    found = {r.name: r.eva for r in station_dictionary(stations).collect()}
    assert found == {"spandau": 3, "yorckstra_e__gro_g_rschenstra_e_": 8089051}


def test_station_before_file_name(spark):
    docs = spark.createDataFrame(
        [(1, "Berlin Spandau", "westend"), (2, "", "Westend"), (3, None, "wedding"), (4, "zzz", "steglitz"),
         (5, "zzz", "qqq"), (6, None, None)],
        "id int, station string, file_station string",
    )
    resolved = names.fuzzy_resolve(names.station_names(docs, both=True), dictionary(spark, WORDS), min_score=0.8)
    found = {r.id: WORDS[r.station_eva] for r in names.resolve_station(docs, resolved).collect()}
    assert found == {1: "spandau", 2: "westend", 3: "wedding", 4: "steglitz"}
