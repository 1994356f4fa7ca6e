"""Decontamination, secrets, pieces, embeddings and the pipeline."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stoplines.llm import decontaminate, embeddings, secrets, subword
from stoplines.llm.lattice import Vocabulary
from stoplines.storage import scratch_root
from tests.llm.cases import documents, frame, groups, order
from tests.llm.test_models import PIECES, small_vocabulary


def contamination(rows, items, window):
    split = lambda t: [w for w in re.split(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").encode().lower()) if w]
    windows = []
    for name, text in items:
        words = split(text)
        n = min(window, len(words))
        windows += [(name or "", words[i : i + n]) for i in range(len(words) - n + 1) if words]
    out = Counter()
    for i, text, *_ in rows:
        words, hit, names = split(text), set(), set()
        for name, win in windows:
            for j in range(len(words) - len(win) + 1):
                if words[j : j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    names.add(name)
        out[(i, text, len(words), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(words))] += 1
    return out


@pytest.mark.parametrize(("window", "block"), [(13, 1 << 18), (3, 8)])
def test_decontamination(spark, window, block):
    rows = documents()
    texts = [text for _, text, *_ in rows if text]
    items = [("b", texts[3]), ("a", texts[0][:200]), ("a", "The of"), (None, texts[8].upper()), ("none", None), ("empty", " !"), ("one", "idiot")]
    found = decontaminate.with_verdict(
        decontaminate.find_contamination(frame(spark, rows), spark.createDataFrame(items, "item_id string, text string"), window, block)
    )
    got = Counter((r.doc_id, r.text, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())
    assert got == contamination(rows, items, window)
    assert all(sum(b - a for a, b in zip(r.hits[::2], r.hits[1::2])) == r.n_hit for r in found.collect())


@pytest.mark.parametrize("block", [1 << 18, 40])
def test_longest_matches_and_their_places(spark, block):
    """Matches are measured to their ends, beyond many windows, and have all their places."""
    words = [f"w{i}" for i in range(400)]
    items = {"long": words[100:300], "short": ["q1", "q2"], "twice": words[120:140] + ["x"] + words[120:140], "none": ["zz"] * 13}
    texts = [
        words, words[90:180] + ["q1", "q2", "q1"] + words[180:205], words[120:133] * 2, ["q1", "q2", "q1", "q2"], words[120:132], ["zz"] * 15, [],
    ]
    rows = [(i, " ".join(text), "en", "s", 1, 0.0, "r") for i, text in enumerate(texts)]
    found = decontaminate.find_contamination(
        frame(spark, rows), spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id string, text string"), block_words=block
    )
    for row in found.collect():
        text, expected = texts[row.doc_id], []
        for name, item in items.items():
            for i in range(len(text)):
                for j in range(len(item)):
                    if text[i] == item[j] and not (i and j and text[i - 1] == item[j - 1]):
                        n = 0
                        while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]:
                            n += 1
                        if n >= min(13, len(item)):
                            expected.append((i, name, j, n))
        assert [tuple(match) for match in row.matches] == sorted(expected)
        assert row["items"] == sorted({match[1] for match in expected})


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.remove_contaminated(frame(spark), items).count() == len(documents())
    assert decontaminate.find_contamination(frame(spark, []), items).count() == 0


SECRETS = [
    "password=abcdefgh1 and TOKEN : 'short' api_key=\"ABCDEFGH/+=\"",
    "AKIA" + "Q" * 16 + " AKIAshort AKIA" + "7" * 11,
    "é🙂 " + "0123456789abcdef" * 3 + "g token=" + "ab12" * 10,
    "passwd=token=secret=x secret:12345678",
    "-----BEGIN RSA PRIVATE KEY-----\nMIIE\n-----END RSA PRIVATE KEY----- ghp_" + "a1B2" * 9,
    None, "", "nothing here", "deadbeef" * 4 + " " + "deadbee" * 4, "Apikey=" + "Z" * 9,
]


def test_secrets(spark):
    rows = [(i, text, "en", "s", 1, 0.0, "r") for i, text in enumerate(SECRETS)] + documents(2, 5)
    rows += [(2, SECRETS[2], "en", "s", 1, 0.0, "r"), (None, SECRETS[0], "en", "s", 1, 0.0, "r")]
    found = secrets.scan_secrets(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    seen = set()
    for row in found:
        expected = []
        for kind, rule in enumerate(secrets.RULES):
            flags = re.ASCII | (re.IGNORECASE if rule.pattern.startswith("(?i)") else 0)
            for m in re.finditer(rule.pattern.removeprefix("(?i)"), row.text or "", flags):
                if len(m.group(rule.value)) >= rule.at_least:
                    expected.append((m.start(), kind, m.end(), rule.kind))
                    seen.add(rule.kind)
        assert [tuple(s) for s in row.spans] == sorted(expected)
    assert {"assign", "access", "hex", "private_key", "github"} <= seen


def test_redaction(spark):
    rows = [(i, text, "en", "s", None if text is None else len(text), 0.0, "r") for i, text in enumerate(SECRETS)]
    clean = {r.doc_id: r for r in secrets.redact(frame(spark, rows)).collect()}
    assert clean[5].text is None and clean[7].text == "nothing here"
    assert clean[1].text == "[secret] AKIAshort [secret]"[: len("[secret] AKIAshort ")] + "AKIA" + "7" * 11
    assert clean[2].text == "é🙂 [secret]g [secret]" and clean[2].n_chars == len(clean[2].text)
    again = secrets.scan_secrets(secrets.redact(frame(spark, rows)))
    assert again.where(F.size("spans") > 0).count() == 0


def test_texts_of_many_secrets(spark):
    """More spans than one block, overlapping ones among them, and blocks that end within an overlap."""
    rng = random.Random(4)
    parts = ["AKIA" + "Q" * 16, "token=" + "ab12" * 10, "secret: abcdefgh", "é🙂 words", "token=" + "AKIA" + "Z" * 20]
    texts = [" ".join(rng.choice(parts) for _ in range(size)) for size in (255, 256, 257, 700, 2000)]
    rows = [(i, text, "en", "s", len(text), 0.0, "r") for i, text in enumerate(texts)]
    found = {r.doc_id: r.spans for r in secrets.scan_secrets(frame(spark, rows)).collect()}
    clean = {r.doc_id: r for r in secrets.redact(frame(spark, rows)).collect()}
    for i, text in enumerate(texts):
        expected = sorted(
            (m.start(), kind, m.end(), rule.kind) for kind, rule in enumerate(secrets.RULES)
            for m in re.finditer(rule.pattern.removeprefix("(?i)"), text, re.ASCII | (re.IGNORECASE if rule.pattern.startswith("(?i)") else 0))
            if len(m.group(rule.value)) >= rule.at_least
        )
        assert [tuple(s) for s in found[i]] == expected
        out, at = "", 0
        for start, _, end, _ in expected:
            if start >= at:
                out += text[at:start] + secrets.PLACEHOLDER
            at = max(at, end)
        assert clean[i].text == out + text[at:] and clean[i].n_chars == len(clean[i].text)


def test_redaction_of_nothing(spark):
    assert secrets.redact(frame(spark, [])).count() == 0


def test_running_values(spark):
    sizes = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 255, 256, 257, 1000)], "v array<int>")
    for v, sums, most in sizes.select("v", secrets.running(F.col("v"), lambda a, b: a + b), secrets.running(F.col("v"), F.greatest)).collect():
        assert sums == [sum(v[:i]) for i in range(len(v) + 1)]
        assert most == [max([0, *v[:i]]) for i in range(len(v) + 1)]


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{32,}") == []
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [frozenset({frozenset({"aki", "kia"})})]
    assert secrets.trigram_query("ab?cd|xyz") == [frozenset({frozenset({"acd"}), frozenset({"abc", "bcd"}), frozenset({"xyz"})})]


def test_no_secrets_in_no_documents(spark):
    assert secrets.scan_secrets(frame(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [7, 64, subword.CHUNK])
def test_pieces_decode_to_the_text(spark, chunk):
    rows = documents() + [(1, "▁ a  ▁b\x00 ", "en", "s", 1, 0.0, "r"), (2, " " * 40, "en", "s", 1, 0.0, "r"), (3, "x" * 300, "en", "s", 1, 0.0, "r")]
    both = subword.decode(subword.encode(frame(spark, rows), chunk=chunk, check=True)).collect()
    assert len(both) == len(rows) and all(row.exact for row in both)
    assert all(row.decoded == (row.text or "") for row in both)
    assert Counter((r.doc_id, r.text) for r in both) == Counter((i, t) for i, t, *_ in rows)


def test_chunks_give_the_same_pieces(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = frame(spark).select("doc_id", "text").union(table).union(spark.createDataFrame([(-1, "ab" * 500), (-2, " a" * 300 + " " * 50)], table.schema))
    pieces = lambda chunk: Counter((r.doc_id, r.text, tuple(r.pieces)) for r in subword.encode(docs, chunk=chunk).collect())
    whole = pieces(subword.CHUNK)
    for chunk in (5, 64, 256):
        assert pieces(chunk) == whole


def test_ties_are_settled_as_in_one_piece():
    """Many segmentations are equally good; chunks, entered and left by their states, give the pieces of the whole."""
    rng = random.Random(5)
    vocabulary = small_vocabulary()
    for cut_at_spaces in (True, False):
        vocabulary.cut_at_spaces = cut_at_spaces
        vocabulary.scores = np.where(np.arange(len(PIECES)) % 3 == 0, -2.0, -1.0) * np.array([len(piece) for piece in PIECES])
        encoder, reach = subword.Encoder(vocabulary), vocabulary.longest
        for _ in range(60):
            points, sizes = subword.code_points(["".join(rng.choice("aabbc  d") for _ in range(rng.randint(1, 60)))])
            cuts = sorted({0, len(points), *(rng.randint(0, len(points)) for _ in range(4))})
            parts = [(points[a : b + reach], b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
            row, rows = np.where(np.arange(reach) == 0, 0.0, -np.inf), []
            for part in parts:
                rows.append(row)
                row = subword.advance(row, encoder.transfer(*part))
            leave, ids = 0, []
            for (own, size), before in reversed(list(zip(parts, rows, strict=True))):
                enter = int(encoder.entering(own, size, before)[leave])
                ids[:0] = encoder.segment(own[enter : size + leave], np.array([size + leave - enter]))[0].tolist()
                leave = enter
            assert leave == 0 and ids == encoder.segment(points, sizes)[0].tolist()


@pytest.mark.parametrize("backward", [False, True])
def test_scan_in_blocks(spark, backward):
    rng = np.random.default_rng(2)
    maps = {(n, part): rng.permutation(4).astype(np.int32) for n, size in ((1, 1), (2, 23), (3, 6)) for part in range(size)}
    elements = spark.createDataFrame([(n, part, bytearray(m.tobytes())) for (n, part), m in maps.items()], "n long, part int, value binary")
    found = subword.scan(elements, np.zeros(1, np.int32), (4,), lambda a, b: b[a], lambda state, own: own[state], backward, block=4)
    got = {(r.n, r.part): int(np.frombuffer(r.state, np.int32)[0]) for r in found.collect()}
    expected, last = {}, {}
    for n, part in sorted(maps, reverse=backward):
        expected[n, part] = last.get(n, 0)
        last[n] = int(maps[n, part][expected[n, part]])
    assert got == expected


def best_score(text, table, fallback):
    score = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        for k in range(1, len(text) - i + 1):
            way = table.get(text[i : i + k], fallback if k == 1 else -np.inf)
            score[i + k] = max(score[i + k], score[i] + way)
    return score[-1]


def test_best_paths_and_matrices():
    vocabulary = small_vocabulary()
    encoder = subword.Encoder(vocabulary)
    table = dict(zip(PIECES, vocabulary.scores, strict=True))
    rng = random.Random(3)
    for _ in range(30):
        text = "".join(rng.choice("aabbc  d") for _ in range(rng.randint(1, 40)))
        points, sizes = subword.code_points([text])
        marked = "".join(chr(p) for p in points)
        _, _, scores = encoder.segment(points, sizes)
        assert scores[0] == pytest.approx(best_score(marked, table, vocabulary.fallback))
        cuts = sorted({0, len(points), *(rng.randint(0, len(points)) for _ in range(3))})
        parts = [encoder.transfer(points[a : b + vocabulary.longest], b - a) for a, b in zip(cuts, cuts[1:])]
        one = parts[0]
        for part in parts[1:]:
            one = subword.combine(one, part)
        assert one[0, 0] == pytest.approx(scores[0])


def test_vocabulary_file():
    vocabulary = Vocabulary.load(subword.VOCABULARY)
    assert vocabulary.cut_at_spaces and len(vocabulary.byte_ids) == 256 and len(vocabulary.pieces) > 30_000


def test_pieces_of_no_documents(spark):
    assert subword.encode(frame(spark, [])).count() == 0


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(12, 8))
    for i in range(300):
        v = centres[i % 12] + rng.normal(size=8) * rng.choice([0.02, 0.2, 0.6])
        rows.append((i, [float(x) for x in v], int(i % 3)))
    rows += [(300, rows[0][1], 0), (301, rows[0][1], 1), (302, rows[0][1], None), (303, None, 1), (304, [], 1), (305, [0.0] * 8, 1)]
    rows += [(306, [float("nan")] * 8, 1), (307, [float("inf")] + [0.0] * 7, 1), (308, [None] + [1.0] * 7, 1), (309, [1.0, 2.0], 1), (310, [2.0, 4.0], 1)]
    rows += [(None, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (311, [x * 1e300 for x in rows[7][1]], rows[7][2])]
    return rows


@pytest.mark.parametrize(("cell_rows", "block"), [(4096, 1024), (20, 7)])
def test_embeddings(spark, cell_rows, block):
    rows = vectors()
    usable = [
        np.array(v, float) if v and None not in v and label is not None and np.isfinite(v).all() and any(v) else None for _, v, label in rows
    ]
    units = [None if v is None else v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for v in usable]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93
    ]
    count = Counter(x for pair in links for x in pair)
    root = groups(links, range(len(rows)))
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, float("inf")), order(rows[i][0]))
    expected = Counter((order(rows[i][0]), count[i], least[root[i]]) for i in range(len(rows)))
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("unit", F.lit("clash"))
    found = embeddings.near_duplicates(docs, cell_rows=cell_rows, block=block).collect()
    assert Counter((order(r.vec_id), r.n_links, order(r.component_id)) for r in found) == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)


def test_vectors_are_stored_once_for_all_cells_and_blocks(spark):
    """Vectors in the middle of several cells and blocks: a copy for each would take disk with the pairs, not the vectors."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 6))
    rows = [(i, [float(x) for x in base[i % 200] + rng.normal(size=6) * 0.1], i // 200 % 2) for i in range(800)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.glob("*")) if root.exists() else set()
    fields = ["vec_id", "n_links", "component_id", "kept"]
    found = embeddings.near_duplicates(docs, cell_rows=40, block=16, round_rows=100)
    links = sorted(found.select(fields).collect())
    stored = [path for path in set(root.glob("*")) - before if path.name.startswith("cells-")]
    assert [spark.read.parquet(str(path)).count() for path in stored] == [800]
    # Several rounds and cells, one round and no cells: the same links.
    assert links == sorted(embeddings.near_duplicates(docs, cell_rows=800).select(fields).collect())
    assert sum(row.n_links for row in links) > 800


def test_rounds_hold_parts_in_order():
    parts = [{"part": i, "rows": rows, "bytes": 8 * rows} for i, rows in enumerate((3, 4, 5, 12, 1, 1))]
    assert [[part["part"] for part in own] for own in embeddings._rounds(parts, 10, 80)] == [[0, 1], [2], [3], [4, 5]]


def test_no_embeddings(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
