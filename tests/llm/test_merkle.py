"""The Merkle manifest against plain trees."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stoplines.llm import merkle
from tests.llm.cases import documents, frame

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def levels(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        tree.append([digest("".join(tree[-1][i : i + 2])) for i in range(0, len(tree[-1]), 2)])
    return tree


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in order:
        groups[group].sort(key=lambda row: (row["doc_id"] is None, row["doc_id"] or 0, leaf(row)))
    trees = {group: levels([leaf(row) for row in groups[group]]) for group in order}
    top = levels([trees[group][-1][0] for group in order])
    out = []
    for at, group in enumerate(order):
        for place, row in enumerate(groups[group]):
            changed = dict(row)
            if is_tampered(row["doc_id"]) and row["n_chars"] is not None:
                changed["n_chars"] += 1
            node, siblings = leaf(changed), []
            for tree, i in ((trees[group], place), (top, at)):
                for nodes in tree[:-1]:
                    other = nodes[i ^ 1] if i ^ 1 < len(nodes) else ""
                    siblings.append(other)
                    node = digest(other + node if i & 1 else node + other)
                    i >>= 1
            root = top[-1][0]
            out.append((row["doc_id"], leaf(row), trees[group][-1][0], root, digest("".join(siblings)), node, node == root))
    return Counter(out)


def found(docs, height):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(docs, tampered, {"n_chars": F.col("n_chars") + 1}, height=height)


def odd_rows():
    """Groups of 1 to 40 leaves, a null and an empty group, names whose order in UTF-8 isn't that of UTF-16."""
    langs = [None, "", "de", "\U0001f642", "￮", "en", "en", "en"]
    return [
        (*row[:2], langs[i % len(langs)], None if i % 5 == 2 else row[3], *row[4:]) for i, row in enumerate(documents())
    ]


@pytest.mark.parametrize("height", [2, 10])
def test_trees(spark, height):
    docs = frame(spark, odd_rows())
    got = Counter(tuple(row) for row in merkle.verified(found(docs, height)).collect())
    assert got == expected([row.asDict() for row in docs.collect()])


@pytest.mark.parametrize("rows", [1, 5])
def test_one_group(spark, rows):
    docs = frame(spark, [(i, f"text {i}", "en", "s", 6, 0.0, "r") for i in range(rows)])
    got = Counter(tuple(row) for row in merkle.verified(found(docs, 2)).collect())
    assert got == expected([row.asDict() for row in docs.collect()])


def test_versions_copy_only_ancestors(spark):
    docs = frame(spark, [(i, f"text {i}", "en" if i % 9 else "de", "s", 6, 0.0, "r") for i in range(90)])
    manifest = found(docs, 3)
    base = {(row.grp, row.level, row.place): bytes(row.digest) for row in manifest.nodes().collect()}
    height = {grp: max(level for g, level, _ in base if g == grp) for grp in ("=de", "=en")}
    assert all(len({k for k in base if k[:2] == (grp, 0)}) == n for grp, n in (("=de", 10), ("=en", 80)))
    versions = {}
    for row in manifest.versions().collect():
        versions.setdefault((row.grp, row.first, row.doc_id), {})[row.level] = bytes(row.digest)
    assert {key[2] for key in versions} == {i for i in range(90) if is_tampered(i)}
    for (grp, first, _), copied in versions.items():
        # Both groups' roots are the leaves of one more tree of one level.
        assert sorted(copied) == list(range(height[grp] + 2))
        for level in range(height[grp]):
            place = first >> level
            pair = [copied[level] if at == place else base[grp, level, at] for at in (place & ~1, place | 1) if (grp, level, at) in base]
            assert copied[level + 1] == sha256("".join(x.hex() for x in pair).encode()).digest()
            assert copied[level] != base[grp, level, place]


def test_empty_table(spark):
    manifest = found(frame(spark, []), 3)
    assert manifest.root is None
    assert merkle.verified(manifest).count() == manifest.versions().count() == 0


def test_without_tampering(spark):
    manifest = merkle.manifest(frame(spark))
    assert all(row.verified for row in merkle.verified(manifest).collect())
    assert manifest.versions().count() == 0
