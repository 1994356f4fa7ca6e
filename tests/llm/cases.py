"""Small documents with the cases that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"


def documents(seed: int = 1, n: int = 40) -> list[tuple]:
    """Random words with copies, near copies, shared passages, null and empty texts, repeated rows and ids."""
    rng = random.Random(seed)
    words = ["The", "of", "and", "née", "Straße", "you", "idiot", "a|b", "x" * 30, "12", "ß", "🙂", "end."] + [
        "".join(rng.choice("abcdeg") for _ in range(rng.randint(1, 7))) for _ in range(60)
    ]
    passage = " ".join(rng.choice(words) for _ in range(30))
    texts: list[str | None] = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if i % 5 == 0:
            own[len(own) // 2 : len(own) // 2] = passage.split()
        texts.append(rng.choice([" ", "\n", "  ", "\t"]).join(own))
        if i % 7 == 3 and i:
            texts[-1] = texts[-2]
        if i % 7 == 5:
            changed = (texts[-2] or "").split()
            if changed:
                changed[rng.randrange(len(changed))] = "changed"
            texts[-1] = " ".join(changed)
    texts += [None, "", "   ", "one", "two words", "again " * 40, passage, passage.upper(), "long " + "w" * 3000]
    rows = [(i * 3, text) for i, text in enumerate(texts)]
    rows += [rows[4], rows[4], (rows[6][0], "another text of a known id"), (None, rows[5][1]), (None, None), (None, passage)]
    return [(i, text, "en", "s", None if text is None else len(text), 0.5, "x") for i, text in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def order(doc_id):
    """Null ids come after all others."""
    return float("inf") if doc_id is None else doc_id


def groups(pairs, nodes):
    """The smallest node that each node reaches."""
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {node: find(node) for node in nodes}
