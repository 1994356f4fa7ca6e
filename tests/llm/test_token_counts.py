"""Token counts against the library, and what the cache holds."""

import random
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece
from tokenizers import Tokenizer as Library

from stoplines.llm import token_counts
from stoplines.llm.token_counts import Cache, Tokenizer, WordCounts, count_tokens, normalised, pieces
from tests.llm.cases import documents, frame

FOLDER = Path(token_counts.TOKENIZER).parent
MODEL = str(FOLDER / "piece_bpe_32k.model")
BYTES = str(FOLDER / "byte_bpe_50k.json")

ODD = [
    "", "  ", "  Hello  WORLD\n", "<|endoftext|>", "<|ENDOFTEXT|> a", "a <|endoftext|>  B ", "x <|startoftext|><|endoftext|>",
    "H̱ x", "\x0b a b \x85 c", "it's IT'S  'S", "İstanbul ΣΣ", "a\x1cb\x1d c", " ̈a b", "Á   b", "12 345",
]


@pytest.fixture(scope="module", params=[token_counts.TOKENIZER, BYTES, MODEL], ids=["words", "bytes", "pieces"])
def tokenizer(request):
    path = request.param
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return path, lambda text: len(model.encode(text))
    library = Library.from_file(path)
    library.no_truncation()
    library.no_padding()
    return path, lambda text: len(library.encode(text, add_special_tokens=False).ids)


def test_normalised_texts_count_alike(tokenizer):
    path, count = tokenizer
    loaded = Tokenizer.load(path)
    assert (loaded.white, loaded.case) == (path == token_counts.TOKENIZER,) * 2
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aAé̈ \t\n<|>'s1.\x0ḇß") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    counter = loaded.counter()
    for text in texts:
        content = normalised(text, loaded).decode()
        assert count(text) == count(content) == counter([text])[0], text
    if loaded.white:
        assert WordCounts(counter, 5)(texts) == [count(text) for text in texts]
        assert normalised(" A\n b ", loaded) == b"a b"
        assert normalised("<|ENDoftext|>", loaded) == b"<|ENDoftext|>"


def test_counts_of_all_texts(spark, tokenizer, tmp_path):
    path, count = tokenizer
    rows = documents() + [(1000 + i, text, "en", "s", 1, 0.5, "x") for i, text in enumerate(ODD)]
    docs = frame(spark, rows)
    expected = Counter((row[0], len((row[1] or "").encode()), count(row[1] or "")) for row in rows)
    assert Counter(map(tuple, count_tokens(docs, str(tmp_path), path).collect())) == expected


def test_long_texts_are_cut_between_words(tokenizer):
    path, count = tokenizer
    text = "Wort <|endoftext|>  12\tzwei ̈ ' s" * 60
    if path == token_counts.TOKENIZER:
        parts = list(pieces(text, 50))
        assert "".join(parts) == text and len(parts) > 5
        assert sum(map(count, parts)) == count(text)
    assert list(pieces("x" * 200, 50)) == ["x" * 200]


@pytest.mark.parametrize("few", [0, 1000])
def test_only_misses_are_encoded(spark, tmp_path, few):
    cache, tokenizer = str(tmp_path), Tokenizer.load(token_counts.TOKENIZER)
    stored = Cache(spark, cache, tokenizer)
    texts = ["one two", " ONE  two", "three", None, ""]
    docs = frame(spark, [(i, text, "en", "s", 1, 0.5, "x") for i, text in enumerate(texts)])
    first = {row.doc_id: row.n_tokens for row in count_tokens(docs, cache, few=few).collect()}
    assert first == {0: 2, 1: 2, 2: 1, 3: 0, 4: 0}
    assert stored.read().count() == 3
    # What is in the cache is believed, and not written again.
    parts = stored._tables()
    assert spark.read.parquet(parts[0]).count() == 3
    more = docs.unionByName(frame(spark, [(9, "four five six", "en", "s", 1, 0.5, "x"), (10, "THREE", "en", "s", 1, 0.5, "x")]))
    second = {row.doc_id: row.n_tokens for row in count_tokens(more, cache, few=few).collect()}
    assert second == first | {9: 3, 10: 1}
    new = set(stored._tables()) - set(parts)
    assert [spark.read.parquet(path).count() for path in new] == [1]
    # Another tokenizer has a cache of its own; an append that both of two jobs made counts once.
    assert Cache(spark, cache, Tokenizer.load(MODEL)).read().count() == 0
    stored.append(stored.read())
    assert stored.read().count() == 4
    assert {row.doc_id: row.n_tokens for row in count_tokens(more, cache, few=few).collect()} == second


def test_empty_table(spark, tmp_path):
    assert count_tokens(frame(spark, []), str(tmp_path)).count() == 0
    assert count_tokens(frame(spark, []), str(tmp_path)).columns == ["doc_id", "n_bytes", "n_tokens"]
