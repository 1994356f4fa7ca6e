"""Token counts with a cache: each distinct content is encoded once per version of the tokenizer.

A text's key is the SHA-256 of its normalised content, that is of the text without what the tokenizer
leaves out anyway. The cache is a folder of Parquet tables, one per append, under the tokenizer's
own digest; it holds keys and counts. Keys are joined to it; of the keys that it lacks one text each
is encoded, and their counts are appended.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stoplines.llm.common import arrow_map
from stoplines.storage import _hadoop_path, materialize

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
LIMIT = 2048
PIECE = 1 << 18  # characters of a text that are encoded at a time
FEW = 1 << 20  # keys of 32 bytes that are sent to every executor
WORDS = 1 << 20  # words whose counts a task remembers
ROWS = "key binary, n_tokens long"
_CUT = re.compile(r"[ \t\n\x0b\f\r](?=[A-Za-z0-9])")


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer's file, its digest, and which differences between texts it doesn't see."""

    data: bytes
    kind: str
    digest: str
    white: bool = False  # runs of white space count as one space, and none at the ends
    case: bool = False  # ASCII letters are lower-cased
    special: tuple[str, ...] = ()

    @classmethod
    def load(cls, path: str) -> Tokenizer:
        """A `.json` file is one of the library tokenizers, a `.model` file one of sentencepiece."""
        with open(path, "rb") as file:
            data = file.read()
        kind = "tokenizers" if path.endswith(".json") else "sentencepiece"
        # Another release of the library may count otherwise.
        version = __import__(kind).__version__
        digest = sha256(f"{kind} {version} ".encode() + data).hexdigest()
        if kind == "sentencepiece":
            return cls(data, kind, digest)
        model = json.loads(data)

        def parts(name: str, inner: str) -> list[dict]:
            found = model.get(name) or {}
            return found[inner] if found.get("type") == "Sequence" else [found]

        steps = parts("normalizer", "normalizers")
        kinds = [step.get("type") for step in steps]
        one_space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        # Words are all that the split keeps, and no word has white space in it.
        split = (parts("pre_tokenizer", "pretokenizers") or [{}])[0]
        words = (split.get("pattern") or {}).get("Regex", "")
        dropped = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
        dropped &= "[^\\s\\p{L}\\p{N}]+" in words and "\\s+" not in words and " " not in words
        added = model.get("added_tokens") or []
        plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]) for a in added)
        known = plain and set(kinds) <= {"NFC", "Replace", "Lowercase"} and [s for s in steps if s.get("type") == "Replace"] in ([], [one_space])
        return cls(
            data, kind, digest, known and dropped and one_space in steps,
            known and "Lowercase" in kinds, tuple(a["content"] for a in added),
        )

    def counter(self):
        """A function from texts to their numbers of tokens; without begin, end or other added tokens."""
        if self.kind == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer as Library

        model = Library.from_str(self.data.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(found.ids) for found in model.encode_batch_fast(texts, add_special_tokens=False)]


def normalised(text: str | None, tokenizer: Tokenizer) -> bytes:
    """The text, in UTF-8, without differences that never change its number of tokens; null is empty.

    Only ASCII texts without a special token's string are lower-cased: composition of other letters
    can depend on their case, and special strings on theirs.
    """
    content = (text or "").encode("utf-8", "surrogatepass")
    if tokenizer.white:
        content = b" ".join(content.split())
    if tokenizer.case and content.isascii():
        lower = content.lower()
        if not any(name.lower().encode() in lower for name in tokenizer.special):
            return lower
    return content


def _keys(batch: pa.RecordBatch, tokenizer: Tokenizer) -> pa.Array:
    return pa.array([sha256(normalised(text, tokenizer)).digest() for text in batch.column("text").to_pylist()], pa.binary())


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts whose counts add up: cut where white space comes before an ASCII letter or digit."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class WordCounts:
    """Counts of texts by their words: for a tokenizer to which white space is a gap and nothing else.

    A word, up to the next ASCII white space, gives the same tokens wherever it stands. Each is encoded once for as
    long as it is remembered, which is until `most` words are.
    """

    def __init__(self, count, most: int = WORDS):
        self.count, self.most, self.known = count, most, {}

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.most:
            self.known.clear()
        words = [text.encode("utf-8", "surrogatepass").split() for text in texts]
        new = list(set().union(*words).difference(self.known))
        self.known.update(zip(new, self.count([word.decode("utf-8", "replace") for word in new]), strict=True))
        return [sum(map(self.known.__getitem__, own)) for own in words]


_COUNTERS: dict = {}


def _counter_of(tokenizer: Tokenizer):
    """The tokenizer's counter; a Python worker keeps it, and the words it knows, from task to task."""
    if tokenizer.digest not in _COUNTERS:
        _COUNTERS.clear()
        count = tokenizer.counter()
        _COUNTERS[tokenizer.digest] = WordCounts(count) if tokenizer.white else count
    return _COUNTERS[tokenizer.digest]


def _counts(batch: pa.RecordBatch, count, white: bool) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    found = np.zeros(len(texts), np.int64)
    held: list[tuple[int, str]] = []

    def flush() -> None:
        if held:
            np.add.at(found, [i for i, _ in held], count([part for _, part in held]))
            held.clear()

    # Encodings take many times the memory of their text: those of a few are held at a time.
    size = 0
    for i, text in enumerate(texts):
        for part in pieces(text) if white else [text]:
            held.append((i, part))
            size += len(part)
            if size >= PIECE:
                flush()
                size = 0
    flush()
    return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)], names=["key", "n_tokens"])


class Cache:
    """Counts by content, in the folder `path`/`tokenizer digest`; one Parquet table per append.

    An append is one new table, written beside the others under a name that starts with "_" and then renamed; a job that
    fails leaves no count behind. Two jobs may append the same keys: they have the same counts.
    """

    def __init__(self, spark: SparkSession, path: str, tokenizer: Tokenizer):
        self.spark, self.folder = spark, f"{path.rstrip('/')}/{tokenizer.digest}"

    def _tables(self) -> list[str]:
        folder, files = _hadoop_path(self.spark, self.folder)
        found = files.listStatus(folder) if files.exists(folder) else []
        return sorted(f"{self.folder}/{status.getPath().getName()}" for status in found if status.getPath().getName().startswith("part="))

    def read(self) -> DataFrame:
        """key, n_tokens: one row per key."""
        tables = self._tables()
        if not tables:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*tables).groupBy("key").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, rows: DataFrame) -> DataFrame:
        """Store the rows and return them as stored."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.folder}/_new-{name}")
        source, files = _hadoop_path(self.spark, f"{self.folder}/_new-{name}")
        target, _ = _hadoop_path(self.spark, f"{self.folder}/part={name}")
        if not files.rename(source, target):
            raise OSError(f"{source} can't be renamed to {target}")
        return self.spark.read.schema(ROWS).parquet(f"{self.folder}/part={name}")


def count_tokens(docs: DataFrame, cache: str, path: str = TOKENIZER, few: int = FEW) -> DataFrame:
    """doc_id, n_bytes, n_tokens: the tokens of every whole text, from the cache at `cache` and added to it.

    A null text has 0 bytes and counts as an empty one. Strings of special tokens inside a text are
    what the library makes of them by default. Rows may repeat; each gets its count. Other columns are not read.
    """
    spark = docs.sparkSession
    tokenizer = Tokenizer.load(path)
    known = Cache(spark, cache, tokenizer)
    data = spark.sparkContext.broadcast(tokenizer)  # the file of the vocabulary: its size doesn't grow with the documents

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), sizes, _keys(batch, data.value)], names=["doc_id", "n_bytes", "key"]
        )

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [_keys(batch, data.value), batch.column("text").fill_null("")], names=["key", "text"]
        )

    docs = docs.select("doc_id", "text")
    found = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("key", T.BinaryType())])
    rows = materialize(arrow_map(docs, keys, found), "token-keys")
    stored = known.read()
    misses = materialize(rows.select("key").distinct().join(stored, "key", "left_anti"), "token-misses")
    # Copies are dropped before the texts move. Few misses are sent to the texts; for many, the texts move once, by key.
    texts, one = arrow_map(docs.select("text"), keyed, "key binary, text string"), F.first("text").alias("text")
    if misses.count() <= few:
        texts = texts.join(F.broadcast(misses), "key", "left_semi").groupBy("key").agg(one)
    else:
        texts = texts.groupBy("key").agg(one).join(misses.hint("merge"), "key", "left_semi")
    added = known.append(arrow_map(texts, lambda batch: _counts(batch, _counter_of(data.value), data.value.white), ROWS))
    counts = stored.unionByName(added)
    return rows.join(counts, "key").select("doc_id", "n_bytes", "n_tokens")
