"""Benchmark decontamination with suffix arrays of the training texts.

Every Arrow batch of documents is a shard. A task builds the shard's suffix array over words and
binary-searches every suffix of the benchmark items in it. Where a suffix's match reaches a whole
window, all its locations are read off the array; locations of suffixes that follow each other in an
item and in a document are one verbatim match, which so gets its full length. A document
never leaves its shard, so nothing is shuffled; a lost task builds its shards again.

The benchmark is looked up in blocks of at most BLOCK_WORDS words (or one item), each broadcast in
its turn, so that what is broadcast stays bounded however many items there are.

Words are compared by 64-bit hashes: within a shard's words and a block's words a clash has a
probability below 1e-6.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.common import arrow_map, string_buffer

WINDOW = 13
BLOCK_WORDS = 1 << 18
MATCHES = "array<struct<start:int,item_id:string,item_start:int,length:int>>"
ONE_IN = 20  # a document is contaminated if one in so many words is hit


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = string_buffer(column)
    raw = H.lower_ascii(raw)
    starts, ends, places = H.words(raw, offsets, H.LETTERS)
    return H.stretch_hashes(raw, starts, ends), places


class Items:
    """One block of the benchmark: its words as small numbers, its suffixes as rows."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        hashes, places = _word_hashes(pa.array(texts, pa.string()))
        lengths = np.diff(places)
        self.names = ids
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        self.item = np.repeat(np.arange(len(ids)), lengths)
        self.place = np.arange(len(hashes)) - np.repeat(places[:-1], lengths)  # the suffix's first word in its item
        left = np.repeat(places[1:], lengths) - np.arange(len(hashes))  # words up to the item's end
        need = np.minimum(window, np.repeat(lengths, lengths))
        self.need = np.where(left >= need, need, np.iinfo(np.int32).max)  # no window starts near the end
        self.depth = int(min(left.max(initial=1), window))
        columns = np.arange(len(hashes))[:, None] + np.arange(self.depth)
        padded = np.concatenate((numbers, np.zeros(self.depth, np.int64)))
        self.suffixes = np.where(np.arange(self.depth) < left[:, None], padded[columns], 0).astype(np.int32)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash in the vocabulary, 0 for other words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(text: np.ndarray, depth: int, alphabet: int) -> np.ndarray:
    """Places with a non-zero number, sorted by the next `depth` numbers; a 0 ends a suffix."""
    bits = max(1, int(alphabet).bit_length())
    per = max(1, 62 // bits)
    padded = np.concatenate((text, np.zeros(depth + per, text.dtype)))

    def key(places: np.ndarray) -> np.ndarray:
        out = np.zeros(len(places), np.int64)
        live = np.ones(len(places), bool)
        for k in range(per):
            number = np.where(live, padded[places + k], 0)
            live &= number > 0
            out = (out << bits) | number
        return out

    places = np.flatnonzero(text)
    keys = key(places)
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    group = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1]))) if len(keys) else keys
    at = np.arange(len(places))
    last = (1 << bits) - 1
    done = per
    while done < depth:
        # Go on only where neighbours are still equal and not ended.
        equal = np.zeros(len(at), bool)
        same = group[1:] == group[:-1]
        equal[1:] |= same
        equal[:-1] |= same
        keep = equal & ((keys & last) > 0)
        if not keep.any():
            break
        at, group = at[keep], group[keep]
        keys = key(places[at] + done)
        order = np.lexsort((keys, group))
        places[at] = places[at[order]]
        keys, old = keys[order], group[order]
        group = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]) | (old[1:] != old[:-1]))))
        done += per
    return places


def _search(text: np.ndarray, array: np.ndarray, suffixes: np.ndarray, lengths: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all suffixes, each by its first `lengths` numbers: first or end place in the array."""
    depth = suffixes.shape[1]
    low = np.zeros(len(suffixes), np.int64)
    high = np.full(len(suffixes), len(array))
    steps = np.arange(depth)
    rows = np.arange(len(suffixes))
    while (live := low < high).any():
        middle = (low + high) // 2
        here = text[array[np.minimum(middle, len(array) - 1)][:, None] + steps]
        differ = (here != suffixes) & (steps < lengths[:, None])
        first = differ.argmax(1)
        some = differ[rows, first]
        less = np.where(some, here[rows, first] < suffixes[rows, first], after)
        low = np.where(live & less, middle + 1, low)
        high = np.where(live & ~less, middle, high)
    return low


def windows(text: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """All places of windows in the shard's numbers, and the suffixes that begin with them."""
    array = suffix_array(text, items.depth, len(items.vocabulary))
    none = np.empty(0, np.int64)
    own = np.flatnonzero(items.need <= items.depth)
    if not len(array) or not len(own):
        return none, none
    padded = np.concatenate((text, np.zeros(items.depth, text.dtype)))
    low = _search(padded, array, items.suffixes[own], items.need[own], after=False)
    # Whether the neighbour there has the whole window: most suffixes end here.
    there = padded[array[np.minimum(low, len(array) - 1)][:, None] + np.arange(items.depth)]
    equal = (there == items.suffixes[own]) | (np.arange(items.depth) >= items.need[own][:, None])
    found = (low < len(array)) & equal.all(1)
    own, low = own[found], low[found]
    high = _search(padded, array, items.suffixes[own], items.need[own], after=True)
    counts = high - low
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return array[np.repeat(low, counts) + within], np.repeat(own, counts)


def longest(place: np.ndarray, suffix: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The verbatim matches that the windows are part of, none of which goes on at either side: place, suffix, length."""
    order = np.lexsort((place, place - suffix))
    place, suffix = place[order], suffix[order]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (np.diff(place) != 1) | (np.diff(suffix) != 1) | (np.diff(items.item[suffix]) != 0)
    first = np.flatnonzero(fresh)
    last = np.flatnonzero(np.append(fresh[1:], True)) if len(place) else first
    return place[first], suffix[first], place[last] + items.need[suffix[last]] - place[first]


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Where windows of the items occur in the documents.

    Adds to `docs` (any columns, with `text`): n_words, n_hit, hits (start and end word of each
    maximal hit stretch, one after the other), items (ids of items with an occurring window, as
    text, sorted) and matches: the longest verbatim matches of at least a window, each with its item,
    its first word in the item and in the document, and its length, in words; by place, then item. Words are lower-cased runs of a-z, 0-9 and characters beyond ASCII; a window is
    `window` consecutive words of an item, a shorter item is one window.

    Null or empty texts have no words and no hits; items without words have no window; a null item
    id is the empty text; several items of one id count as one. Rows are judged one by one, so that
    null or repeated document ids change nothing. Columns of `docs` named like the results are replaced.
    """
    results = ["n_words", "n_hit", "hits", "items", "matches"]
    docs = docs.drop(*results)
    kept = [field for field in docs.schema if field.name != "text"]
    own = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text"),
        (F.coalesce(F.length("text"), F.lit(0)) / 2 + 1).cast("long").alias("size"),  # words at most
    )
    total = own.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-2 * total // block_words)) if total > block_words else 1
    own = own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    frame = docs.select(
        F.struct(*[F.col(f"`{field.name}`") for field in kept]).alias("row"), "text",
        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"),
        F.array().cast(MATCHES).alias("matches"),
    )
    schema = frame.schema
    for block in range(blocks):
        rows = own.where(F.col("block") == block).select("item_id", "text").collect()
        shared = docs.sparkSession.sparkContext.broadcast(
            Items([row.item_id for row in rows], [row.text for row in rows], window)
        )

        def shard(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            return _shard(batch, shared.value)

        frame = arrow_map(frame, shard, schema)
    return frame.select("row.*", "text", *results)


def _shard(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
    hashes, places = _word_hashes(batch.column("text"))
    n = batch.num_rows
    counts = np.diff(places)
    # One number per word and a 0 after each document, so that no match leaves it.
    text = np.zeros(len(hashes) + n, np.int32)
    at = np.arange(len(hashes)) + np.repeat(np.arange(n), counts)
    text[at] = items.numbers(hashes)
    begins = places[:-1] + np.arange(n)
    place, suffix, length = longest(*windows(text, items), items)
    hit = H.covered(place, place + length, len(text))
    before = batch.column("hits")
    if before.flatten().__len__():
        spans = before.flatten().to_numpy().reshape(-1, 2)
        owner = np.repeat(np.arange(n), before.value_lengths().to_numpy() // 2)
        hit |= H.covered(begins[owner] + spans[:, 0], begins[owner] + spans[:, 1], len(text))
    starts, ends = H.runs(hit)
    owner = np.searchsorted(begins, starts, "right") - 1
    spans = np.stack((starts - begins[owner], ends - begins[owner]), 1).astype(np.int32)
    per_doc = np.bincount(owner, minlength=n)
    hits = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(2 * per_doc))), pa.int32()), pa.array(spans.reshape(-1))
    )
    found = batch.column("matches").to_pylist()
    doc = np.searchsorted(begins, place, "right") - 1
    own = zip(doc, place - begins[doc], items.item[suffix], items.place[suffix], length, strict=True)
    touched: dict[int, set[tuple]] = {}
    for i, start, item, item_start, size in own:
        touched.setdefault(int(i), set()).add((int(start), items.names[item], int(item_start), int(size)))
    names = batch.column("items").to_pylist()
    for i, new in touched.items():
        found[i] = sorted(new | {tuple(match.values()) for match in found[i]})
        names[i] = sorted({name for _, name, _, _ in found[i]})
        found[i] = [dict(zip(("start", "item_id", "item_start", "length"), match, strict=True)) for match in found[i]]
    kind = pa.struct([("start", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32()), ("length", pa.int32())])
    columns = {
        "row": batch.column("row"), "text": batch.column("text"), "n_words": pa.array(counts, pa.int64()),
        "n_hit": pa.array(np.bincount(owner, weights=ends - starts, minlength=n).astype(np.int64)),
        "hits": hits, "items": pa.array(names, pa.list_(pa.string())), "matches": pa.array(found, pa.list_(kind)),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def with_verdict(found: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """`contaminated`: some word is hit, and at least one in `one_in` words."""
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """The documents that are not contaminated, with their own columns; rules as find_contamination."""
    plain = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("whole"), F.col("text"))
    found = with_verdict(find_contamination(plain, items, window), one_in)
    return found.where("not contaminated").select("whole.*")
