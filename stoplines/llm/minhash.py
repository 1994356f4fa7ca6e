"""MinHash near-dedup by an inverted join on signature coordinates.

Documents with equal sets of word shingles form one class. A class has COORDINATES minimum hashes;
two classes are candidates if at least MATCHES of them agree. A pair with that many of the
coordinates in common shares one within the COORDINATES - MATCHES + 1 rarest of each, whatever the
order, as long as it is the same for all. So each class posts itself under these only, and values
that many documents share are skipped where rarer ones suffice. Collisions are counted on the
signatures, and candidates are confirmed on the full sets.

At a similarity of 0.85, fewer than 9 of 24 coordinates agree with a probability of 1e-8; at 0.8, of
1e-6.

Only components are wanted, not all pairs. Two rounds compare the classes of each posting list with
one of them, a different one in each round; after that, only classes that are still in different
components are compared: short lists by a join, long ones block by block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.llm import hashing as H
from stoplines.llm.common import arrow_map, components, string_buffer, text_key
from stoplines.storage import materialize

SHINGLE = 5
SIMILARITY = 80  # percent
COORDINATES = 24
MATCHES = 9
ROUNDS = 2
SHORT = 8  # classes of a posting list that is joined with itself
BLOCK = 512  # classes of a longer one that are compared at a time
LAST = np.iinfo(np.int64).max


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: words are lower-cased, parted by white space."""
    raw, offsets = string_buffer(column)
    raw = H.lower_ascii(raw)
    starts, ends, places = H.words(raw, offsets, H.NOT_SPACE)
    words = H.stretch_hashes(raw, starts, ends)
    grams = H.window_hashes(words, size)
    out = []
    for low, high in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        if high - low >= size:
            out.append(np.unique(grams[low : high - size + 1]))
        elif high > low:
            out.append(H.stretch_hashes(words[low:high], np.array([0]), np.array([high - low])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Minimum hashes of non-empty sets, one row each; each coordinate hashes by its own odd factor."""
    flat = np.concatenate(sets)
    begin = np.concatenate(([0], np.cumsum([len(x) for x in sets])[:-1]))
    factors = H.mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64))
    out = np.empty((len(sets), coordinates), np.uint64)
    for j in range(coordinates):
        out[:, j] = np.minimum.reduceat((flat ^ factors[2 * j]) * (factors[2 * j + 1] | np.uint64(1)), begin)
    # Equal values of different coordinates become different ones.
    return H.mix(out ^ factors[:coordinates]).view(np.int64)


def _signed(batch: pa.RecordBatch, size: int, coordinates: int) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"), size)
    full = [i for i, x in enumerate(sets) if len(x)]
    signature: list = [None] * len(sets)
    if full:
        for i, row in zip(full, _signatures([sets[i] for i in full], coordinates), strict=True):
            signature[i] = row
    classes = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), batch.column("k"), pa.array(classes, pa.binary()),
            pa.array([len(x) for x in sets], pa.int64()), pa.array(signature, pa.list_(pa.int64())),
        ],
        names=["doc_id", "k", "cls", "n_shingles", "signature"],
    )


def _postings(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """value, cls, signature: each class under its rarest coordinate values, if others hold them too."""
    elements = classes.select("cls", F.explode("signature").alias("value"))
    shared = elements.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (
        elements.join(shared, "value").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("values"))
        # Values of this class alone are the rarest of all, and match nothing.
        .withColumn("room", coordinates - matches + 1 - (coordinates - F.size("values"))).where("room > 0")
    )
    chosen = ranked.select("cls", F.explode(F.slice("values", F.lit(1), F.col("room"))).alias("v")).select("cls", F.col("v.value").alias("value"))
    return chosen.join(classes.select("cls", "signature"), "cls")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    one = sets.select(F.col("cls").alias("a"), F.col("members").alias("set_a"))
    two = sets.select(F.col("cls").alias("b"), F.col("members").alias("set_b"))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= similarity * (len(x) + len(y) - both))
        return batch.select(["a", "b"]).filter(pa.array(keep))

    return arrow_map(pairs.join(one, "a").join(two, "b"), compare, "a binary, b binary", None)


def _mixed(posts: DataFrame) -> DataFrame:
    """The lists that hold classes of more than one component, with their lengths n."""
    mixed = posts.groupBy("value").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    return materialize(posts.join(mixed.where("low <> high").select("value", "n"), "value"), "mixed")


def _short_pairs(mixed: DataFrame, matches: int, short: int) -> DataFrame:
    """Pairs of classes of different components in one list of at most `short`, with enough equal coordinates."""
    lists = mixed.where(F.col("n") <= short)
    one = lists.select("value", F.col("cls").alias("a"), F.col("signature").alias("sign_a"), F.col("component").alias("of_a"))
    two = lists.select("value", F.col("cls").alias("b"), F.col("signature").alias("sign_b"), F.col("component").alias("of_b"))
    near = one.join(two, "value").where("a < b AND of_a <> of_b")
    return near.where(F.size(F.array_intersect("sign_a", "sign_b")) >= matches).select("a", "b").distinct()


def _long_links(mixed: DataFrame, sets: DataFrame, matches: int, similarity: int, short: int, block: int) -> DataFrame:
    """Links that join components within longer lists, compared on full sets block by block.

    A group gives a spanning forest of its links, never all pairs. Two classes that share several
    long lists are compared in the first of them.
    """
    lists = mixed.where(F.col("n") > short)
    longs = lists.groupBy("cls").agg(F.sort_array(F.collect_set("value")).alias("values"))
    rows = lists.join(longs, "cls").join(sets, "cls").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    columns = ["value", "low", "high", "cls", "own", "component", "signature", "values", "members"]
    return rows.select(columns).groupBy("value", "low", "high").applyInPandas(
        lambda group: _forest(group, matches, similarity), "a binary, b binary"
    )


def _forest(group: pd.DataFrame, matches: int, similarity: int) -> pd.DataFrame:
    group = group.sort_values("cls", ignore_index=True)
    signatures = np.stack(group["signature"].to_numpy())
    component = np.unique(group["component"], return_inverse=True)[1]
    own = group["own"].to_numpy()
    across = group["low"].iloc[0] != group["high"].iloc[0]
    # Classes that share an earlier list are compared there.
    value = group["value"].iloc[0]
    earlier = [x[x < value] for x in group["values"]]
    number = np.unique(np.concatenate(earlier), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(group)), [len(x) for x in earlier])
    holds = np.zeros((len(group), number.max(initial=-1) + 1), np.float32)
    holds[owner, number] = 1
    members = [np.frombuffer(x, np.uint64) for x in group["members"]]
    size = np.array([len(x) for x in members])
    one, two = [], []
    for i in range(len(group) - 1):
        rest = slice(i + 1, None)
        near = (component[rest] != component[i]) & ((signatures[rest] == signatures[i]).sum(1) >= matches)
        if across:
            near &= own[rest] != own[i]
        if near.any() and holds.shape[1]:
            near &= holds[rest] @ holds[i] == 0
        at = np.flatnonzero(near) + i + 1
        if not len(at):
            continue
        flat = np.concatenate([members[j] for j in at])
        place = np.minimum(np.searchsorted(members[i], flat), size[i] - 1)
        both = np.add.reduceat((members[i][place] == flat).astype(np.int64), np.cumsum(size[at]) - size[at])
        for j in at[100 * both >= similarity * (size[at] + size[i] - both)]:
            if component[j] != component[i]:
                one.append(i)
                two.append(j)
                component[component == component[j]] = component[i]
    names = group["cls"].to_numpy()
    return pd.DataFrame({"a": names[one], "b": names[two]})


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY,
    coordinates: int = COORDINATES, matches: int = MATCHES, rounds: int = ROUNDS, short: int = SHORT, block: int = BLOCK,
) -> DataFrame:
    """doc_id, k, n_shingles, component_id, one row per document; k is a hash of 128 bits of the text.

    Links documents whose sets have 100 * intersection >= similarity * union; component_id is the
    smallest doc_id reachable over links, the document's own included. A text with fewer words than
    a shingle has one shingle of all of them; texts that are null or without words link with
    nothing and keep their own id. A null id counts as the greatest; a component of null ids only
    has a null component_id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("k"), "text")
    signed = materialize(
        arrow_map(
            rows, lambda batch: _signed(batch, shingle, coordinates),
            "doc_id long, k binary, cls binary, n_shingles long, signature array<long>",
        ),
        "signatures",
    )
    # A class takes any of its documents for its set, and the smallest id for its name.
    classes = signed.where("cls is not null").groupBy("cls").agg(
        F.min_by(F.struct("doc_id", "k"), F.struct(F.coalesce("doc_id", F.lit(LAST)), "k")).alias("row"),
        F.first("signature").alias("signature"),
    )
    posts = materialize(_postings(classes, coordinates, matches), "postings")
    holders = posts.select("cls").distinct().join(classes.select("cls", "row"), "cls")
    texts = rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST))).drop("doc_id").join(
        holders.select("cls", F.coalesce("row.doc_id", F.lit(LAST)).alias("id"), F.col("row.k").alias("k")), ["id", "k"]
    )
    sets = materialize(
        arrow_map(
            texts.select("cls", "text"),
            lambda batch: pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array([x.tobytes() for x in shingle_sets(batch.column("text"), shingle)], pa.binary())],
                names=["cls", "members"],
            ),
            "cls binary, members binary",
        ).dropDuplicates(["cls"]),
        "sets",
    )
    links = labels = None
    for turn in range(rounds + 1):
        own = posts.withColumn("component", F.col("cls"))
        if labels is not None:
            own = posts.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        if turn < rounds:
            head = F.struct(F.xxhash64("cls", F.lit(turn)).alias("rank"), "cls", "signature", "component")
            heads = own.groupBy("value").agg(F.min(head).alias("head"), F.count("*").alias("n")).where("n > 1")
            pairs = (
                own.join(heads, "value").where("component <> head.component")
                .where(F.size(F.array_intersect("signature", "head.signature")) >= matches)
                .select(F.least("cls", "head.cls").alias("a"), F.greatest("cls", "head.cls").alias("b")).distinct()
            )
            more = materialize(_confirmed(pairs, sets, similarity), "links")
        else:
            mixed = _mixed(own)
            more = _confirmed(_short_pairs(mixed, matches, short), sets, similarity)
            more = materialize(more.union(_long_links(mixed, sets, matches, similarity, short, block)), "links")
        links = more if links is None else links.union(more)
        labels = components(links)
    named = classes.select("cls", F.coalesce("row.doc_id", F.lit(LAST)).alias("id")).join(
        labels.withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = named.join(least, "component").select("cls", "component_id")
    return signed.join(of_class, "cls", "left").select(
        "doc_id", "k", "n_shingles",
        F.nullif(F.coalesce("component_id", "doc_id"), F.lit(LAST)).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.

    Documents without words stay, as do those with null ids whose component has no other. Rows with
    the same id and text are one document, of which one row stays.
    """
    found = near_duplicates(docs, **settings)
    keep = found.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"), "k",
        (F.coalesce("doc_id", F.lit(LAST)) == F.coalesce("component_id", F.lit(LAST))).alias("kept"),
        F.col("n_shingles") > 0,
    ).toDF("id", "k", "kept", "full").groupBy("id", "k").agg(F.max("kept").alias("kept"), F.max("full").alias("full"))
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), text_key().alias("k"),
    )
    chosen = rows.join(keep.where("kept or not full").select("id", "k"), ["id", "k"])
    return chosen.dropDuplicates(["id", "k"]).select("row.*")
