"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From its mandatory literals follows a Boolean query on
trigrams: an AND of choices, each choice an OR of trigram sets. The index has one posting per
document and trigram that some rule asks for; postings of a document are intersected by one
aggregation, and only its candidate rules are verified on its text. Rules without a mandatory
trigram are run on all texts.

Trigrams are matched on lower-cased texts, which can only add candidates.
"""

from __future__ import annotations

import re._parser as regex
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoplines.storage import materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    value: int = 0  # the group whose length decides
    at_least: int = 1  # shorter values are no secrets
    base: bool = False


# The rules, in the order of their kinds.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,20}PRIVATE KEY-----)?"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
PLACEHOLDER = "[secret]"
# As many strings are spelled out for one stretch of a pattern; beyond, the stretch is cut.
SPELLED = 64
# Running values and the parts of a redacted text are made in blocks of as many elements.
BLOCK = 256

Choice = frozenset[frozenset[str]]


def trigram_query(pattern: str) -> list[Choice]:
    """The choices of which a matching text, lower-cased, fulfils all: one of the sets, each trigram of it."""
    query: list[Choice] = []

    def close(texts: set[str]) -> None:
        if all(len(text) >= 3 for text in texts):
            sets = {frozenset(text[i : i + 3] for i in range(len(text) - 2)) for text in texts}
            query.append(frozenset(x for x in sets if not any(y < x for y in sets)))

    def spelled(tokens) -> set[str] | None:
        """All texts that the tokens match, if they are few; else None."""
        texts = {""}
        for kind, value in tokens:
            name = str(kind)
            if name == "LITERAL":
                more: set[str] | None = {chr(value).lower()}
            elif name == "SUBPATTERN":
                more = spelled(value[3])
            elif name == "BRANCH":
                parts = [spelled(part) for part in value[1]]
                more = None if None in parts else set().union(*parts)
            elif name == "MAX_REPEAT" and value[:2] == (0, 1):
                part = spelled(value[2])
                more = None if part is None else part | {""}
            elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value):
                more = {chr(v).lower() for _, v in value}
            else:
                return None
            if more is None or len(texts) * len(more) > SPELLED:
                return None
            texts = {a + b for a in texts for b in more}
        return texts

    def walk(tokens) -> None:
        texts = {""}
        for token in tokens:
            more = spelled([token])
            if more is not None and len(texts) * len(more) <= SPELLED:
                texts = {a + b for a in texts for b in more}
                continue
            close(texts)
            texts = {""} if more is None else more
            name, value = str(token[0]), token[1]
            if name == "SUBPATTERN":
                walk(value[3])
            elif name == "MAX_REPEAT" and value[0] > 0:
                walk(value[2])
        close(texts)

    walk(regex.parse(pattern))
    return query


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index: trigram, k1, k2 for every trigram that a rule asks for."""
    grams = sorted({gram for rule in rules for choice in trigram_query(rule.pattern) for texts in choice for gram in texts})
    lower = docs.select("k1", "k2", F.lower("text").alias("lower"))
    present = F.array(*[F.when(F.contains("lower", F.lit(gram)), F.lit(gram)) for gram in grams])
    return lower.select("k1", "k2", F.explode(F.array_compact(present)).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """k1, k2, rules: the kinds whose trigram query the document's postings fulfil."""

    def fulfilled(choice: Choice) -> Column:
        sets = [reduce(and_, [F.array_contains("trigrams", gram) for gram in sorted(texts)]) for texts in choice]
        return reduce(or_, sets)

    kinds = []
    for rule in rules:
        if query := trigram_query(rule.pattern):
            kinds.append(F.when(reduce(and_, [fulfilled(choice) for choice in query]), F.lit(rule.kind)))
    merged = index.groupBy("k1", "k2").agg(F.collect_set("trigram").alias("trigrams"))
    return merged.select("k1", "k2", F.array_compact(F.array(*kinds)).alias("rules")).where(F.size("rules") > 0)


SPAN = "array<struct<start:int,kind_order:int,end:int,kind:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def _blocks(values: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of each stretch of BLOCK elements, in order; none for an empty array."""
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda start: body(F.slice(values, start, BLOCK)))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of ints the merge of 0 and all elements before it, and one more: of all elements.

    An array grows by copies, so the values grow within blocks, and the blocks' first values apart from them.
    """

    def grown(first: Column, own: Column) -> Column:
        more = lambda out, value: F.concat(out, F.array(merge(F.element_at(out, -1), value))).cast("array<int>")
        return F.aggregate(own, F.array(first).cast("array<int>"), more)

    def all_blocks(all_values: Column) -> Column:
        total = lambda own: F.aggregate(own, F.lit(0), lambda state, value: merge(state, value).cast("int"))
        firsts = grown(F.lit(0), _blocks(all_values, total))
        blocks = F.arrays_zip(_blocks(all_values, lambda own: own).alias("own"), firsts.alias("first"))
        # After the last block stands its end, with no elements.
        inner = lambda block: F.when(block["own"].isNull(), F.array(block["first"])).otherwise(
            _let(grown(block["first"], block["own"]), lambda out: F.slice(out, 1, F.size(out) - 1))
        )
        return F.flatten(F.transform(blocks, inner))

    return _let(values, all_blocks)


def _spans(rule: Rule, order: int) -> Column:
    """Spans of all matches of the rule in `text`, leftmost first, from what lies between them."""
    pattern = F.lit(rule.pattern)
    match = F.regexp_extract_all("text", pattern, F.lit(0))
    value = F.regexp_extract_all("text", pattern, F.lit(rule.value))
    parts = F.zip_with(
        F.zip_with(F.split("text", rule.pattern, -1), match, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"))),
        value, lambda part, v: F.struct(part["gap"].alias("gap"), part["size"].alias("size"), F.length(v).alias("value")),
    )
    # The last gap has no match after it.
    parts = F.filter(parts, lambda part: part["size"].isNotNull())

    def spans(own: Column) -> Column:
        ends = running(F.transform(own, lambda part: part["gap"] + part["size"]), lambda a, b: a + b)
        ended = F.zip_with(own, F.slice(ends, 2, F.size(own)), lambda part, end: F.struct(
            (end - part["size"]).alias("start"), end.alias("end"), part["value"].alias("value"),
        ))
        enough = F.filter(ended, lambda part: part["value"] >= rule.at_least)
        return F.transform(enough, lambda part: F.struct(
            part["start"].alias("start"), F.lit(order).alias("kind_order"), part["end"].alias("end"), F.lit(rule.kind).alias("kind"),
        )).cast(SPAN)

    return _let(parts, spans)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with `spans`: start, end (code points, end exclusive), kind; by start, then kind as listed.

    Matches of a rule are leftmost and do not overlap; spans of different rules may. A null text is
    empty and has no span. Documents are told apart by id and text (see common.text_key): null ids and
    repeated rows are scanned like others. Other columns are kept; one named `spans` is replaced.
    """
    docs = docs.drop("spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"]).alias("row"),
        F.col("text").alias("own_text"),
        F.xxhash64(F.col("doc_id"), text).alias("k1"), F.xxhash64(text, F.col("doc_id"), F.lit(1)).alias("k2"),
    )
    plain = rows.select("k1", "k2", F.coalesce("own_text", F.lit("")).alias("text"))
    chosen = candidates(materialize(postings(plain, rules), "postings"), rules)
    joined = rows.join(chosen, ["k1", "k2"], "left").withColumn("text", F.coalesce("own_text", F.lit("")))
    found = []
    for order, rule in enumerate(rules):
        run = F.col("text").rlike(rule.pattern)
        if trigram_query(rule.pattern):
            run = F.array_contains("rules", rule.kind) & run
        found.append(F.when(run, _spans(rule, order)).otherwise(F.array().cast(SPAN)))
    return joined.withColumn("spans", F.array_sort(F.concat(*found))).select("row.*", F.col("own_text").alias("text"), "spans")


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def base_spans(rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = [rule.kind for rule in rules if rule.base]
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, placeholder: str = PLACEHOLDER) -> DataFrame:
    """`docs` with every secret replaced; overlapping spans become one placeholder. Null texts stay null.

    n_chars, where it is a column, follows the new text; all other columns and all rows stay.
    """

    text = F.col("text")

    def part(span: Column, begin: Column, own: Column) -> Column:
        """The gap before a span, within `own`, which begins at `begin`, and the placeholder; nothing for a span begun in another."""
        gap = F.substring(own, span["at"] - begin + 1, span["start"] - span["at"])
        return F.when(span["start"] < span["at"], F.lit("")).otherwise(F.concat(gap, F.lit(placeholder)))

    def block(spans: Column) -> Column:
        # Counting characters from the text's start for each span would be quadratic: each block has its own stretch.
        begin = spans[0]["at"]
        own = F.substring(text, begin + 1, F.greatest(F.element_at(spans, -1)["start"] - begin, F.lit(0)))
        return _let(own, lambda stretch: F.array_join(F.transform(spans, lambda span: part(span, begin, stretch)), ""))

    def cleaned(at: Column) -> Column:
        spans = F.zip_with("spans", F.slice(at, 1, F.size("spans")), lambda span, before: F.struct(span["start"].alias("start"), before.alias("at")))
        parts = _let(spans, lambda own: F.array_join(_blocks(own, block), ""))
        return F.concat(parts, F.substring(text, F.element_at(at, -1) + 1, F.length(text)))

    furthest = running(F.transform("spans", lambda span: span["end"]), F.greatest)
    clean = F.when(F.size("spans") == 0, text).otherwise(_let(furthest, cleaned))
    out = scan_secrets(docs, rules).withColumn("text", clean)
    if "n_chars" in docs.columns:
        size = F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{name}`") for name in docs.columns])
