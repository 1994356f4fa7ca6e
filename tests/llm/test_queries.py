"""Registered queries against SQL, and the stages of the pipeline against plain Python."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

import __spark_entry__ as app
import corpus_pipeline
from stoplines.llm import quality, secrets, subword, token_counts
from stoplines.llm.common import string_buffer
from stoplines.llm.lattice import Vocabulary
from stoplines.llm.oracles import ORACLES
from stoplines.llm.queries import QUERIES
from stoplines.storage import materialize
from tests.llm.cases import groups
from tests.llm.test_operators import contamination
from tests.llm.test_text_dedup import shingles
from tests.llm.test_whitening import expected

FOLDER = Path(app.SMOKE_DIR)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="needs the generated tables")


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} == set(app.queries()) - set(app.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, str(FOLDER))
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours = Counter(repr(tuple(r)) for r in df.select(*columns).collect())
    assert ours == Counter(repr(tuple(r)) for r in result.fetchall()) and ours


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(materialize(stage(spark, found[-1], str(FOLDER)), name))
    return found


def texts(df):
    return {row.doc_id: row.text for row in df.collect()}


def test_columns_of_documents_stay(stages):
    assert [df.columns for df in stages[:-1]] == [COLUMNS] * 5
    assert stages[0].dtypes == stages[4].dtypes


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    network = quality.train(stages[0], labels, F.lit(True))
    before = texts(stages[0])
    p = network.probability(*string_buffer(pa.array(list(before.values()), pa.string())))
    assert set(texts(stages[1])) == {i for i, score in zip(before, p, strict=True) if score >= 0.5}


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    sets = {i: shingles(text, 5) for i, text in before.items()}
    links = [
        (i, j) for i in sets for j in sets
        if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    root = groups(links, sets)
    assert set(texts(stages[2])) == {i for i in sets if root[i] == i}


def test_contaminated_documents_go(spark, stages):
    items = [tuple(row) for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select(F.col("item_id").cast("string"), "text").collect()]
    found = contamination([(i, text) for i, text in texts(stages[2]).items()], items, 13)
    assert set(texts(stages[3])) == {key[0] for key in found if not key[-1]}


def test_secrets_are_hidden(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for i, text in before.items():
        spans = sorted(
            m.span() for rule in secrets.RULES
            for m in re.finditer(rule.pattern.removeprefix("(?i)"), text, re.ASCII | (re.I if rule.base and rule.kind == "assign" else 0))
            if len(m.group(rule.value)) >= rule.at_least
        )
        out, at = "", 0
        for start, end in spans:
            if start >= at:
                out += text[at:start] + secrets.PLACEHOLDER
            at = max(at, end)
        assert after[i] == out + text[at:]
    sizes = {row.doc_id: row.n_chars for row in stages[4].collect()}
    assert all(sizes[i] == len(after[i]) for i in after if after[i] != before[i])


def test_pieces_spell_the_texts(stages):
    vocabulary = Vocabulary.load(subword.VOCABULARY)
    after = texts(stages[4])
    rows = stages[5].collect()
    spelled = subword.decoded(pa.array([row.pieces for row in rows], pa.list_(pa.int32())), vocabulary).to_pylist()
    assert {row.doc_id: text for row, text in zip(rows, spelled, strict=True)} == after
    assert all(row.exact for row in rows)


def test_token_counts_equal_the_library(spark):
    library = Library.from_file(token_counts.TOKENIZER)
    library.no_truncation()
    library.no_padding()
    wanted = Counter()
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        wanted[row.doc_id, len((row.text or "").encode()), n, n > 2048] += 1
    found = QUERIES["op12_digest_cache_token_counts"](spark, str(FOLDER))
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    assert Counter(tuple(row) for row in found.collect()) == wanted


def test_whitening_equals_numpy(spark):
    found = QUERIES["op13_chebyshev_whitening"](spark, str(FOLDER))
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    vectors = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    usable = [(i, v) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v)]
    n, deviations, whitened, explained = expected(usable)
    rows = found.collect()
    assert len(rows) == 8 * n and all(row.n == n and row.identity_error < 1e-4 for row in rows)
    for component in range(8):
        own = sorted((row.vec_id, row.deviation, row.whitened) for row in rows if row.component == component + 1)
        wanted = sorted((i, d, w) for (i, _), d, w in zip(usable, deviations, whitened[:, component], strict=True))
        assert [row[:2] for row in own] == [row[:2] for row in wanted]
        assert min(max(abs(a[2] - sign * b[2]) for a, b in zip(own, wanted, strict=True)) for sign in (1, -1)) < 1e-6
        shares = {row.explained for row in rows if row.component == component + 1}
        assert len(shares) == 1 and shares.pop() == pytest.approx(explained[component], rel=1e-6)
