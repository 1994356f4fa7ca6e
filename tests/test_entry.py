"""Every query against its SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as app

FOLDER = Path(app.SMOKE_DIR)
ORACLES = app.ORACLES

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    assert app.entry(spark).columns == ["date", "avg_delay"]


def test_every_query_has_sql():
    assert set(ORACLES) == set(app.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = app.queries()[name](spark, str(FOLDER))
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours = Counter(repr(tuple(r)) for r in df.select(*columns).collect())
    theirs = Counter(repr(tuple(r)) for r in result.fetchall())
    assert ours == theirs and ours
