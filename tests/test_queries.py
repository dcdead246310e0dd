"""Every registered query against its SQL, run by DuckDB on the same tables."""

import math
import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from workloads.oracles import ORACLES
from workloads.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    return None if value is None else str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shown, key=lambda r: tuple((v is None, v or "") for v in r))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    got_columns, got = table_of(result.columns, [tuple(row) for row in result.collect()])
    cursor = duck.execute(ORACLES[name])
    want_columns, want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got_columns == want_columns
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:5]
    assert got, "no rows"
