"""Every registered query against its SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from roadpulse.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(float(f"{row[i]:.9g}") if isinstance(row[i], float) else row[i]
                         for i in order) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert as_rows(got.columns, got.collect()) == as_rows(columns, result.fetchall())
