import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from cairn.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def value(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return ""
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted(columns), sorted(tuple(value(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, FOLDER)
    want = duck.sql(catalog.ORACLE[name])
    assert canonical(found.columns, found.collect()) == canonical(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() >= 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
