"""Every query with SQL equals DuckDB's result on the small test data."""

import datetime
import math
import os

import duckdb
import pytest

from sluice.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def norm(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float) or type(x).__name__ == "Decimal":
        return round(float(x), 6)
    if isinstance(x, datetime.datetime) and x.time() == datetime.time():
        return x.date()
    return x


def rows(found, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in found], key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cur = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.collect(), df.columns) == rows(cur.fetchall(), names)


def test_every_query_has_sql_but_models():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"ml8_gbt_forecast"}
