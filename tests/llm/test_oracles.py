import pytest

from sluice.llm import queries
from tests.test_oracle import SF, duck, rows  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):  # noqa: F811
    df = queries.queries()[name](spark, SF)
    cur = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.collect(), df.columns) == rows(cur.fetchall(), names)
