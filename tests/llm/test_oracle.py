import oracle
import pytest

from tidemark.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    oracle.check(spark, sf_dir, queries.queries()[name], SQL[name])


def test_ten_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
