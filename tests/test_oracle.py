"""Every catalogue query against its SQL in DuckDB, on whole tables."""

import pytest
from compare import duck, duck_rows, spark_rows

from weftline import plans

FOLDER = "/root/testdata/sf0.001"
QUERIES = plans.queries()
ORACLE = plans.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, connection, key):
    columns, got = spark_rows(QUERIES[key](spark, FOLDER))
    expected_columns, expected = duck_rows(connection, ORACLE[key])
    assert columns == expected_columns
    assert got == expected
    assert got, "a query over whole tables should give rows"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
