"""Every query of the engine against its SQL on whole tables."""

import pytest

from terrace.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, rows


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, small, duck, name):
    assert rows(QUERIES[name](spark, small).toPandas()) == rows(duck.sql(ORACLE_SQL[name]).df())


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 400
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
