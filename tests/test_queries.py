"""Every registered query against its SQL, and that those without one run."""

import pytest

from kinetrace.plans.queries import ORACLES, QUERIES
from tests.compare import DATA, same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert same(spark, QUERIES[name], ORACLES[name], f"{DATA}/sf0.001") > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
