import pytest
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

# Hundreds of boosting rounds take minutes; they run with ``python tests/oracle_check.py sf0.001 boosted_deep ...``.
SLOW = {"boosted_deep", "boosted_leaf", "train_all"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - SLOW))
def test_query_equals_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark, sf_dir):
    assert {r.section for r in entry(spark).collect()} == {"comparison", "best_model", "importance", "forecast"}
