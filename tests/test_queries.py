"""Every registered query against its SQL twin, over whole tables."""

import pytest

import __spark_entry__ as entry_points
from convoy.plans import sample_oracle, sample_queries
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES = sample_queries.queries()
ORACLE = sample_oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"model_error", "model_scores"}


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry_has_a_row_per_vehicle(spark):
    assert entry_points.entry(spark).count() == spark.read.parquet(f"{SF_DIR}/customer.parquet").count()
