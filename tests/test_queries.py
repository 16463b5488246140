"""Every query against its SQL on the same tables."""

import pytest

from tessera.plans.all_queries import ORACLES, QUERIES
from tests.conftest import rows_of


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    found, expected = QUERIES[name](spark, sf_dir), duck.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows_of(found) == rows_of(expected)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name,table", [("verification_list", "orders"), ("table_ranking", "part")])
def test_no_row_is_left_out(spark, sf_dir, name, table):
    assert QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
