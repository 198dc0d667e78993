"""Every registered query against its SQL on the smallest tables."""

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as contract
import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, name):
    assert compare.difference(spark, SMALL, name) is None


@pytest.mark.parametrize("name", ["als_rmse", "ml_pipeline"])
def test_rows_only(spark, name):
    assert contract.queries()[name](spark, SMALL).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert isinstance(result, DataFrame)
    assert result.count() == 10


@pytest.mark.parametrize("name", ["tumbling_counts_stream", "sliding_top3_live", "station_etl",
                                  "search_heat_by_hour", "search_heat_by_day",
                                  "learning_report_stored", "sliding_top3"])
def test_session_time_zone_does_not_matter(spark, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare.difference(spark, SMALL, name) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
