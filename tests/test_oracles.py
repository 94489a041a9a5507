import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert entry.QUERIES.keys() == entry.ORACLES.keys()


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_oracle(spark, connection, name):
    assert difference(entry.queries()[name](spark, SF_DIR), connection, entry.oracle_sql()[name]) is None


def test_results_do_not_depend_on_the_session_zone(spark, connection):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "true")
    try:
        for name in ("derived_columns", "revenue_trend", "lineage_window_filter"):
            problem = difference(entry.queries()[name](spark, SF_DIR), connection, entry.oracle_sql()[name])
            assert problem is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickup_borough", "trip_count", "avg_fare", "avg_trip_distance", "avg_duration_minutes"]
    assert df.count() == 6
