import datetime as dt

import pytest
from pyspark.sql import functions as F

from lamina.operators import clean
from lamina.operators.dedup import dedup, duplicate_count
from lamina.operators.retention import retention, retention_pct
from lamina.plans import trips

AT = dt.datetime


def survivors(df):
    return trips.clean_trips(df).count()


def test_five_rows_to_one(trips_df):
    df = trips_df(
        {},
        {"fare_amount": -5.0},
        {"trip_distance": 0.0},
        {"tpep_pickup_datetime": AT(2009, 1, 1, 0, 0), "tpep_dropoff_datetime": AT(2009, 1, 1, 0, 20)},
        {},
    )
    kept = trips.clean_trips(df).collect()
    assert len(kept) == 1
    assert kept[0]["fare_amount"] == 11.6 and kept[0]["trip_distance"] == 2.4
    row = retention(df, trips.rules(df), trips.TRIP_KEY).first()
    assert row.asDict() == {"rows_in": 5, "rows_out": 1, "rows_dropped": 4, "retention_pct": 20.0}


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({"tpep_pickup_datetime": None}, 0),
        ({"tpep_dropoff_datetime": None}, 0),
        ({"fare_amount": None}, 0),
        ({"PULocationID": None}, 0),
        ({"DOLocationID": None}, 0),
        ({"VendorID": None}, 1),
        ({"trip_distance": None}, 0),
        ({"fare_amount": 0.0}, 1),
        ({"fare_amount": 1000.0}, 1),
        ({"fare_amount": 1000.01}, 0),
        ({"fare_amount": float("nan")}, 0),
        ({"trip_distance": 200.0}, 1),
        ({"trip_distance": 200.01}, 0),
        ({"tpep_dropoff_datetime": AT(2026, 5, 14, 19, 30)}, 0),
        ({"tpep_dropoff_datetime": AT(2026, 5, 15, 19, 30)}, 1),
        ({"tpep_dropoff_datetime": AT(2026, 5, 15, 19, 30, 0, 900000)}, 1),
        ({"tpep_dropoff_datetime": AT(2026, 5, 15, 19, 30, 1)}, 0),
    ],
)
def test_limits(trips_df, changes, kept):
    assert survivors(trips_df(changes)) == kept


@pytest.mark.parametrize(
    "pickup, kept",
    [
        (AT(2026, 4, 29, 23, 59, 59), 0),
        (AT(2026, 4, 30, 0, 0), 1),
        (AT(2026, 6, 1, 23, 59, 59), 1),
        (AT(2026, 6, 2, 0, 0), 0),
    ],
)
def test_ingest_window_has_a_day_of_grace(trips_df, pickup, kept):
    df = trips_df({"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": pickup + dt.timedelta(minutes=5)})
    assert survivors(df) == kept


def test_window_crosses_the_year(trips_df):
    pickup = AT(2027, 1, 1, 12)
    df = trips_df(
        {
            "_ingest_month": 12,
            "tpep_pickup_datetime": pickup,
            "tpep_dropoff_datetime": pickup + dt.timedelta(minutes=5),
        }
    )
    assert survivors(df) == 1


def test_window_is_skipped_without_lineage(trips_df):
    old = {"tpep_pickup_datetime": AT(2009, 1, 1), "tpep_dropoff_datetime": AT(2009, 1, 1, 0, 20)}
    assert survivors(trips_df(old).drop("_ingest_month")) == 1


def test_null_passengers_become_one(trips_df):
    assert trips.clean_trips(trips_df({"passenger_count": None})).first()["passenger_count"] == 1
    typed = clean.impute(trips_df({}), trips.DEFAULTS)
    assert dict(typed.dtypes)["passenger_count"] == "int"


def test_nulls_in_keys_are_equal_and_survivor_is_fixed(trips_df):
    df = trips_df({"VendorID": None, "tip_amount": 9.0}, {"VendorID": None, "tip_amount": 2.0})
    for order in (df, df.orderBy(F.desc("tip_amount")), df.repartition(3)):
        kept = trips.clean_trips(order).collect()
        assert [r["tip_amount"] for r in kept] == [2.0]


def test_a_bad_row_does_not_shadow_a_good_one(trips_df):
    kept = trips.clean_trips(trips_df({"trip_distance": 0.0}, {"trip_distance": 9.0})).collect()
    assert [r["trip_distance"] for r in kept] == [9.0]


def test_signed_zeros_are_one_key(spark, tmp_path):
    path = str(tmp_path / "z")
    rows = [(0.0 if i % 2 else -0.0, i, "s") for i in range(40)]
    spark.createDataFrame(rows, "k double, i int, s string").repartition(8).write.parquet(path)
    df = spark.read.parquet(path)
    assert [r["i"] for r in dedup(df, ["k"]).collect()] == [0]
    assert [r["i"] for r in dedup(df.repartition(8), ["s", "k"]).collect()] == [0]


def test_dedup_limits_each_key_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(4).write.parquet(path)
    out = dedup(spark.read.parquet(path), ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2]


def test_cleaning_is_idempotent_and_ignores_copies(trips_df):
    df = trips_df({}, {"fare_amount": 7.0}, {"fare_amount": 7.0, "tip_amount": 1.0}, {"fare_amount": -1.0})
    once = trips.clean_trips(df)
    rows = sorted(map(str, once.collect()))
    assert sorted(map(str, trips.clean_trips(once).collect())) == rows
    assert sorted(map(str, trips.clean_trips(df.unionByName(df)).collect())) == rows


def test_rule_report(trips_df):
    df = trips_df({}, {"fare_amount": None}, {"fare_amount": -1.0}, {"trip_distance": 500.0})
    failed = {r["rule"]: (r["rows"], r["failed"]) for r in clean.rule_report(df, trips.rules(df)).collect()}
    assert failed["required"] == (4, 1)
    assert failed["range(fare_amount)"] == (4, 2)
    assert failed["range(trip_distance)"] == (4, 1)
    assert failed["ordered(tpep_pickup_datetime,tpep_dropoff_datetime)"] == (4, 0)


def test_retention_of_nothing_and_by_group(trips_df):
    df = trips_df({}, {}, {"_ingest_month": 4}, {"fare_amount": 3.0})
    empty = df.filter("false")
    assert retention(empty, trips.rules(empty), trips.TRIP_KEY).first().asDict() == {
        "rows_in": 0,
        "rows_out": 0,
        "rows_dropped": 0,
        "retention_pct": 0.0,
    }
    by_month = retention(df, trips.rules(df), trips.TRIP_KEY, by=["_ingest_year", "_ingest_month"])
    found = {r["_ingest_month"]: (r["rows_in"], r["rows_out"], r["retention_pct"]) for r in by_month.collect()}
    assert found == {4: (1, 0, 0.0), 5: (3, 2, 66.67)}
    assert retention_pct(0, 0) == 0.0 and retention_pct(3, 2) == 66.67


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 1)], "a int, b int")
    assert duplicate_count(df, ["a", "b"]).first()[0] == 2
    assert duplicate_count(df.filter("false"), ["a"]).first()[0] == 0


def test_month_filter_reaches_the_scan(trips_df, spark, tmp_path):
    path = str(tmp_path / "b")
    trips_df({}).write.partitionBy("_ingest_year", "_ingest_month").parquet(path)
    df = spark.read.parquet(path).filter("_ingest_year = 2026 and _ingest_month = 5")
    plan = trips.clean_trips(df)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") :]
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2026-04-30" in scan
    assert "LessThan(tpep_pickup_datetime,2026-06-02" in scan
    assert "LessThanOrEqual(fare_amount,1000.0)" in scan
    assert "_ingest_month" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
