import datetime as dt

import pytest

from lamina.operators.enrich import DimensionError, Role, enrich
from lamina.plans import trips
from lamina.sources.files import read_csv_table


def test_derived_values(trips_df):
    row = trips.add_derived(trips.clean_trips(trips_df({}))).first()
    assert row["trip_duration_minutes"] == pytest.approx(12.0)
    assert row["trip_speed_mph"] == pytest.approx(12.0)
    assert row["pickup_date"] == dt.date(2026, 5, 14)
    assert row["pickup_hour"] == 19
    assert row["day_of_week"] == "Thursday" and row["is_weekend"] is False
    assert row["tip_percentage"] == pytest.approx(25.0)


def test_derived_types_and_names(trips_df):
    types = dict(trips.add_derived(trips_df({})).dtypes)
    assert {
        "trip_duration_minutes": "double",
        "trip_speed_mph": "double",
        "pickup_date": "date",
        "pickup_hour": "int",
        "day_of_week": "string",
        "is_weekend": "boolean",
        "tip_percentage": "double",
    }.items() <= types.items()


@pytest.mark.parametrize(
    "changes, column, expected",
    [
        ({"fare_amount": 0.0}, "tip_percentage", 0.0),
        ({"fare_amount": None}, "tip_percentage", 0.0),
        ({"tip_amount": None}, "tip_percentage", None),
        ({"tpep_dropoff_datetime": dt.datetime(2026, 5, 10, 8, 0)}, "trip_speed_mph", None),
        ({"tpep_dropoff_datetime": dt.datetime(2026, 5, 10, 7, 0)}, "trip_speed_mph", None),
        ({"tpep_pickup_datetime": dt.datetime(2026, 5, 9, 8, 0)}, "is_weekend", True),
        ({"tpep_pickup_datetime": dt.datetime(2026, 5, 8, 8, 0)}, "is_weekend", False),
        ({"tpep_pickup_datetime": dt.datetime(2026, 5, 8, 8, 0)}, "day_of_week", "Friday"),
    ],
)
def test_derived_edges(trips_df, changes, column, expected):
    assert trips.add_derived(trips_df(changes)).first()[column] == expected


@pytest.fixture
def zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '100,"Manhattan","Garment District","Yellow Zone"\n'
        '132,"Queens","JFK Airport","Airports"\n'
    )
    return read_csv_table(spark, str(path), trips.ZONES)


def test_csv_by_name_with_declared_types(zones):
    assert zones.dtypes == [("LocationID", "int"), ("Borough", "string"), ("Zone", "string")]
    assert zones.count() == 2


def test_two_roles_keep_every_trip(trips_df, zones):
    df = trips_df({}, {"PULocationID": None}, {"PULocationID": 132, "DOLocationID": 100})
    out = trips.add_zones(df, zones)
    found = {
        (r["PULocationID"], r["pickup_borough"], r["pickup_zone"], r["dropoff_borough"], r["dropoff_zone"])
        for r in out.collect()
    }
    assert found == {
        (100, "Manhattan", "Garment District", None, None),
        (None, None, None, None, None),
        (132, "Queens", "JFK Airport", "Manhattan", "Garment District"),
    }
    assert out.columns[:2] == ["DOLocationID", "PULocationID"]


def test_a_repeated_dimension_key_is_rejected(spark, trips_df, zones):
    with pytest.raises(DimensionError, match="1 value"):
        trips.add_zones(trips_df({}), zones.unionByName(zones.filter("LocationID = 100")))
    nulls = spark.createDataFrame([(None, "x", "y"), (None, "x", "y")], trips.ZONES)
    assert trips.add_zones(trips_df({}, {"PULocationID": None}), nulls).count() == 2


def test_only_a_small_dimension_is_broadcast(spark, zones, tmp_path):
    spark.range(1000).selectExpr("cast(id as int) PULocationID").write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    roles = [Role("PULocationID", {"Zone": "pickup_zone"})]

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    small = enrich(facts, zones, "LocationID", roles)
    assert "BroadcastHashJoin" in plan(small) and "LeftOuter" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich(facts, zones, "LocationID", roles, broadcast_limit_bytes=10)
        assert "SortMergeJoin" in plan(large)
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_roles_share_one_broadcast(trips_df, spark, tmp_path):
    spark.createDataFrame([(100, "a", "b"), (200, "c", "d")], "LocationID int, Borough string, Zone string").write.parquet(str(tmp_path / "z"))
    out = trips.add_zones(trips_df({}, {}), spark.read.parquet(str(tmp_path / "z")))
    plan = out._jdf.queryExecution().executedPlan()
    out.collect()
    assert "ReusedExchange" in plan.toString() and plan.toString().count("BroadcastHashJoin") >= 2
