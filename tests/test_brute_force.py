"""The trip chain against plain Python on random dirty trips, a third of them copies of one."""

import datetime as dt
import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lamina.operators.enrich import enrich
from lamina.operators.retention import retention
from lamina.plans import suites, trips
from lamina.plans.gold import build
from tests.conftest import GOOD_TRIP

ZONES = [(i, f"borough{i % 3}", f"zone{i}") for i in range(1, 9)]
ORDER = ["_ingest_year", "_ingest_month"] + [
    f.name for f in trips.CONTRACT.fields if f.name not in trips.TRIP_KEY
]


def random_trips(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = dt.datetime(2026, 4, 28) + dt.timedelta(hours=rng.randint(0, 24 * 38), seconds=rng.choice([0, 0, 1800, 3599]))
        ride = dt.timedelta(seconds=rng.choice([0, 60, 1200, 1201, 86400, 86401, -60]) + rng.choice([0, 0, 600]))
        row = dict(
            GOOD_TRIP,
            VendorID=rng.choice([1, 2, None]),
            tpep_pickup_datetime=rng.choice([start, start, start, start, None]),
            tpep_dropoff_datetime=rng.choice([start + ride] * 5 + [None]),
            passenger_count=rng.choice([1, 2, 3, None]),
            trip_distance=rng.choice([0.0, -1.0, 0.01, 3.5, 7.25, 200.0, 200.01, None, float("nan")]),
            PULocationID=rng.choice([1, 2, 3, 9, None]),
            DOLocationID=rng.choice([4, 5, 9]),
            payment_type=rng.choice([0, 1, 2, 6, None]),
            fare_amount=rng.choice([-0.01, 0.0, 10.05, 10.06, 999.99, 1000.0, 1000.01, None, float("nan")]),
            tip_amount=rng.choice([0.0, 1.01, 2.02, None]),
            total_amount=rng.choice([-3.33, 12.34, 56.78]),
            _ingest_month=rng.choice([4, 5]),
        )
        rows.append(row)
    hot = dict(GOOD_TRIP)
    rows += [dict(hot, tip_amount=rng.choice([3.0, 4.0, 5.0]), payment_type=rng.choice([1, 2])) for _ in range(n // 2)]
    rng.shuffle(rows)
    return rows


def kept(row):
    start, end, fare, distance = (
        row[c] for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "trip_distance")
    )
    if None in (start, end, fare, distance, row["PULocationID"], row["DOLocationID"]):
        return False
    month = row["_ingest_month"]
    first, following = dt.datetime(2026, month, 1), dt.datetime(2026, month + 1, 1)
    day = dt.timedelta(days=1)
    seconds = (end - start).total_seconds()
    return (
        first - day <= start < following + day
        and 0 <= fare <= 1000
        and 0 < distance <= 200
        and 0 < seconds <= 86400
    )


def cleaned(rows):
    best = {}
    for row in rows:
        row = dict(row, passenger_count=1 if row["passenger_count"] is None else row["passenger_count"])
        if not kept(row):
            continue
        key = tuple(row[c] for c in trips.TRIP_KEY)
        rank = [(row[c] is not None, row[c]) for c in ORDER]
        if key not in best or rank < best[key][0]:
            best[key] = (rank, row)
    return [row for _, row in best.values()]


def half_up(value: Fraction) -> float:
    cents = math.floor(abs(value) * 100 + Fraction(1, 2))
    return (cents if value >= 0 else -cents) / 100


def exact(x):
    return Fraction(str(x))


def grouped(rows, *keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def average(rows, column):
    values = [exact(r[column]) for r in rows if r[column] is not None]
    return half_up(sum(values) / len(values)) if values else None


def added(rows, column):
    values = [exact(r[column]) for r in rows if r[column] is not None]
    return half_up(sum(values)) if values else None


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = random_trips(request.param)
    types = {f.name: f.dataType.simpleString() for f in trips.CONTRACT.fields}
    ddl = ", ".join(f"`{n}` {types.get(n, 'int')}" for n in GOOD_TRIP)
    df = spark.createDataFrame([tuple(r[n] for n in GOOD_TRIP) for r in rows], ddl).repartition(5).cache()
    zones = spark.createDataFrame(ZONES, trips.ZONES)
    silver = trips.to_silver(df, zones).cache()
    expected = cleaned(rows)
    names = {i: (borough, zone) for i, borough, zone in ZONES}
    for row in expected:
        start, end, fare, tip = (
            row[c] for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "tip_amount")
        )
        row["pickup_date"], row["pickup_hour"] = start.date(), start.hour
        row["pickup_borough"], row["pickup_zone"] = names.get(row["PULocationID"], (None, None))
        row["dropoff_borough"], row["dropoff_zone"] = names.get(row["DOLocationID"], (None, None))
        row["seconds"] = (end - start).total_seconds()
        row["day_of_week"], row["is_weekend"] = start.strftime("%A"), start.weekday() >= 5
        row["tip_percentage"] = 0.0 if fare <= 0 else None if tip is None else tip / fare * 100.0
    yield rows, df, silver, expected
    df.unpersist()
    silver.unpersist()


def test_silver_rows(case):
    _, _, silver, expected = case
    columns = [*GOOD_TRIP, "pickup_date", "pickup_hour", "day_of_week", "is_weekend", "pickup_borough", "pickup_zone",
               "dropoff_borough", "dropoff_zone", "tip_percentage"]
    found = sorted(repr([r[c] for c in columns]) for r in silver.collect())
    assert found == sorted(repr([r[c] for c in columns]) for r in expected)
    assert len(found) > 20
    for r in silver.collect():
        seconds = (r["tpep_dropoff_datetime"] - r["tpep_pickup_datetime"]).total_seconds()
        assert r["trip_duration_minutes"] == seconds / 60.0
        assert r["trip_speed_mph"] == r["trip_distance"] / (seconds / 3600.0)


def test_retention(case):
    rows, df, _, expected = case
    row = retention(df, trips.rules(df), trips.TRIP_KEY).first()
    assert (row["rows_in"], row["rows_out"]) == (len(rows), len(expected))
    by_month = retention(df, trips.rules(df), trips.TRIP_KEY, by=["_ingest_month"])
    for r in by_month.collect():
        mine = [x for x in rows if x["_ingest_month"] == r["_ingest_month"]]
        assert (r["rows_in"], r["rows_out"]) == (len(mine), len(cleaned(mine)))


def test_gold_tables(case):
    _, _, silver, expected = case
    zone_keys = ("pickup_date", "PULocationID", "pickup_zone", "pickup_borough")
    tables = {
        "gold_daily_zone_trips": {
            k: (len(g), average(g, "fare_amount"), average(g, "trip_distance"), added(g, "total_amount"))
            for k, g in grouped(expected, *zone_keys).items()
        },
        "gold_hourly_trips": {
            k: (len(g), average(g, "fare_amount")) for k, g in grouped(expected, "pickup_date", "pickup_hour").items()
        },
        "gold_revenue_trends": {
            k: (len(g), added(g, "fare_amount"), added(g, "tip_amount"), added(g, "total_amount"))
            for k, g in grouped(expected, "pickup_date").items()
        },
    }
    for name, wanted in tables.items():
        width = len(trips.GOLD_BY_NAME[name].by)
        found = {tuple(r)[:width]: tuple(r)[width:] for r in build(silver, name).collect()}
        assert found == wanted, name
    boroughs = {r["pickup_borough"]: r for r in build(silver, "gold_borough_fares").collect()}
    for (borough,), group in grouped(expected, "pickup_borough").items():
        assert boroughs[borough]["avg_fare"] == average(group, "fare_amount")
        minutes = sum(r["seconds"] / 60.0 for r in group) / len(group)
        assert boroughs[borough]["avg_duration_minutes"] == pytest.approx(minutes, abs=0.0051)
    tips = {r["payment_type"]: r for r in build(silver, "gold_tip_by_payment").collect()}
    for (payment,), group in grouped(expected, "payment_type").items():
        shares = [r["tip_percentage"] for r in group if r["tip_percentage"] is not None]
        assert tips[payment]["trip_count"] == len(group)
        assert tips[payment]["payment_type_label"] == trips.PAYMENT_LABELS.get(payment)
        assert tips[payment]["avg_tip_pct"] == pytest.approx(sum(shares) / len(shares), abs=0.0051)


def test_silver_gate(case):
    rows, df, silver, expected = case
    result = {r.name: r for r in suites.silver_suite(len(rows)).run(silver).results}
    named = sum(r["pickup_borough"] is not None for r in expected)
    check = result["expect_column_values_to_not_be_null(pickup_borough)"]
    assert check.observed == named / len(expected) and not check.success
    (copies,) = [r for n, r in result.items() if "duplicate" in n]
    assert copies.success
    dirty = {r.name: r for r in suites.silver_suite().run(df.withColumn("pickup_borough", F.lit("x"))).results}
    keys = {tuple(repr(r[c]) for c in trips.TRIP_KEY) for r in rows}
    (copies,) = [r for n, r in dirty.items() if "duplicate" in n]
    assert copies.observed == len(rows) - len(keys)
    assert "check raised" in dirty["expect_column_values_to_not_be_null(dropoff_borough)"].details


def test_a_hot_key_of_a_large_dimension_is_split(spark, tmp_path):
    conf = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 50 + 100).cast("int"))
        facts = spark.range(0, 200_000, 1, 8).select(hot.alias("PULocationID"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        zones = spark.createDataFrame([(i, "b", f"z{i}") for i in range(120)], trips.ZONES)
        joined = enrich(facts, zones, "LocationID", trips.ZONE_ROLES[:1], broadcast_limit_bytes=0)
        joined.write.parquet(str(tmp_path / "j"))
        counted = spark.read.parquet(str(tmp_path / "j")).groupBy("pickup_zone").count()
        assert counted.filter("pickup_zone = 'z1'").first()["count"] == 66_667
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
