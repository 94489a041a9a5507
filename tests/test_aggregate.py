import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from lamina.functions import exact
from lamina.operators.aggregate import Metric, Summary, count, mean, rollup_for, summarize, summarize_rollup, total
from lamina.plans import trips
from lamina.plans.gold import build

SILVER = (
    "pickup_date date, pickup_hour int, PULocationID int, pickup_zone string, pickup_borough string, "
    "trip_distance double, trip_duration_minutes double, fare_amount double, tip_amount double, "
    "tip_percentage double, total_amount double, payment_type int"
)
DAY = dt.date(2026, 5, 10)
COLUMNS = {
    "gold_daily_zone_trips": [
        "pickup_date", "PULocationID", "pickup_zone", "pickup_borough",
        "trip_count", "avg_fare", "avg_trip_distance", "total_revenue",
    ],
    "gold_hourly_trips": ["pickup_date", "pickup_hour", "trip_count", "avg_fare"],
    "gold_borough_fares": [
        "pickup_borough", "trip_count", "avg_fare", "avg_trip_distance", "avg_duration_minutes",
    ],
    "gold_revenue_trends": ["pickup_date", "trip_count", "total_fare", "total_tips", "total_revenue"],
    "gold_tip_by_payment": ["payment_type", "payment_type_label", "trip_count", "avg_tip_pct"],
}


@pytest.fixture
def silver(spark):
    def build_silver(*extra):
        rows = [
            (DAY, 8, 100, "Garment", "Manhattan", 3.5, 20.0, 15.0, 3.0, 20.0, 19.3, 1),
            (DAY, 9, 100, "Garment", "Manhattan", 1.5, 10.0, 9.0, 0.0, 0.0, 10.8, 2),
            *extra,
        ]
        return spark.createDataFrame(rows, SILVER)

    return build_silver


def both(df, name):
    """The table straight and from the shared rollup, which must agree."""
    direct = [r.asDict() for r in build(df, name).collect()]
    rolled = [r.asDict() for r in summarize_rollup(rollup_for(df, trips.GOLD), trips.GOLD_BY_NAME[name]).collect()]
    assert sorted(map(str, direct)) == sorted(map(str, rolled))
    return direct


def test_columns_and_types(silver):
    for name, columns in COLUMNS.items():
        assert build(silver(), name).columns == columns
    assert dict(build(silver(), "gold_borough_fares").dtypes)["avg_fare"] == "double"
    assert dict(build(silver(), "gold_borough_fares").dtypes)["trip_count"] == "bigint"


def test_borough_fares(silver):
    assert both(silver(), "gold_borough_fares") == [
        dict(pickup_borough="Manhattan", trip_count=2, avg_fare=12.0, avg_trip_distance=2.5, avg_duration_minutes=15.0)
    ]


def test_revenue_trends(silver):
    assert both(silver(), "gold_revenue_trends") == [
        dict(pickup_date=DAY, trip_count=2, total_fare=24.0, total_tips=3.0, total_revenue=30.1)
    ]


def test_daily_zone_trips_with_null_group(silver):
    df = silver((DAY, 8, 7, None, None, 1.0, 1.0, 5.0, 0.0, 0.0, 5.0, 1))
    found = {r["PULocationID"]: r for r in both(df, "gold_daily_zone_trips")}
    assert found[100]["trip_count"] == 2 and found[100]["total_revenue"] == 30.1
    assert found[7]["pickup_borough"] is None and found[7]["avg_fare"] == 5.0


def test_hourly_trips_are_sorted(silver):
    early = (DAY - dt.timedelta(days=1), 23, 1, "z", "b", 1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 1)
    found = [(r["pickup_date"], r["pickup_hour"]) for r in build(silver(early), "gold_hourly_trips").collect()]
    assert found == sorted(found) and len(found) == 3


def test_tip_by_payment_labels(silver):
    df = silver(
        (DAY, 8, 1, "z", "b", 1.0, 1.0, 1.0, None, None, 1.0, 0),
        (DAY, 8, 1, "z", "b", 1.0, 1.0, 1.0, 0.5, 50.0, 1.0, None),
    )
    found = {r["payment_type"]: (r["payment_type_label"], r["avg_tip_pct"]) for r in both(df, "gold_tip_by_payment")}
    assert found == {1: ("Credit card", 20.0), 2: ("Cash", 0.0), 0: (None, None), None: (None, 50.0)}


def test_trip_counts_agree_across_tables(silver):
    df = silver((DAY, 1, 3, "q", None, 1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 5))
    totals = {build(df, t.name).agg(F.sum("trip_count")).first()[0] for t in trips.GOLD}
    assert totals == {3}


def test_exact_means_round_half_up(spark):
    rng = random.Random(7)
    rows = [(i % 400, rng.choice([-1, 1]) * rng.randint(0, 5000) / 100) for i in range(3000)]
    rows += [(1000, 1.00), (1000, 1.01), (1001, -1.00), (1001, -1.01), (1002, None)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(7)
    spec = Summary("t", ("k",), (count("n"), mean("m", "x", 100), total("s", "x", 100), mean("d", "x")))
    out = {r["k"]: r for r in summarize(df, spec).collect()}
    for key in {k for k, _ in rows if k != 1002}:
        values = [Decimal(str(x)) for k, x in rows if k == key]
        expected = (sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert out[key]["m"] == float(expected)
        assert out[key]["s"] == float(sum(values))
    assert out[1000]["m"] == 1.01 and out[1001]["m"] == -1.01
    assert out[1002]["n"] == 1 and out[1002]["m"] is None and out[1002]["s"] is None and out[1002]["d"] is None
    rolled = {r["k"]: r for r in summarize_rollup(rollup_for(df, [spec_exact()]), spec_exact()).collect()}
    assert all(rolled[k]["m"] == out[k]["m"] for k in out)


def spec_exact():
    return Summary("t", ("k",), (count("n"), mean("m", "x", 100)))


def test_wild_values_are_added_as_doubles(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 2.5), (1, 1e20), (2, 1e20), (3, 1.0), (3, nan), (4, -inf), (4, 1.0), (5, 1e8), (5, 0.01), (6, 1e8 + 1.25)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(3)
    spec = Summary("t", ("k",), (mean("m", "x", 100), total("s", "x", 100)))
    for out in (summarize(df, spec), summarize_rollup(rollup_for(df, [spec]), spec)):
        found = {r["k"]: (r["m"], r["s"]) for r in out.collect()}
        assert found[1] == (5e19, 1e20) and found[2] == (1e20, 1e20) and found[4] == (-inf, -inf)
        assert all(math.isnan(v) for v in found[3])
        assert found[5] == (50000000.01, 100000000.01) and found[6] == (100000001.25, 100000001.25)


def test_finer_values_are_added_as_they_are(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.lit(0.00004).alias("x"), F.lit(1.23456).alias("y"))
    spec = Summary("t", ("k",), (total("s", "x", 10_000), mean("m", "y", 10_000, places=5)))
    for out in (summarize(df, spec), summarize_rollup(rollup_for(df, [spec]), spec)):
        assert tuple(out.first())[1:] == (8.0, 1.23456)


def test_sums_of_units_do_not_overflow(spark):
    # As many units as two billion rows at the largest amount have.
    parts = spark.range(2_000).select(F.lit(1).alias("k"), (F.lit(10**16).cast("decimal(18,0)")).alias("u"))
    found = parts.agg(exact.total(F.sum("u"), F.sum(F.lit(None).cast("double")), 10_000, 2)).first()[0]
    assert found == 2e15


def test_durations_are_summed_in_seconds(silver):
    third = (DAY, 8, 7, "z", "Manhattan", 1.0, 1 / 60, 5.0, 0.0, 0.0, 5.0, 1)
    found = both(silver(*[third] * 598), "gold_borough_fares")
    # 30 minutes and 598 seconds over 600 trips: 0.0666 minutes.
    assert found[0]["avg_duration_minutes"] == 0.07


def test_bad_specs(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, x double")
    with pytest.raises(ValueError):
        summarize(df, Summary("a", ("k",), (Metric("m", "median", "x"),)))
    with pytest.raises(ValueError):
        rollup_for(df, [Summary("a", ("k",), (mean("m", "x", 100), mean("d", "x")))])


def test_plans_are_hash_aggregates_with_map_side_partials(silver, spark, tmp_path):
    silver().write.parquet(str(tmp_path / "s"))
    plan = build(spark.read.parquet(str(tmp_path / "s")), "gold_borough_fares")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "partial_sum" in text and "SortAggregate" not in text and text.count("Exchange") == 1
    schema = text[text.index("ReadSchema") :]
    assert "total_amount" not in schema and "pickup_zone" not in schema
