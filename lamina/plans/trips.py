"""What is particular to yellow-taxi trips: schema, limits, keys, labels, tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators import clean, derive
from lamina.operators.aggregate import Label, Summary, count, mean, total
from lamina.operators.clean import Rule
from lamina.operators.conform import MONTH, SOURCE_FILE, YEAR
from lamina.operators.dedup import dedup
from lamina.operators.enrich import Role, enrich
from lamina.operators.observe import Cleaning

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

# Column names, types, limits and labels of the published trip data.
CONTRACT = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField(PICKUP, T.TimestampType()),
        T.StructField(DROPOFF, T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)
ZONES = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
    ]
)
MAX_FARE = 1000.0
MAX_DISTANCE = 200.0
MAX_HOURS = 24
DEFAULTS = {"passenger_count": 1}
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

LINEAGE = (YEAR, MONTH, SOURCE_FILE)
_FOR = "_for_month"

# The key of a trip, most selective column first: it leads the sort (see dedup).
TRIP_KEY = (PICKUP, DROPOFF, "fare_amount", "PULocationID", "DOLocationID", "VendorID")

ZONE_ROLES = (
    Role("PULocationID", {"Borough": "pickup_borough", "Zone": "pickup_zone"}),
    Role("DOLocationID", {"Borough": "dropoff_borough", "Zone": "dropoff_zone"}),
)

SILVER_PARTITIONS = (YEAR, MONTH, "pickup_date")

# Amounts are published in cents and distances in hundredths of a mile, and two more decimals are
# still exact; times are to the second.
PER_UNIT, PER_MINUTE = 10_000, 60
_AVG_FARE = mean("avg_fare", "fare_amount", PER_UNIT)
_AVG_DISTANCE = mean("avg_trip_distance", "trip_distance", PER_UNIT)
_REVENUE = total("total_revenue", "total_amount", PER_UNIT)
_TRIPS = count("trip_count")

GOLD = (
    Summary(
        "gold_daily_zone_trips",
        ("pickup_date", "PULocationID", "pickup_zone", "pickup_borough"),
        (_TRIPS, _AVG_FARE, _AVG_DISTANCE, _REVENUE),
    ),
    Summary("gold_hourly_trips", ("pickup_date", "pickup_hour"), (_TRIPS, _AVG_FARE), ordered=True),
    Summary(
        "gold_borough_fares",
        ("pickup_borough",),
        (_TRIPS, _AVG_FARE, _AVG_DISTANCE, mean("avg_duration_minutes", "trip_duration_minutes", PER_MINUTE)),
    ),
    Summary(
        "gold_revenue_trends",
        ("pickup_date",),
        (
            _TRIPS,
            total("total_fare", "fare_amount", PER_UNIT),
            total("total_tips", "tip_amount", PER_UNIT),
            _REVENUE,
        ),
        ordered=True,
    ),
    Summary(
        "gold_tip_by_payment",
        ("payment_type",),
        (_TRIPS, mean("avg_tip_pct", "tip_percentage")),
        label=Label("payment_type", "payment_type_label", PAYMENT_LABELS),
    ),
)
GOLD_BY_NAME = {table.name: table for table in GOLD}


def rules(df: DataFrame) -> list[Rule]:
    """What a trip must meet; the ingest window only where the rows carry their lineage."""
    window = [clean.ingest_window(PICKUP, YEAR, MONTH)] if {YEAR, MONTH} <= set(df.columns) else []
    return [
        *window,
        clean.required(PICKUP, DROPOFF, "fare_amount", "PULocationID", "DOLocationID"),
        clean.in_range("fare_amount", 0, MAX_FARE),
        clean.in_range("trip_distance", 0, MAX_DISTANCE, above_low=True),
        clean.ordered(PICKUP, DROPOFF),
        clean.at_most(PICKUP, DROPOFF, MAX_HOURS * 3600),
    ]


def clean_trips(df: DataFrame, seen: Cleaning | None = None) -> DataFrame:
    """Conformed trips -> valid ones, one per key. Filters come first: only what survives is
    shuffled, and a bad row never stands for a good one. `seen` counts on the way."""
    if seen is not None:
        df = seen.before(df, rules(df))
    kept = dedup(valid_trips(df), TRIP_KEY, order=survivor_order(df))
    return kept if seen is None else seen.after(kept)


def valid_trips(df: DataFrame) -> DataFrame:
    return clean.apply_rules(clean.impute(df, DEFAULTS), rules(df))


def survivor_order(df: DataFrame) -> list[str]:
    """Of trips with one key, which stays: the earliest ingest month's, then by all other columns."""
    lineage = [c for c in LINEAGE if c in df.columns]
    return lineage + [c for c in df.columns if c not in TRIP_KEY and c not in lineage]


def clean_months(df: DataFrame) -> DataFrame:
    """Conformed trips of any number of ingest months -> what cleaning each month by itself keeps, in one job.

    A month's cleaning looks at its own rows and at the days that a neighbour shares with it. So a valid row goes
    to its own month and to a neighbour that it reaches, and the first row of each (month, key) decides; it is
    kept if it is that month's own.
    """
    ingested, day = F.make_date(YEAR, MONTH, F.lit(1)), F.to_date(PICKUP)
    after = F.add_months(ingested, 1)
    reached = F.array_compact(
        F.array(
            ingested,
            F.when(day.between(F.date_sub(ingested, 1), ingested), F.add_months(ingested, -1)),
            F.when(day.between(F.date_sub(after, 1), after), after),
        )
    )
    sent = valid_trips(df).withColumn(_FOR, F.explode(reached))
    first = dedup(sent, [*TRIP_KEY, _FOR], order=survivor_order(df))
    return first.where(F.col(_FOR) == ingested).drop(_FOR)


def month_span(year: int, month: int | None = None) -> tuple[dt.date, dt.date]:
    """First day of an ingest month (or of a year), and of the next."""
    first = dt.date(year, month or 1, 1)
    months = 1 if month else 12
    return first, dt.date(year + (first.month - 1 + months) // 12, (first.month - 1 + months) % 12 + 1, 1)


def shared_days(border: dt.date) -> tuple[dt.date, dt.date]:
    """The days that the ingest months before and after a border may both hold: the last and the first."""
    return border - dt.timedelta(days=1), border


def in_reach(df: DataFrame, year: int, month: int | None = None) -> DataFrame:
    """Of trips of all ingest months, those that decide what a month keeps.

    That is the month itself, and of the month before and after the days that either may share with it.
    """
    first, after = month_span(year, month)
    ingested = F.make_date(YEAR, MONTH, F.lit(1))
    own = (ingested >= F.lit(first)) & (ingested < F.lit(after))

    def at_border(border: dt.date, neighbour: Column) -> Column:
        low, high = shared_days(border)
        return neighbour & (F.col(PICKUP) >= F.lit(low)) & (F.col(PICKUP) < F.lit(high + dt.timedelta(days=1)))

    before = ingested == F.add_months(F.lit(first), -1)
    return df.where(own | at_border(first, before) | at_border(after, ingested == F.lit(after)))


def add_derived(df: DataFrame) -> DataFrame:
    df = derive.add_span_columns(df, PICKUP, DROPOFF, "trip_distance", "trip_duration_minutes", "trip_speed_mph")
    df = derive.add_calendar_columns(df, PICKUP, "pickup")
    return derive.add_percentage(df, "tip_percentage", "tip_amount", "fare_amount")


def add_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    return enrich(df, zones, "LocationID", ZONE_ROLES)


def to_silver(df: DataFrame, zones: DataFrame, seen: Cleaning | None = None) -> DataFrame:
    """Conformed trips -> silver rows."""
    return add_zones(add_derived(clean_trips(df, seen)), zones)
