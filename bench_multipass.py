"""The layer chain done the straightforward way, as a yardstick for bench.py --compare.

Every figure is an action of its own: rows are counted before and after cleaning, each gold
table is cached and counted, silver is cached whole, and each expectation runs its own jobs.
Same rules, same tables; the results must equal those of the library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators.clean import apply_rules, impute
from lamina.operators.conform import conform
from lamina.operators.retention import retention_pct
from lamina.plans import trips


def multipass_chain(spark, root: str, zones_path: str, out: str) -> dict:
    bronze = spark.read.parquet(f"{root}/bronze")
    check_alone(bronze, [trips.PICKUP], [])

    df = conform(bronze, trips.CONTRACT, trips.LINEAGE)
    rows_in = df.count()
    kept = apply_rules(impute(df, trips.DEFAULTS), trips.rules(df)).dropDuplicates(list(trips.TRIP_KEY))
    rows_out = kept.count()
    zones = spark.read.option("header", True).option("inferSchema", True).csv(zones_path)
    enriched = trips.add_derived(kept)
    for key, prefix in (("PULocationID", "pickup"), ("DOLocationID", "dropoff")):
        side = zones.selectExpr(f"LocationID AS {key}", f"Borough AS {prefix}_borough", f"Zone AS {prefix}_zone")
        enriched = enriched.join(F.broadcast(side), key, "left")
    enriched.repartition(8, "pickup_date").write.partitionBy("pickup_date").parquet(f"{out}/silver")

    silver = spark.read.parquet(f"{out}/silver")
    check_alone(
        silver,
        [
            trips.PICKUP, trips.DROPOFF, "fare_amount", "trip_distance", "PULocationID", "DOLocationID",
            "pickup_date", "pickup_borough", "dropoff_borough",
        ],
        [("fare_amount", 0, 1000), ("trip_distance", 0.001, 200), ("trip_duration_minutes", 0, 1440), ("passenger_count", 0, 9)],
        keys=list(trips.TRIP_KEY),
    )

    silver.cache()
    silver.count()
    counts = {}
    for table in trips.GOLD:
        result = plain_summary(silver, table).cache()
        counts[table.name] = result.count()
        result.write.parquet(f"{out}/gold/{table.name}")
        result.unpersist()
    silver.unpersist()
    for table in trips.GOLD:
        names = [m.name for m in table.metrics]
        check_alone(spark.read.parquet(f"{out}/gold/{table.name}"), names, [(n, 0, 10**12) for n in names])
    return {
        "bronze_rows": rows_in,
        "silver_rows": rows_out,
        "rows_dropped": rows_in - rows_out,
        "retention_pct": retention_pct(rows_in, rows_out),
        **counts,
    }


def plain_summary(df, table):
    functions = {"count": lambda _: F.count("*"), "sum": lambda c: F.round(F.sum(c), 2), "mean": lambda c: F.round(F.avg(c), 2)}
    metrics = [functions[m.kind](m.column).alias(m.name) for m in table.metrics]
    result = df.groupBy(*table.by).agg(*metrics)
    return result.orderBy(*table.by) if table.ordered else result


def check_alone(df, not_null, between, keys=None):
    """One count of all rows and one of the passing rows per check."""
    for column in not_null:
        df.count()
        df.filter(F.col(column).isNotNull()).count()
    for column, low, high in between:
        df.count()
        df.filter(F.col(column).between(low, high)).count()
    if keys:
        df.count()
        df.select(*keys).distinct().count()
    df.count()
