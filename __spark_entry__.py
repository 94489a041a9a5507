"""

The given tables hold no trips, so the trip operators run over a stand-in: one trip per
line item, joined to its order. Its expressions make every rule bite (see TRIPS_SQL, which
states the same view for DuckDB): the key columns follow from (order, line number), which
repeats, while distance, payment and tip differ from copy to copy.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lamina.functions.labels import label  # noqa: E402
from lamina.operators import clean, observe, retention  # noqa: E402
from lamina.operators.aggregate import rollup_for, summarize, summarize_rollup  # noqa: E402
from lamina.operators.conform import MONTH, YEAR, conform, stamp_lineage  # noqa: E402
from lamina.operators.dedup import dedup  # noqa: E402
from lamina.operators.enrich import Role, enrich  # noqa: E402
from lamina.operators.observe import Cleaning  # noqa: E402
from lamina.operators.quality import ERROR, Suite, verdicts  # noqa: E402
from lamina.plans import gold, pipeline, suites, trips  # noqa: E402
from lamina.session import working_folder  # noqa: E402
from lamina.sources import files, sinks  # noqa: E402

PICKUP, DROPOFF = trips.PICKUP, trips.DROPOFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minutes(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), count.cast("int"))


def null_if(column: str, value) -> Column:
    return F.nullif(F.col(column), F.lit(value))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    line, customer = F.col("l_linenumber"), F.col("o_custkey")
    pickup = F.col("o_orderdate") + minutes(customer % 1440)
    landed = F.col("o_orderdate") + F.make_dt_interval(line % 4)
    # Some amounts are no whole number of ten-thousandths, and are to be added as they are.
    fare = F.floor(F.col("o_totalprice") / 4.5 - 2000) / 100.0 + F.when(line == 6, 0.00003).otherwise(0.0)
    tip = F.floor(F.col("l_extendedprice") * F.col("l_discount")) / 100.0 + F.when(line == 5, 0.00004).otherwise(0.0)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        line.alias("VendorID"),
        pickup.alias(PICKUP),
        (pickup + minutes((F.col("l_orderkey") * 13 + line * 37) % 1560 - 60)).alias(DROPOFF),
        F.nullif(line - 1, F.lit(0)).alias("passenger_count"),
        (F.col("l_quantity") * 5 - 10).alias("trip_distance"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        F.nullif(customer % 28, F.lit(27)).alias("PULocationID"),
        ((customer + line) % 28).alias("DOLocationID"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(9).alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        (fare + tip + 2.5).alias("total_amount"),
        F.year(landed).alias(YEAR),
        F.month(landed).alias(MONTH),
    )


def conformed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_trips(spark, sf_dir), trips.CONTRACT, trips.LINEAGE)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")
    )


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.to_silver(conformed_trips(spark, sf_dir), zones(spark, sf_dir))


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less ones, so that a reader's own zone cannot shift them."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


TRIP_COLUMNS = [
    "VendorID", PICKUP, DROPOFF, "passenger_count", "trip_distance", "store_and_fwd_flag", "PULocationID",
    "DOLocationID", "payment_type", "fare_amount", "tip_amount", "total_amount", YEAR, MONTH,
]
DERIVED_COLUMNS = [
    "trip_duration_minutes", "trip_speed_mph", "pickup_date", "pickup_hour", "day_of_week", "is_weekend",
    "tip_percentage",
]
REPORT_COLUMNS = ["suite", "check_no", "expectation", "severity", "success", "observed", "threshold"]

# ---- queries -----------------------------------------------------------------


def scan_profile(spark, sf_dir):
    profiles = [
        files.profile(spark, f"{sf_dir}/{name}.parquet").select(
            F.lit(name).alias("table_name"), "row_count", "column_count"
        )
        for name in ("lineitem", "orders", "events", "documents")
    ]
    return reduce(DataFrame.unionByName, profiles)


def row_count(spark, sf_dir):
    return files.rows_of(table(spark, sf_dir, "lineitem"))


CONFORM_SCHEMA = T.StructType(
    [
        T.StructField("L_ORDERKEY", T.IntegerType()),
        T.StructField("l_linenumber", T.DoubleType()),
        T.StructField("l_quantity", T.IntegerType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_returnflag", T.IntegerType()),
        T.StructField("l_shipdate", T.DateType()),
    ]
)


def conform_schema(spark, sf_dir):
    return conform(table(spark, sf_dir, "lineitem"), CONFORM_SCHEMA, keep=["l_linestatus", "l_unknown"])


def conform_missing_columns(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_clerk", T.StringType()),
            T.StructField("o_shippriority", T.IntegerType()),
            T.StructField("o_orderstatus", T.StringType()),
        ]
    )
    return conform(table(spark, sf_dir, "orders"), schema)


def lineage_stamp(spark, sf_dir):
    stamped = stamp_lineage(table(spark, sf_dir, "events"), 2024, 1)
    return stamped.select(
        "event_id",
        YEAR,
        MONTH,
        F.col("_source_file").endswith(".parquet").alias("has_source_file"),
        F.col("_ingested_at").endswith("+00:00").alias("has_utc_time"),
    )


def impute_default(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", null_if("l_linenumber", 3).alias("line"), null_if("l_returnflag", "N").alias("flag")
    )
    return clean.impute(lines, {"line": 1, "flag": "?"})


def partition_filter(spark, sf_dir):
    landed = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias(YEAR), F.month("o_orderdate").alias(MONTH)
    )
    return files.only_partitions(landed, {YEAR: 1997, MONTH: 3})


def lineage_window_filter(spark, sf_dir):
    landed = F.col("o_orderdate") + F.make_dt_interval((F.col("o_custkey") % 4).cast("int"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("order_date"),
        "o_orderdate",
        F.year(landed).alias(YEAR),
        F.month(landed).alias(MONTH),
    )
    return clean.apply_rules(orders, [clean.ingest_window("o_orderdate", YEAR, MONTH)]).drop("o_orderdate")


def required_not_null(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        null_if("l_linenumber", 3).alias("line"),
        null_if("l_returnflag", "N").alias("flag"),
        null_if("l_discount", 0.0).alias("discount"),
    )
    return clean.apply_rules(lines, [clean.required("line", "flag")])


def range_filter(spark, sf_dir):
    rules = [
        clean.in_range("l_extendedprice", 1000.0, 50000.0),
        clean.in_range("l_quantity", 10, 45, above_low=True),
    ]
    lines = clean.apply_rules(table(spark, sf_dir, "lineitem"), rules)
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def duration_filter(spark, sf_dir):
    df = conformed_trips(spark, sf_dir)
    rules = [clean.ordered(PICKUP, DROPOFF), clean.at_most(PICKUP, DROPOFF, trips.MAX_HOURS * 3600)]
    return wall_clock(clean.apply_rules(df, rules).select("VendorID", PICKUP, DROPOFF, "fare_amount"))


def retention_metrics(spark, sf_dir):
    df = conformed_trips(spark, sf_dir)
    return retention.retention(df, trips.rules(df), trips.TRIP_KEY)


def rule_report(spark, sf_dir):
    df = conformed_trips(spark, sf_dir)
    return clean.rule_report(df, trips.rules(df))


def clean_pipeline(spark, sf_dir):
    return wall_clock(trips.clean_trips(conformed_trips(spark, sf_dir)).select(*TRIP_COLUMNS))


def clean_by_month(spark, sf_dir):
    """Every ingest month cleaned by itself, as a month's run does it."""
    return wall_clock(trips.clean_months(conformed_trips(spark, sf_dir)).select(*TRIP_COLUMNS))


def cleaning_metrics(spark, sf_dir):
    """What a cleaning saw on its way, while its result was written."""
    seen, folder = Cleaning(), working_folder(spark)
    cleaned = trips.clean_trips(conformed_trips(spark, sf_dir), seen)
    cleaned.write.parquet(f"{folder}/clean")
    rows = files.row_count(spark, f"{folder}/clean")
    told = observe.metrics_table(cleaned, seen.metrics())
    return told.withColumn("agrees", F.lit(seen.agrees(files.rows_of(raw_trips(spark, sf_dir)).first()["row_count"], rows)))


def derived_columns(spark, sf_dir):
    df = trips.add_derived(conformed_trips(spark, sf_dir))
    return wall_clock(df.select("VendorID", PICKUP, "fare_amount", "tip_amount", *DERIVED_COLUMNS))


def dim_join_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey") % 28, F.lit(27)).cast("int").alias("location")
    )
    role = Role("location", {"Borough": "borough", "Zone": "zone"})
    return enrich(orders, zones(spark, sf_dir), "LocationID", [role])


def dim_join_two_roles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") % 28).cast("int").alias("PULocationID"),
        (F.col("l_suppkey") % 28).cast("int").alias("DOLocationID"),
    )
    return trips.add_zones(lines, zones(spark, sf_dir))


def dedup_by_keys(spark, sf_dir):
    return wall_clock(dedup(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))


def gold_table(name):
    return lambda spark, sf_dir: summarize(silver_trips(spark, sf_dir), trips.GOLD_BY_NAME[name])


def label_lookup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", label("l_linenumber", trips.PAYMENT_LABELS).alias("label")
    )


def gold_row_counts(spark, sf_dir):
    rollup = rollup_for(silver_trips(spark, sf_dir), trips.GOLD)
    counts = [
        summarize_rollup(rollup, t).agg(F.count(F.lit(1)).alias("row_count"), F.sum("trip_count").alias("trip_count"))
        .select(F.lit(t.name).alias("table_name"), "row_count", "trip_count")
        for t in trips.GOLD
    ]
    return reduce(DataFrame.unionByName, counts)


# ---- queries that write a layer and read it again


def layer_replace(spark, sf_dir):
    """Land every month, replace 1996 by its first months only and 1995 twice; what is there afterwards."""
    layer, raw = f"{working_folder(spark)}/layer", conformed_trips(spark, sf_dir)
    year, by = F.col(YEAR), (YEAR, MONTH)

    def land(df, within):
        return sinks.replace_partitions(sinks.spread_by(df, by), layer, by, within)

    land(raw.withColumn("fare_amount", F.when(year.isin(1995, 1996), -1.0).otherwise(F.col("fare_amount"))), {YEAR: None})
    land(raw.where((year == 1996) & (F.col(MONTH) <= 6)), {YEAR: 1996})
    land(raw.where((year == 1995) & (F.col("VendorID") == 1)), {YEAR: 1995})
    land(raw.where(year == 1995), {YEAR: 1995})
    return wall_clock(spark.read.parquet(layer).select(*TRIP_COLUMNS))


def table_overwrite(spark, sf_dir):
    """A table written twice: the second one's rows and columns, and their number from the footers."""
    path, silver_df = f"{working_folder(spark)}/gold_revenue_trends", silver_trips(spark, sf_dir)
    sinks.overwrite_table(silver_df.select("VendorID", PICKUP), path)
    written = sinks.overwrite_table(summarize(silver_df, trips.GOLD_BY_NAME["gold_revenue_trends"]), path)
    return spark.read.parquet(path).withColumn("rows_written", F.lit(written).cast("long"))


def long_form(table_name: str, df: DataFrame, metrics) -> DataFrame:
    """(table_name, key, metric, value) of a summary table; the key is its other columns as text."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns if c not in metrics]
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(F.lit(table_name).alias("table_name"), F.concat_ws("|", *keys).alias("key"), F.inline(values))


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a table of their own."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gold_incremental(spark, sf_dir):
    """Gold built, then silver changed in one year and grown by another, then gold brought up to date from these alone."""
    folder = working_folder(spark)
    # Tables of their own, so that the rules do not carry the stand-in's expressions into its join, and trips are cleaned once.
    raw = written(onto_month(raw_trips(spark, sf_dir), F.col(YEAR), 5).withColumn(MONTH, F.lit(5)), f"{folder}/raw")
    silver_df = written(trips.to_silver(conform(raw, trips.CONTRACT, trips.LINEAGE), zones(spark, sf_dir)), f"{folder}/all")
    layer, by, year = f"{folder}/silver", trips.SILVER_PARTITIONS, F.col(YEAR)

    def land(df, within):
        sinks.replace_partitions(sinks.spread_by(df, by), layer, by, within)

    land(silver_df.where(year != 1997).withColumn("fare_amount", F.when(year == 1996, 1.0).otherwise(F.col("fare_amount"))), {YEAR: None})
    gold.aggregate(spark, layer, f"{folder}/gold", write_database=False)
    for changed in (1996, 1997):
        land(silver_df.where(year == changed), {YEAR: changed})
    gold.aggregate(spark, layer, f"{folder}/gold", write_database=False)
    tables = [long_form(t.name, spark.read.parquet(f"{folder}/gold/{t.name}"), [m.name for m in t.metrics]) for t in trips.GOLD]
    return reduce(DataFrame.unionByName, tables)


def onto_month(df: DataFrame, year: Column, month: int) -> DataFrame:
    """The trips moved by whole days into one month, which has 31 days, so that a date holds as many as in a monthly file."""
    day = F.make_date(year, F.lit(month), F.dayofmonth(PICKUP))
    shift = F.make_dt_interval(F.date_diff(day, F.to_date(PICKUP)))
    return df.withColumns({c: F.col(c) + shift for c in (PICKUP, DROPOFF)})


def month_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in as one month's raw trips: it spreads over years, and its days are folded onto May 1998."""
    return onto_month(raw_trips(spark, sf_dir), F.lit(1998), 5).drop(YEAR, MONTH)


def month_chain_over(spark: SparkSession, sf_dir: str) -> tuple[pipeline.Chain, dict]:
    folder = working_folder(spark)
    # Copies of a trip in one file, so that the file's name does not decide which of them stays.
    month_of_trips(spark, sf_dir).repartition(*trips.TRIP_KEY).write.parquet(f"{folder}/raw")
    zones(spark, sf_dir).coalesce(1).write.option("header", True).csv(f"{folder}/zones")
    dirs = [f"{folder}/{name}" for name in ("raw", "bronze", "silver", "gold", "zones")]
    chain = pipeline.Chain(spark, 1998, 5, *dirs, write_database=False)
    return chain, chain.run(check=False)


def month_chain(spark, sf_dir):
    """A month's way through bronze, silver and gold: the numbers that the run reports."""
    _, results = month_chain_over(spark, sf_dir)
    found = pipeline.run_metrics(spark, results)
    return found.where("value IS NOT NULL AND metric <> 'source_file_size_mb'").select("layer", "metric", "value")


def dq_gates(spark, sf_dir):
    """Every gate of that run: the verdict on each suite, and its summary."""
    chain, results = month_chain_over(spark, sf_dir)
    return verdicts(chain.report(results))


DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


def schema_drift(spark, sf_dir):
    """A layer each of whose partitions holds files of two types and one that lacks a column, read as one table."""
    layer, by = f"{working_folder(spark)}/layer", [YEAR, MONTH]
    landed = {YEAR: F.year("o_orderdate"), MONTH: F.month("o_orderdate")}
    orders = table(spark, sf_dir, "orders").withColumns(landed).select(*DRIFT_SCHEMA.names, *by)
    third = F.col("o_orderkey") % 3
    old = orders.where(third == 0).withColumns({"o_custkey": F.col("o_custkey").cast("int"), "o_totalprice": F.col("o_totalprice").cast("string")})
    for part in (old, orders.where(third == 1), orders.where(third == 2).drop("o_orderstatus")):
        sinks.spread_by(part, by).write.mode("append").partitionBy(*by).parquet(layer)
    return files.read_conformed(spark, layer, DRIFT_SCHEMA, by)


CSV_COLUMNS = ("c_custkey", "c_name", "c_nationkey")
CSV_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("C_NATIONKEY", T.IntegerType()), T.StructField("c_name", T.StringType())])


def csv_of_customers(spark, sf_dir) -> str:
    """Customers as text lines, of which some lack a field, have one too many, or hold a word for a number."""
    path, key = f"{working_folder(spark)}/customer.csv", F.col("c_custkey")
    nation = F.when(key % 11 == 3, F.lit("unknown")).otherwise(F.col("c_nationkey").cast("string"))
    fields = F.when(key % 5 == 0, F.array(key.cast("string"), "c_name")).when(key % 7 == 0, F.array(key.cast("string"), "c_name", nation, F.lit("x")))
    line = F.array_join(fields.otherwise(F.array(key.cast("string"), "c_name", nation)), ",")
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    return path


def csv_table(spark, sf_dir):
    """The rows of that CSV, and its broken lines as they are."""
    path = csv_of_customers(spark, sf_dir)
    rows = files.read_csv_table(spark, path, CSV_SCHEMA, columns=CSV_COLUMNS)
    lines = files.csv_lines(spark, path, CSV_COLUMNS).where(F.col(files.CORRUPT_LINE).isNotNull())
    broken = lines.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CSV_SCHEMA.fields], F.col(files.CORRUPT_LINE).alias("broken"))
    return rows.withColumn("broken", F.lit(None).cast("string")).unionByName(broken)


def csv_report(spark, sf_dir):
    return files.csv_report(spark, csv_of_customers(spark, sf_dir), CSV_SCHEMA, CSV_COLUMNS)


def layout_audit(spark, sf_dir):
    """A layer by month, to which a year's rows were added beside the layout."""
    layer, landed = f"{working_folder(spark)}/layer", raw_trips(spark, sf_dir)
    sinks.spread_by(landed, (YEAR, MONTH)).write.partitionBy(YEAR, MONTH).parquet(layer)
    landed.where(F.col(YEAR) == 1994).write.parquet(f"{layer}/old")
    return files.layout_audit(spark, layer).select("in_layout", "rows")


def nullable_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumns(
        {"line": null_if("l_linenumber", 3), "flag": null_if("l_returnflag", "N")}
    )


def report(suite: Suite, df: DataFrame) -> DataFrame:
    return suite.report(df).select(*REPORT_COLUMNS)


def dq_not_null(spark, sf_dir):
    suite = Suite("not_null")
    suite.expect_column_values_to_not_be_null("l_orderkey")
    suite.expect_column_values_to_not_be_null("line")
    suite.expect_column_values_to_not_be_null("line", mostly=0.75)
    suite.expect_column_values_to_not_be_null("flag", mostly=0.9, severity="warning")
    return report(suite, nullable_lines(spark, sf_dir))


def dq_between(spark, sf_dir):
    suite = Suite("between")
    suite.expect_column_values_to_be_between("l_quantity", 1, 50)
    suite.expect_column_values_to_be_between("l_extendedprice", 1000, 50000, mostly=0.8)
    suite.expect_column_values_to_be_between("line", min_value=2)
    suite.expect_column_values_to_be_between("l_discount", max_value=0.05, severity="warning")
    return report(suite, nullable_lines(spark, sf_dir))


def dq_in_set(spark, sf_dir):
    suite = Suite("in_set")
    suite.expect_column_values_to_be_in_set("l_linestatus", ["F", "O"])
    suite.expect_column_values_to_be_in_set("flag", ["A", "R"], mostly=0.6)
    suite.expect_column_values_to_be_in_set("line", [1, 2, 4], severity="warning")
    return report(suite, nullable_lines(spark, sf_dir))


def dq_row_count(spark, sf_dir):
    suite = Suite("row_count")
    suite.expect_table_row_count_to_be_between(min_value=1)
    suite.expect_table_row_count_to_be_between(0, 10, severity="warning")
    return report(suite, table(spark, sf_dir, "lineitem"))


def dq_duplicates(spark, sf_dir):
    suite = Suite("duplicates")
    suite.expect_no_exact_duplicate_rows(["l_orderkey", "l_linenumber"])
    suite.expect_no_exact_duplicate_rows(["l_orderkey", "line", "l_partkey", "l_suppkey"], severity=ERROR)
    return report(suite, nullable_lines(spark, sf_dir))


def dq_custom(spark, sf_dir):
    """Type checks, and checks of one's own as aggregate columns; a missing column fails its check only."""
    suite = Suite("custom")
    suite.expect_column_type_to_be("l_orderkey", "bigint")
    suite.expect_column_type_to_be("l_quantity", "int", severity="warning")
    suite.expect_column_type_to_be("l_nowhere", "int")
    suite.expect_column_values_to_not_be_null("l_nowhere", severity="warning")
    largest, lines = F.max("l_quantity"), F.count_if(F.col("l_linenumber") == 1) / F.count(F.lit(1))
    suite.expect_custom("largest quantity", largest <= 50, observed=largest, threshold=50)
    suite.expect_custom("share of first lines", lines >= 0.5, observed=lines, threshold=0.5)
    suite.expect_custom("largest of an unknown column", F.max("l_nowhere") > 0)
    return report(suite, table(spark, sf_dir, "lineitem"))


def dq_retention(spark, sf_dir):
    """Retention of each ingest month against the bounds of the silver gate."""
    df = conformed_trips(spark, sf_dir)
    low, high = (100 * bound for bound in suites.RETENTION_BOUNDS)
    kept = retention.retention(df, trips.rules(df), trips.TRIP_KEY, by=[YEAR, MONTH])
    return kept.withColumn("success", F.col("retention_pct").between(low, high))


def dq_suite_report(spark, sf_dir):
    return report(suites.silver_suite(), silver_trips(spark, sf_dir))


def dq_silver_gate(spark, sf_dir):
    bronze_rows = files.rows_of(raw_trips(spark, sf_dir)).first()["row_count"]
    return report(suites.silver_suite(bronze_rows), silver_trips(spark, sf_dir))


def dq_gold_report(spark, sf_dir):
    """The gates of all five gold tables as one report."""
    rollup = rollup_for(silver_trips(spark, sf_dir), trips.GOLD)
    return reduce(DataFrame.unionByName, [report(suites.gold_suite(t.name), summarize_rollup(rollup, t)) for t in trips.GOLD])


def dq_bronze_report(spark, sf_dir):
    """Raw trips carry no source file here, so that check must fail."""
    return report(suites.bronze_suite(), raw_trips(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_profile": scan_profile,
    "row_count": row_count,
    "conform_schema": conform_schema,
    "conform_missing_columns": conform_missing_columns,
    "lineage_stamp": lineage_stamp,
    "impute_default": impute_default,
    "partition_filter": partition_filter,
    "lineage_window_filter": lineage_window_filter,
    "required_not_null": required_not_null,
    "range_filter": range_filter,
    "duration_filter": duration_filter,
    "retention_metrics": retention_metrics,
    "rule_report": rule_report,
    "clean_pipeline": clean_pipeline,
    "clean_by_month": clean_by_month,
    "cleaning_metrics": cleaning_metrics,
    "layer_replace": layer_replace,
    "table_overwrite": table_overwrite,
    "gold_incremental": gold_incremental,
    "month_chain": month_chain,
    "schema_drift": schema_drift,
    "csv_table": csv_table,
    "csv_report": csv_report,
    "layout_audit": layout_audit,
    "derived_columns": derived_columns,
    "dim_join_left": dim_join_left,
    "dim_join_two_roles": dim_join_two_roles,
    "dedup_by_keys": dedup_by_keys,
    "daily_zone_metrics": gold_table("gold_daily_zone_trips"),
    "hourly_metrics": gold_table("gold_hourly_trips"),
    "region_metrics": gold_table("gold_borough_fares"),
    "revenue_trend": gold_table("gold_revenue_trends"),
    "tip_by_payment": gold_table("gold_tip_by_payment"),
    "label_lookup": label_lookup,
    "gold_row_counts": gold_row_counts,
    "dq_not_null": dq_not_null,
    "dq_between": dq_between,
    "dq_in_set": dq_in_set,
    "dq_row_count": dq_row_count,
    "dq_duplicates": dq_duplicates,
    "dq_custom": dq_custom,
    "dq_retention": dq_retention,
    "dq_suite_report": dq_suite_report,
    "dq_silver_gate": dq_silver_gate,
    "dq_gold_report": dq_gold_report,
    "dq_bronze_report": dq_bronze_report,
    "dq_gates": dq_gates,
}

# ---- oracle SQL --------------------------------------------------------------

TRIPS_SQL = f"""
orders_and_lines AS (
  SELECT *,
    o_orderdate + to_minutes(CAST(o_custkey % 1440 AS INTEGER)) AS pickup,
    CAST((l_orderkey * 13 + l_linenumber * 37) % 1560 - 60 AS INTEGER) AS ride_minutes,
    o_orderdate + to_days(CAST(l_linenumber % 4 AS INTEGER)) AS landed,
    floor(o_totalprice / 4.5::DOUBLE - 2000) / 100.0::DOUBLE + CASE WHEN l_linenumber = 6 THEN 0.00003::DOUBLE ELSE 0 END AS fare,
    floor(l_extendedprice * l_discount) / 100.0::DOUBLE + CASE WHEN l_linenumber = 5 THEN 0.00004::DOUBLE ELSE 0 END AS tip
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
raw_trips AS (
  SELECT
    l_linenumber AS VendorID,
    pickup AS {PICKUP},
    pickup + to_minutes(ride_minutes) AS {DROPOFF},
    nullif(l_linenumber - 1, 0) AS passenger_count,
    l_quantity * 5 - 10 AS trip_distance,
    l_linestatus AS store_and_fwd_flag,
    CAST(nullif(o_custkey % 28, 27) AS INTEGER) AS PULocationID,
    CAST((o_custkey + l_linenumber) % 28 AS INTEGER) AS DOLocationID,
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 9 END AS INTEGER) AS payment_type,
    fare AS fare_amount,
    tip AS tip_amount,
    fare + tip + 2.5::DOUBLE AS total_amount,
    CAST(year(landed) AS INTEGER) AS {YEAR},
    CAST(month(landed) AS INTEGER) AS {MONTH}
  FROM orders_and_lines
)"""

WINDOW_SQL = (
    f"CAST({{time}} AS DATE) >= CAST(make_date({YEAR}, {MONTH}, 1) - INTERVAL 1 DAY AS DATE) "
    f"AND CAST({{time}} AS DATE) < CAST(make_date({YEAR}, {MONTH}, 1) + INTERVAL 1 MONTH + INTERVAL 1 DAY AS DATE)"
)
RULES_SQL = {
    f"ingest_window({PICKUP})": WINDOW_SQL.format(time=PICKUP),
    "required": (
        f"{PICKUP} IS NOT NULL AND {DROPOFF} IS NOT NULL AND fare_amount IS NOT NULL "
        "AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"
    ),
    "range(fare_amount)": "fare_amount >= 0 AND fare_amount <= 1000",
    "range(trip_distance)": "trip_distance > 0 AND trip_distance <= 200",
    f"ordered({PICKUP},{DROPOFF})": f"{DROPOFF} > {PICKUP}",
    f"at_most({PICKUP},{DROPOFF})": f"date_diff('second', {PICKUP}, {DROPOFF}) <= 86400",
}
VALID_SQL = " AND ".join(f"({rule})" for rule in RULES_SQL.values())
KEY_SQL = ", ".join(trips.TRIP_KEY)
CLEAN_SQL = f"""{TRIPS_SQL},
clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count),
      row_number() OVER (
        PARTITION BY {KEY_SQL}
        ORDER BY {YEAR} NULLS FIRST, {MONTH} NULLS FIRST, passenger_count NULLS FIRST, trip_distance NULLS FIRST,
          store_and_fwd_flag NULLS FIRST, payment_type NULLS FIRST, tip_amount NULLS FIRST, total_amount NULLS FIRST
      ) AS rn
    FROM raw_trips WHERE {VALID_SQL}
  ) WHERE rn = 1
)"""

SECONDS_SQL = f"date_diff('second', {PICKUP}, {DROPOFF})"
DERIVED_SQL = f"""
    {SECONDS_SQL} / 60.0::DOUBLE AS trip_duration_minutes,
    CASE WHEN {SECONDS_SQL} > 0 THEN trip_distance / ({SECONDS_SQL} / 3600.0::DOUBLE) END AS trip_speed_mph,
    CAST({PICKUP} AS DATE) AS pickup_date,
    CAST(hour({PICKUP}) AS INTEGER) AS pickup_hour,
    dayname({PICKUP}) AS day_of_week,
    dayofweek({PICKUP}) IN (0, 6) AS is_weekend,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS tip_percentage"""
ZONES_SQL = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone FROM nation JOIN region ON n_regionkey = r_regionkey
)"""
ZONE_JOINS_SQL = """
  LEFT JOIN zones p ON t.PULocationID = p.LocationID
  LEFT JOIN zones d ON t.DOLocationID = d.LocationID"""
ZONE_COLUMNS_SQL = (
    "p.Borough AS pickup_borough, p.Zone AS pickup_zone, d.Borough AS dropoff_borough, d.Zone AS dropoff_zone"
)
SILVER_SQL = f"""{CLEAN_SQL},{ZONES_SQL},
silver AS (
  SELECT t.*, {ZONE_COLUMNS_SQL} FROM (SELECT *, {DERIVED_SQL} FROM clean) t {ZONE_JOINS_SQL}
)"""


def exact_sql(column: str) -> str:
    """Sum of the values as they are, to ten decimals, as a whole number of those."""
    return f"sum(CAST(round({column} * 1e10) AS HUGEINT))"


def total_sql(column: str) -> str:
    """Sum rounded half up to cents (amounts here are not negative)."""
    return f"CAST(({exact_sql(column)} + 50000000) // 100000000 AS DOUBLE) / 100"


def mean_sql(column: str) -> str:
    count = f"count({column})"
    return f"CAST(({exact_sql(column)} + 50000000 * {count}) // (100000000 * {count}) AS DOUBLE) / 100"


MINUTES_SQL = "sum(CAST(trip_duration_minutes AS BIGINT))"
GOLD_SQL = {
    "gold_daily_zone_trips": f"""
  SELECT pickup_date, PULocationID, pickup_zone, pickup_borough, count(*) AS trip_count,
    {mean_sql("fare_amount")} AS avg_fare, {mean_sql("trip_distance")} AS avg_trip_distance,
    {total_sql("total_amount")} AS total_revenue
  FROM silver GROUP BY pickup_date, PULocationID, pickup_zone, pickup_borough""",
    "gold_hourly_trips": f"""
  SELECT pickup_date, pickup_hour, count(*) AS trip_count, {mean_sql("fare_amount")} AS avg_fare
  FROM silver GROUP BY pickup_date, pickup_hour""",
    "gold_borough_fares": f"""
  SELECT pickup_borough, count(*) AS trip_count, {mean_sql("fare_amount")} AS avg_fare,
    {mean_sql("trip_distance")} AS avg_trip_distance,
    CAST((200 * {MINUTES_SQL} + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_duration_minutes
  FROM silver GROUP BY pickup_borough""",
    "gold_revenue_trends": f"""
  SELECT pickup_date, count(*) AS trip_count, {total_sql("fare_amount")} AS total_fare,
    {total_sql("tip_amount")} AS total_tips, {total_sql("total_amount")} AS total_revenue
  FROM silver GROUP BY pickup_date""",
    "gold_tip_by_payment": """
  SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' END AS payment_type_label,
    count(*) AS trip_count, round(avg(tip_percentage), 2) AS avg_tip_pct
  FROM silver GROUP BY payment_type""",
}
NULLABLE_LINES_SQL = (
    "lines AS (SELECT *, nullif(l_linenumber, 3) AS line, nullif(l_returnflag, 'N') AS flag FROM lineitem)"
)


def share_check(name: str, predicate: str, mostly: float = 1.0, severity: str = "error"):
    return name, severity, f"count(*) FILTER (WHERE {predicate}) / count(*)::DOUBLE", f"{{seen}} >= {mostly}", mostly


def not_null_check(column: str, mostly: float = 1.0, severity: str = "error"):
    return share_check(f"expect_column_values_to_not_be_null({column})", f"{column} IS NOT NULL", mostly, severity)


def between_check(column: str, low, high, mostly: float = 1.0, severity: str = "error"):
    bounds = [f"{column} IS NOT NULL"]
    bounds += [f"{column} >= {low}"] if low is not None else []
    bounds += [f"{column} <= {high}"] if high is not None else []
    name = f"expect_column_values_to_be_between({column},{low},{high})"
    return share_check(name, " AND ".join(bounds), mostly, severity)


def in_set_check(column: str, values: str, mostly: float = 1.0, severity: str = "error"):
    return share_check(f"expect_column_values_to_be_in_set({column})", f"{column} IN ({values})", mostly, severity)


def rows_check(low: int, high, severity: str = "error"):
    test = f"{{seen}} >= {low}" + (f" AND {{seen}} <= {high}" if high is not None else "")
    return f"expect_table_row_count_to_be_between({low},{high})", severity, "count(*)::DOUBLE", test, float(low)


def exists_check(column: str, there: bool = True):
    return f"expect_column_to_exist({column})", "error", None, "true" if there else "false", None


def duplicates_check(columns: list[str], severity: str = "warning"):
    distinct = "count(DISTINCT (" + ", ".join(columns) + "))"
    return (
        f"expect_no_exact_duplicate_rows({columns})", severity, f"(count(*) - {distinct})::DOUBLE", "{seen} = 0", 0.0
    )


def report_sql(suite: str, with_sql: str, source: str, checks: list) -> str:
    return f"WITH {with_sql}\n" + checks_sql(suite, source, checks)


def checks_sql(suite: str, source: str, checks: list) -> str:
    """One SELECT per check, each aggregating the source by itself."""
    selects = []
    for number, (name, severity, seen, test, threshold) in enumerate(checks):
        observed = seen or "NULL::DOUBLE"
        bound = "NULL" if threshold is None else threshold
        quoted = name.replace("'", "''")
        selects.append(
            f"SELECT '{suite}' AS suite, {number} AS check_no, '{quoted}' AS expectation, '{severity}' AS severity, "
            f"({test.format(seen='observed')}) AS success, observed, CAST({bound} AS DOUBLE) AS threshold "
            f"FROM (SELECT {observed} AS observed" + (f" FROM {source})" if seen else ")")
        )
    return "\nUNION ALL\n".join(selects)


RETENTION_SQL = f"""
  SELECT {{by}} count(*) AS rows_in,
    count(DISTINCT CASE WHEN valid THEN ({KEY_SQL}) END) AS rows_out
  FROM (SELECT *, coalesce({VALID_SQL}, false) AS valid FROM raw_trips) {{group}}"""
RETENTION_COLUMNS_SQL = (
    "CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out, "
    "CAST(rows_in - rows_out AS BIGINT) AS rows_dropped, "
    "CAST((20000 * rows_out + rows_in) // (2 * rows_in) AS DOUBLE) / 100 AS retention_pct"
)

SILVER_CHECKS = [
    check
    for column in (
        PICKUP, DROPOFF, "fare_amount", "trip_distance", "PULocationID", "DOLocationID", "pickup_date",
        "pickup_borough", "dropoff_borough",
    )
    for check in (exists_check(column), not_null_check(column))
] + [
    between_check("fare_amount", 0, 1000),
    between_check("trip_distance", 0.001, 200),
    between_check("trip_duration_minutes", 0, 1440),
    between_check("passenger_count", 0, 9, 0.999),
    duplicates_check(list(trips.TRIP_KEY), "error"),
    rows_check(1, None),
]
RETENTION_CHECK = (
    "expect_bronze_to_silver_retention_within_bounds", "error", "count(*) / (SELECT count(*) FROM raw_trips)::DOUBLE",
    "{seen} >= 0.8 AND {seen} <= 1.0", 0.8,
)
GOLD_METRICS = {
    "gold_daily_zone_trips": ("trip_count", "avg_fare", "avg_trip_distance", "total_revenue"),
    "gold_hourly_trips": ("trip_count", "avg_fare"),
    "gold_borough_fares": ("trip_count", "avg_fare", "avg_trip_distance", "avg_duration_minutes"),
    "gold_revenue_trends": ("trip_count", "total_fare", "total_tips", "total_revenue"),
    "gold_tip_by_payment": ("trip_count", "avg_tip_pct"),
}
GOLD_KEYS = {
    "gold_daily_zone_trips": ("pickup_date", "PULocationID", "pickup_zone", "pickup_borough"),
    "gold_hourly_trips": ("pickup_date", "pickup_hour"),
    "gold_borough_fares": ("pickup_borough",),
    "gold_revenue_trends": ("pickup_date",),
    "gold_tip_by_payment": ("payment_type", "payment_type_label"),
}


def gold_checks(name: str) -> list:
    return [rows_check(1, None)] + [
        check
        for column in GOLD_METRICS[name]
        for check in (exists_check(column), not_null_check(column), between_check(column, 0, None))
    ]


def bronze_checks(with_file: bool) -> list:
    return [
        *[
            exists_check(column)
            for column in ("VendorID", PICKUP, DROPOFF, "fare_amount", "PULocationID", "DOLocationID", YEAR, MONTH)
        ],
        exists_check("_source_file", there=with_file),
        rows_check(1, None),
        not_null_check(PICKUP, 0.99),
    ]


GOLD_TABLES_SQL = ", ".join(f"{name} AS ({sql})" for name, sql in GOLD_SQL.items())
GOLD_REPORTS = [(f"gold_{name}", name, gold_checks(name)) for name in GOLD_SQL]


def reports_sql(with_sql: str, reports: list) -> str:
    """The reports of several suites, (name, source, checks) each, as one table."""
    return f"WITH {with_sql}\n" + "\nUNION ALL\n".join(checks_sql(*given) for given in reports)


# The stand-in folded onto one month, under the name that the rules and the cleaning look at.
def month_sql(year: str) -> str:
    return f"""{TRIPS_SQL.replace("raw_trips AS", "spread_trips AS")},
shifted AS (SELECT *, to_days(CAST(make_date({year}, 5, CAST(day({PICKUP}) AS INTEGER)) - CAST({PICKUP} AS DATE) AS INTEGER)) AS shift FROM spread_trips),
raw_trips AS (
  SELECT * EXCLUDE (shift) REPLACE ({PICKUP} + shift AS {PICKUP}, {DROPOFF} + shift AS {DROPOFF},
    CAST({year} AS INTEGER) AS {YEAR}, CAST(5 AS INTEGER) AS {MONTH})
  FROM shifted
)"""


MONTH_SILVER_SQL = SILVER_SQL.replace(TRIPS_SQL, month_sql("1998"))
YEARS_SILVER_SQL = SILVER_SQL.replace(TRIPS_SQL, month_sql(YEAR))
DROPS_SQL = f"""
  SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT valid) AS invalid, count(DISTINCT CASE WHEN valid THEN ({KEY_SQL}) END) AS rows_out,
    {", ".join(f"count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS failed{i}" for i, rule in enumerate(RULES_SQL.values()))}
  FROM (SELECT *, coalesce({VALID_SQL}, false) AS valid FROM raw_trips)"""
PCT_SQL = "CAST((20000 * rows_out + rows_in) // (2 * rows_in) AS DOUBLE) / 100"


def metrics_sql(metrics: dict, prefix: str = "") -> str:
    """(metric, value) rows, each an expression over `drops`."""
    told = {**metrics, **{f"failed.{name}": f"failed{i}" for i, name in enumerate(RULES_SQL)}}
    return " UNION ALL ".join(f"SELECT {prefix}'{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM drops" for name, value in told.items())


def long_form_sql(name: str) -> str:
    key = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in GOLD_KEYS[name]) + ")"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {key} AS key, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {name}" for m in GOLD_METRICS[name]
    )


def gold_sql(name: str) -> str:
    return f"WITH {SILVER_SQL} {GOLD_SQL[name]}"


CSV_SQL = """
        WITH said AS (
          SELECT *, c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS whole, concat_ws(',', c_custkey, c_name,
            CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 11 = 3 THEN 'unknown' ELSE c_nationkey::VARCHAR END,
            CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 = 0 THEN 'x' END) AS line
          FROM customer
        )"""

ORACLES: dict[str, str] = {
    "scan_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
        f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS column_count"
        for t in ("lineitem", "orders", "events", "documents")
    ),
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "conform_schema": """
        SELECT CAST(l_orderkey AS INTEGER) AS "L_ORDERKEY", CAST(l_linenumber AS DOUBLE) AS l_linenumber,
          CAST(l_quantity AS INTEGER) AS l_quantity, l_extendedprice, TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag,
          CAST(l_shipdate AS DATE) AS l_shipdate, l_linestatus
        FROM lineitem""",
    "conform_missing_columns": """
        SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_clerk, CAST(NULL AS INTEGER) AS o_shippriority, o_orderstatus
        FROM orders""",
    "lineage_stamp": f"""
        SELECT event_id, CAST(2024 AS INTEGER) AS {YEAR}, CAST(1 AS INTEGER) AS {MONTH},
          true AS has_source_file, true AS has_utc_time
        FROM events""",
    "impute_default": """
        SELECT l_orderkey, l_partkey, coalesce(nullif(l_linenumber, 3), 1) AS line,
          coalesce(nullif(l_returnflag, 'N'), '?') AS flag
        FROM lineitem""",
    "partition_filter": f"""
        SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS {YEAR},
          CAST(month(o_orderdate) AS INTEGER) AS {MONTH}
        FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3""",
    "lineage_window_filter": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, {YEAR}, {MONTH} FROM (
          SELECT *, CAST(year(landed) AS INTEGER) AS {YEAR}, CAST(month(landed) AS INTEGER) AS {MONTH}
          FROM (SELECT *, o_orderdate + to_days(CAST(o_custkey % 4 AS INTEGER)) AS landed FROM orders)
        ) WHERE {WINDOW_SQL.format(time="o_orderdate")}""",
    "required_not_null": """
        SELECT * FROM (
          SELECT l_orderkey, nullif(l_linenumber, 3) AS line, nullif(l_returnflag, 'N') AS flag,
            nullif(l_discount, 0.0) AS discount
          FROM lineitem
        ) WHERE line IS NOT NULL AND flag IS NOT NULL""",
    "range_filter": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
        WHERE l_extendedprice >= 1000 AND l_extendedprice <= 50000 AND l_quantity > 10 AND l_quantity <= 45""",
    "duration_filter": f"""
        WITH {TRIPS_SQL} SELECT VendorID, {PICKUP}, {DROPOFF}, fare_amount FROM raw_trips
        WHERE {DROPOFF} > {PICKUP} AND {SECONDS_SQL} <= 86400""",
    "retention_metrics": f"""
        WITH {TRIPS_SQL} SELECT {RETENTION_COLUMNS_SQL} FROM ({RETENTION_SQL.format(by="", group="")})""",
    "rule_report": f"WITH {TRIPS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS rows, count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS failed "
        "FROM raw_trips"
        for name, rule in RULES_SQL.items()
    ),
    "clean_pipeline": f"WITH {CLEAN_SQL} SELECT {', '.join(TRIP_COLUMNS)} FROM clean",
    "clean_by_month": f"WITH {CLEAN_SQL} SELECT {', '.join(TRIP_COLUMNS)} FROM clean",
    "cleaning_metrics": f"WITH {TRIPS_SQL}, drops AS ({DROPS_SQL}) SELECT *, true AS agrees FROM ("
    + metrics_sql({"rows_in": "rows_in", "invalid": "invalid", "duplicates": "rows_in - invalid - rows_out", "rows_out": "rows_out", "retention_pct": PCT_SQL})
    + ")",
    "layer_replace": f"""WITH {TRIPS_SQL} SELECT {', '.join(TRIP_COLUMNS)} FROM raw_trips WHERE {YEAR} <> 1996 OR {MONTH} <= 6""",
    "table_overwrite": f"WITH {SILVER_SQL}, trend AS ({GOLD_SQL['gold_revenue_trends']}) SELECT *, (SELECT count(*) FROM trend) AS rows_written FROM trend",
    "gold_incremental": f"WITH {YEARS_SILVER_SQL}, {GOLD_TABLES_SQL} " + " UNION ALL ".join(map(long_form_sql, GOLD_SQL)),
    "month_chain": f"WITH {MONTH_SILVER_SQL}, {GOLD_TABLES_SQL}, drops AS ({DROPS_SQL}) "
    + "SELECT 'bronze' AS layer, m.metric, m.value FROM (SELECT unnest([{'metric': 'year', 'value': 1998.0}, {'metric': 'month', 'value': 5.0}, "
    + "{'metric': 'row_count', 'value': (SELECT count(*) FROM raw_trips)}, {'metric': 'column_count', 'value': 12.0}]) AS m) "
    + " UNION ALL "
    + metrics_sql(
        {
            "bronze_rows": "rows_in", "silver_rows": "rows_out", "rows_dropped": "rows_in - rows_out", "retention_pct": PCT_SQL,
            "invalid": "invalid", "duplicates": "rows_in - invalid - rows_out",
        },
        "'silver' AS layer, ",
    )
    + " UNION ALL SELECT 'gold', 'silver_rows', CAST(count(*) AS DOUBLE) FROM silver"
    + "".join(f" UNION ALL SELECT 'gold', 'gold_table_rows.{name}', CAST(count(*) AS DOUBLE) FROM {name}" for name in GOLD_SQL),
    "schema_drift": f"""
        SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS o_orderstatus,
          CAST(year(o_orderdate) AS INTEGER) AS {YEAR}, CAST(month(o_orderdate) AS INTEGER) AS {MONTH}
        FROM orders""",
    "csv_table": f"""{CSV_SQL}
        SELECT CASE WHEN whole THEN c_custkey END AS c_custkey, CASE WHEN whole AND c_custkey % 11 <> 3 THEN CAST(c_nationkey AS INTEGER) END AS C_NATIONKEY,
          CASE WHEN whole THEN c_name END AS c_name, CASE WHEN NOT whole THEN line END AS broken
        FROM said""",
    "csv_report": f"""{CSV_SQL}
        SELECT count(*) AS lines, count(*) FILTER (WHERE NOT whole) AS broken, CAST(0 AS BIGINT) AS unfit_c_custkey,
          count(*) FILTER (WHERE whole AND c_custkey % 11 = 3) AS "unfit_C_NATIONKEY", CAST(0 AS BIGINT) AS unfit_c_name
        FROM said""",
    "layout_audit": f"""WITH {TRIPS_SQL} SELECT true AS in_layout, count(*) AS rows FROM raw_trips
        UNION ALL SELECT false, count(*) FROM raw_trips WHERE {YEAR} = 1994""",
    "derived_columns": f"WITH {TRIPS_SQL} SELECT VendorID, {PICKUP}, fare_amount, tip_amount, {DERIVED_SQL} FROM raw_trips",
    "dim_join_left": f"""
        WITH {ZONES_SQL} SELECT o_orderkey, location, Borough AS borough, Zone AS zone
        FROM (SELECT o_orderkey, CAST(nullif(o_custkey % 28, 27) AS INTEGER) AS location FROM orders)
          LEFT JOIN zones ON location = LocationID""",
    "dim_join_two_roles": f"""
        WITH {ZONES_SQL} SELECT t.*, {ZONE_COLUMNS_SQL} FROM (
          SELECT l_orderkey, l_linenumber, CAST(l_partkey % 28 AS INTEGER) AS PULocationID,
            CAST(l_suppkey % 28 AS INTEGER) AS DOLocationID
          FROM lineitem
        ) t {ZONE_JOINS_SQL}""",
    "dedup_by_keys": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
              l_linestatus, l_shipdate
          ) AS rn FROM lineitem
        ) WHERE rn = 1""",
    "daily_zone_metrics": gold_sql("gold_daily_zone_trips"),
    "hourly_metrics": gold_sql("gold_hourly_trips"),
    "region_metrics": gold_sql("gold_borough_fares"),
    "revenue_trend": gold_sql("gold_revenue_trends"),
    "tip_by_payment": gold_sql("gold_tip_by_payment"),
    "label_lookup": """
        SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
          WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END AS label
        FROM lineitem""",
    "gold_row_counts": f"WITH {SILVER_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM ({sql})"
        for name, sql in GOLD_SQL.items()
    ),
    "dq_not_null": report_sql(
        "not_null",
        NULLABLE_LINES_SQL,
        "lines",
        [
            not_null_check("l_orderkey"),
            not_null_check("line"),
            not_null_check("line", 0.75),
            not_null_check("flag", 0.9, "warning"),
        ],
    ),
    "dq_between": report_sql(
        "between",
        NULLABLE_LINES_SQL,
        "lines",
        [
            between_check("l_quantity", 1, 50),
            between_check("l_extendedprice", 1000, 50000, 0.8),
            between_check("line", 2, None),
            between_check("l_discount", None, 0.05, 1.0, "warning"),
        ],
    ),
    "dq_in_set": report_sql(
        "in_set",
        NULLABLE_LINES_SQL,
        "lines",
        [
            in_set_check("l_linestatus", "'F', 'O'"),
            in_set_check("flag", "'A', 'R'", 0.6),
            in_set_check("line", "1, 2, 4", 1.0, "warning"),
        ],
    ),
    "dq_row_count": report_sql(
        "row_count", NULLABLE_LINES_SQL, "lines", [rows_check(1, None), rows_check(0, 10, "warning")]
    ),
    "dq_duplicates": report_sql(
        "duplicates",
        NULLABLE_LINES_SQL,
        "lines",
        [
            duplicates_check(["l_orderkey", "l_linenumber"]),
            duplicates_check(["l_orderkey", "line", "l_partkey", "l_suppkey"], "error"),
        ],
    ),
    "dq_custom": report_sql(
        "custom",
        NULLABLE_LINES_SQL,
        "lines",
        [
            ("expect_column_type_to_be(l_orderkey,bigint)", "error", None, "true", None),
            ("expect_column_type_to_be(l_quantity,int)", "warning", None, "false", None),
            ("expect_column_type_to_be(l_nowhere,int)", "error", None, "false", None),
            ("expect_column_values_to_not_be_null(l_nowhere)", "warning", None, "false", 1.0),
            ("largest quantity", "error", "max(l_quantity)", "{seen} <= 50", 50.0),
            (
                "share of first lines",
                "error",
                "count(*) FILTER (WHERE l_linenumber = 1) / count(*)::DOUBLE",
                "{seen} >= 0.5",
                0.5,
            ),
            ("largest of an unknown column", "error", None, "false", None),
        ],
    ),
    "dq_retention": f"""
        WITH {TRIPS_SQL} SELECT *, retention_pct >= 80 AND retention_pct <= 100 AS success FROM (
          SELECT {YEAR}, {MONTH}, {RETENTION_COLUMNS_SQL}
          FROM ({RETENTION_SQL.format(by=f"{YEAR}, {MONTH},", group=f"GROUP BY {YEAR}, {MONTH}")})
        )""",
    "dq_suite_report": report_sql("silver_yellow_tripdata", SILVER_SQL, "silver", SILVER_CHECKS),
    "dq_silver_gate": report_sql(
        "silver_yellow_tripdata",
        SILVER_SQL,
        "silver",
        [
            *SILVER_CHECKS,
            RETENTION_CHECK,
        ],
    ),
    "dq_gold_report": reports_sql(f"{SILVER_SQL}, {GOLD_TABLES_SQL}", GOLD_REPORTS),
    "dq_bronze_report": report_sql("bronze_yellow_tripdata", TRIPS_SQL, "raw_trips", bronze_checks(False)),
    "dq_gates": "SELECT *, errors = 0 AS success, suite || ': ' || met || '/' || checks || ' met; errors: ' || errors || ', warnings: ' || warnings AS summary FROM ("
    + "SELECT suite, count(*) AS checks, count(*) FILTER (WHERE success) AS met, "
    + "count(*) FILTER (WHERE NOT success AND severity = 'error') AS errors, count(*) FILTER (WHERE NOT success AND severity = 'warning') AS warnings FROM ("
    + reports_sql(
        f"{MONTH_SILVER_SQL}, {GOLD_TABLES_SQL}",
        [
            ("bronze_yellow_tripdata", "raw_trips", bronze_checks(True)),
            ("silver_yellow_tripdata", "silver", [*SILVER_CHECKS, RETENTION_CHECK]),
            ("silver_overlap", "silver", [duplicates_check(list(trips.TRIP_KEY), "error")]),
            *GOLD_REPORTS,
        ],
    )
    + ") GROUP BY suite)",
}

# ---- contract ----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The whole chain at sf0.001: conform, clean, derive, enrich in two roles, fares by borough."""
    return queries()["region_metrics"](spark, "/root/testdata/sf0.001")


def corpus_queries() -> tuple[dict, dict]:
    """The queries and the SQL of the training-data operators and their pipeline, as far as they are installed."""
    found, sql = {}, {}
    try:
        import lamina.llm.queries as corpus

        found, sql = dict(corpus.QUERIES), dict(corpus.ORACLES)
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError as missing:
        # Without them, or something that they need, the other queries still stand.
        print(f"without the training-data operators: {missing}", file=sys.stderr)
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: in_wall_clock_session(query) for name, query in {**QUERIES, **corpus_queries()[0]}.items()}


def in_wall_clock_session(query):
    """The query with the session zone pinned: trip times are wall clock, see lamina.session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **corpus_queries()[1]}
