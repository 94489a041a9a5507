import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from lamina import session
from lamina.operators.quality import DataQualityError, verdicts
from lamina.plans import bronze, check, count_rows, gold, pipeline, silver, suites, trips
from lamina.sources import files, sinks, storage
from tests.conftest import GOOD_TRIP, trip

AT = dt.datetime
ZONES_CSV = (
    "LocationID,Borough,Zone,service_zone\n100,Manhattan,Garment District,Yellow\n200,Bronx,Riverdale,Boro\n"
)
RAW = {k: v for k, v in GOOD_TRIP.items() if not k.startswith("_")}
RAW_DDL = (
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count double, "
    "trip_distance double, RatecodeID int, store_and_fwd_flag string, PULocationID int, DOLocationID int, "
    "payment_type int, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double"
)


class Layers:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.bronze, self.silver, self.gold = (str(root / n) for n in ("bronze", "silver", "gold"))
        self.zones = str(root / "zones.csv")
        (root / "zones.csv").write_text(ZONES_CSV)

    def raw(self, name, *changes, ddl=RAW_DDL):
        rows = [tuple({**RAW, "passenger_count": 2.0, **c}[k] for k in RAW) for c in changes]
        path = str(self.root / f"{name}.parquet")
        self.spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    def ingest(self, month, *changes, year=2026, **kw):
        return bronze.ingest(self.spark, year, month, self.raw(f"raw{year}{month}", *changes, **kw), self.bronze)

    def transform(self, year=None, month=None, **kw):
        return silver.transform(self.spark, self.bronze, self.silver, year, month, self.zones, **kw)

    def silver_rows(self):
        rows = self.spark.read.parquet(self.silver).collect()
        return sorted((r["_ingest_month"], r["tpep_pickup_datetime"], r["fare_amount"]) for r in rows)


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, tmp_path)


def on(day, month=5, hour=8, **changes):
    start = AT(2026, month, day, hour)
    return dict(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + dt.timedelta(minutes=20), **changes)


def test_ingest_lands_a_month_with_lineage(layers, spark):
    meta = layers.ingest(5, on(1), on(2), on(2))
    assert {k: meta[k] for k in ("year", "month", "row_count", "column_count", "source_file")} == dict(
        year=2026, month=5, row_count=3, column_count=18, source_file="raw20265.parquet"
    )
    assert dt.datetime.fromisoformat(meta["ingested_at"]).tzinfo is not None
    df = spark.read.parquet(layers.bronze)
    assert df.count() == 3
    assert set(df.columns) - set(RAW) == {"_ingest_year", "_ingest_month", "_source_file", "_ingested_at"}
    assert dict(df.dtypes)["_ingested_at"] == "string" and dict(df.dtypes)["_ingest_year"] == "int"


def test_ingest_again_replaces_only_its_month(layers, spark):
    layers.ingest(4, on(3, 4))
    layers.ingest(5, on(1), on(2))
    layers.ingest(5, on(1))
    counts = {r[0]: r[1] for r in spark.read.parquet(layers.bronze).groupBy("_ingest_month").count().collect()}
    assert counts == {4: 1, 5: 1}


def test_missing_and_empty_input(layers, spark):
    with pytest.raises(FileNotFoundError):
        bronze.ingest(spark, 2026, 5, str(layers.root / "none.parquet"), layers.bronze)
    layers.ingest(5, on(1))
    with pytest.raises(sinks.EmptyLayerError):
        layers.ingest(5)
    assert spark.read.parquet(layers.bronze).count() == 1


def test_transform_writes_silver(layers, spark):
    layers.ingest(5, on(1), on(1), on(2, fare_amount=-5.0), on(3, passenger_count=None, DOLocationID=9))
    meta = layers.transform(2026, 5)
    failed = meta.pop("failed")
    assert meta == dict(bronze_rows=4, silver_rows=2, rows_dropped=2, retention_pct=50.0, invalid=1, duplicates=1)
    assert {k: v for k, v in failed.items() if v} == {"range(fare_amount)": 1} and len(failed) == 6
    df = spark.read.parquet(layers.silver)
    rows = {r["pickup_date"]: r for r in df.collect()}
    assert rows[dt.date(2026, 5, 1)]["pickup_borough"] == "Manhattan"
    assert rows[dt.date(2026, 5, 1)]["dropoff_zone"] == "Riverdale"
    assert rows[dt.date(2026, 5, 3)]["dropoff_borough"] is None
    assert rows[dt.date(2026, 5, 3)]["passenger_count"] == 1
    assert "_ingested_at" not in df.columns and "_source_file" in df.columns
    directories = storage.matching(spark, f"{layers.silver}/_ingest_year=2026/_ingest_month=5/pickup_date=*")
    assert [d[-10:] for d in directories] == ["2026-05-01", "2026-05-03"]


def test_second_month_keeps_the_first_and_its_last_day(layers):
    layers.ingest(4, on(2, 4), on(30, 4, fare_amount=1.0), on(30, 4, fare_amount=2.0))
    layers.ingest(5, on(1), on(30, 4, fare_amount=3.0))
    layers.transform(2026, 4)
    for _ in range(2):
        assert layers.transform(2026, 5)["silver_rows"] == 2
    fares = [(m, f) for m, _, f in layers.silver_rows()]
    assert sorted(fares) == [(4, 1.0), (4, 2.0), (4, 11.6), (5, 3.0), (5, 11.6)]


def test_a_rerun_drops_partitions_the_new_data_lacks(layers):
    layers.ingest(4, on(2, 4))
    layers.ingest(5, on(1), on(30, 4))
    layers.transform()
    assert len(layers.silver_rows()) == 3
    layers.ingest(5, on(1, fare_amount=8.0))
    assert layers.transform(2026, 5)["silver_rows"] == 1
    assert [(m, f) for m, _, f in layers.silver_rows()] == [(4, 11.6), (5, 8.0)]


TWO_MONTHS = {
    4: [on(2, 4), on(30, 4), on(30, 4, fare_amount=4.0), on(1, 5, hour=3)],
    5: [on(30, 4), on(1, 5, hour=3), on(1, 5, hour=9), on(30, 4, fare_amount=5.0), on(31, 5)],
    6: [on(31, 5), on(1, 6)],
}


@pytest.mark.parametrize("order", [(), (4, 5, 6), (6, 5, 4), (5, 4, 6), (4, 6, 5), (5, 5, 4, 6, 4)])
def test_one_silver_however_the_months_are_run(layers, spark, order):
    for month, rows in TWO_MONTHS.items():
        layers.ingest(month, *rows)
    for month in order:
        layers.transform(2026, month)
    if not order:
        layers.transform()
    found = [(m, t.month, t.day, t.hour, f) for m, t, f in layers.silver_rows()]
    assert sorted(found) == sorted(
        [(4, 4, 2, 8, 11.6), (4, 4, 30, 8, 11.6), (4, 4, 30, 8, 4.0), (4, 5, 1, 3, 11.6)]
        + [(5, 5, 1, 9, 11.6), (5, 4, 30, 8, 5.0), (5, 5, 31, 8, 11.6), (6, 6, 1, 8, 11.6)]
    )
    assert suites.passed(suites.overlap_suite(), silver.around(spark, layers.silver, 2026, 5)).success


@pytest.mark.parametrize("again", [[on(2, 4)], TWO_MONTHS[4] + [on(30, 4, fare_amount=5.0)]])
def test_a_month_that_lands_late_or_anew_changes_the_shared_days_of_the_next(layers, again):
    layers.ingest(5, *TWO_MONTHS[5])
    layers.transform(2026, 5)
    assert [m for m, _, _ in layers.silver_rows()] == [5] * 5
    layers.ingest(4, *TWO_MONTHS[4])
    layers.transform(2026, 4)
    assert [m for m, _, _ in layers.silver_rows()] == [4] * 4 + [5] * 3
    layers.ingest(4, *again)
    layers.transform(2026, 4)
    stepwise = layers.silver_rows()
    layers.transform()
    assert layers.silver_rows() == stepwise and len(stepwise) in (6, 7)


def test_the_gate_sees_a_key_that_two_months_hold(layers, spark):
    layers.ingest(4, on(30, 4))
    layers.transform(2026, 4)
    copy = spark.read.parquet(layers.silver).withColumn("_ingest_month", F.lit(5))
    copy.write.mode("append").partitionBy(*trips.SILVER_PARTITIONS).parquet(layers.silver)
    with pytest.raises(DataQualityError):
        suites.passed(suites.overlap_suite(), silver.around(spark, layers.silver, 2026, 5))


def test_a_month_needs_its_year(layers):
    with pytest.raises(ValueError, match="year"):
        layers.transform(None, 5)


def test_nothing_left_after_cleaning_raises_and_keeps_silver(layers):
    layers.ingest(5, on(1))
    layers.transform(2026, 5)
    layers.ingest(5, on(1, fare_amount=-1.0))
    with pytest.raises(sinks.EmptyLayerError):
        layers.transform(2026, 5)
    assert len(layers.silver_rows()) == 1


def test_months_with_different_types_are_read_together(layers, spark):
    layers.ingest(4, on(2, 4))
    drifted = RAW_DDL.replace("passenger_count double", "passenger_count bigint").replace("VendorID int", "VendorID bigint")
    layers.ingest(5, on(1, passenger_count=3), on(2, passenger_count=4), ddl=drifted)
    df = files.read_conformed(spark, layers.bronze, trips.CONTRACT, trips.LINEAGE)
    assert sorted(r["passenger_count"] for r in df.collect()) == [2, 3, 4]
    assert layers.transform()["silver_rows"] == 3
    one = files.read_conformed(spark, layers.bronze, trips.CONTRACT, trips.LINEAGE, only={"_ingest_month": 5})
    assert one.count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_conformed(spark, layers.bronze, trips.CONTRACT, only={"_ingest_month": 7})


def test_same_types_make_one_scan(layers, spark):
    for month in (3, 4, 5):
        layers.ingest(month, on(2, month))
    plan = files.read_conformed(spark, layers.bronze, trips.CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_strict_mode_fails_on_a_bad_value(layers):
    layers.ingest(5, on(1, store_and_fwd_flag="N", fare_amount="x"), ddl=RAW_DDL.replace("fare_amount double", "fare_amount string"))
    with pytest.raises(Exception, match="fare_amount"):
        layers.transform(2026, 5, mode="strict")


def test_layout_audit_and_strays(layers, spark, caplog):
    layers.ingest(5, on(1), on(2))
    assert files.stray_entries(spark, layers.bronze) == []
    spark.createDataFrame([tuple(trip()[k] for k in RAW)], RAW_DDL.replace("passenger_count double", "passenger_count int")).coalesce(1).write.parquet(
        f"{layers.bronze}/year=2026"
    )
    assert [s.rsplit("/", 1)[-1] for s in files.stray_entries(spark, layers.bronze)] == ["year=2026"]
    found = {r["in_layout"]: (r["files"], r["rows"]) for r in files.layout_audit(spark, layers.bronze).collect()}
    assert found == {True: (1, 2), False: (1, 1)}
    month = f"{layers.bronze}/_ingest_year=2026/_ingest_month=5"
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(f"{layers.bronze}/old/bronze/_ingest_year=2026/_ingest_month=4")
    for place in (f"{month}/notes.txt", f"{layers.bronze}/readme.txt", f"{month}/.hidden"):
        with open(place, "w") as file:
            file.write("no table")
    open(f"{month}/nothing.parquet", "w").close()
    spark.createDataFrame([], "a int").coalesce(1).write.parquet(f"{layers.bronze}/none")
    found = {r["in_layout"]: (r["files"], r["rows"]) for r in files.layout_audit(spark, layers.bronze).collect()}
    strays = len([f for d in ("old/bronze/_ingest_year=2026/_ingest_month=4", "none") for f in os.listdir(f"{layers.bronze}/{d}") if f.endswith(".parquet")])
    assert strays == 2 and found == {True: (2, 2), False: (4, 2)}
    with caplog.at_level("WARNING"):
        layers.ingest(5, on(1))
    assert "outside the partition layout" in caplog.text


def test_audit_of_a_root_with_odd_characters(layers, spark):
    layers.ingest(5, on(1), on(2))
    odd = layers.root / "a b+c%20é"
    shutil.copytree(layers.bronze, odd)
    assert [tuple(r) for r in files.layout_audit(spark, str(odd)).collect()] == [(True, 1, 2)]


def test_files_with_different_columns_land_whole(layers, spark):
    raw = layers.root / "raw_dir"
    columns = [c for c in RAW_DDL.split(", ")]
    for name, ddl in (("a", ", ".join(columns)), ("b", ", ".join([*columns, "cbd_fee double"]))):
        row = tuple({**RAW, "passenger_count": 2.0}[k] for k in RAW) + ((1.5,) if name == "b" else ())
        spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").parquet(str(raw))
    meta = bronze.ingest(spark, 2026, 5, str(raw), layers.bronze)
    landed = spark.read.parquet(layers.bronze)
    assert sorted(str(r.cbd_fee) for r in landed.collect()) == ["1.5", "None"]
    assert (meta["row_count"], meta["column_count"]) == (2, 19)
    spark.createDataFrame([("x",)], "cbd_fee string").write.mode("append").parquet(str(raw))
    with pytest.raises(Exception, match="cbd_fee"):
        bronze.ingest(spark, 2026, 5, str(raw), layers.bronze)


def test_profile_sees_empty_files(layers, spark):
    path = layers.raw("p", on(1))
    spark.createDataFrame([], RAW_DDL).coalesce(1).write.mode("append").parquet(path)
    row = files.profile(spark, path).first()
    assert row["row_count"] == 1 and row["file_count"] == len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 2


def test_profile_and_counts(layers, spark):
    path = layers.raw("p", on(1), on(2))
    row = files.profile(spark, path).first()
    assert (row["row_count"], row["column_count"], row["file_count"]) == (2, 18, 1)
    assert row["size_mb"] == pytest.approx(storage.size_bytes(spark, path) / 1e6, abs=0.01)
    assert files.row_count(spark, path) == 2
    schema = files.profile(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in schema
    layers.ingest(5, on(1))
    assert files.row_count(spark, layers.bronze, {"_ingest_month": 4}) == 0


def test_partition_filter_prunes(layers, spark):
    layers.ingest(4, on(1, 4))
    layers.ingest(5, on(1))
    df = files.only_partitions(spark.read.parquet(layers.bronze), {"_ingest_year": 2026, "_ingest_month": 5})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "(_ingest_month" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert files.only_partitions(df, {"_ingest_year": None}).count() == 1


def test_spread_by(spark):
    df = spark.range(100).withColumn("d", F.col("id") % 20)
    plan = sinks.spread_by(df, ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_a_hot_output_partition_is_split(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40)
    df = spark.range(0, 200_000, 1, 8).select(hot.alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.spread_by(df, ["d"]).write.partitionBy("d").parquet(str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    hot_files, cold_files = (len(list(tmp_path.glob(f"t/d={d}/*.parquet"))) for d in (0, 7))
    assert hot_files > cold_files
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_gold_tables(layers, spark):
    layers.ingest(5, on(1, hour=8), on(1, hour=9, payment_type=2, tip_amount=0.0), on(2))
    layers.transform(2026, 5)
    meta = gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
    assert meta == {
        "silver_rows": 3,
        "gold_table_rows": {
            "gold_daily_zone_trips": 2,
            "gold_hourly_trips": 3,
            "gold_borough_fares": 1,
            "gold_revenue_trends": 2,
            "gold_tip_by_payment": 2,
        },
    }
    silver_df = spark.read.parquet(layers.silver)
    for table in trips.GOLD:
        written = spark.read.parquet(f"{layers.gold}/{table.name}")
        assert written.columns == table.columns
        assert sorted(map(str, written.collect())) == sorted(map(str, gold.build(silver_df, table.name).collect()))
    assert gold.aggregate(spark, layers.silver, layers.gold, write_database=False) == meta


def test_database_write_is_asked_for_with_the_right_options(layers, spark, monkeypatch):
    layers.ingest(5, on(1))
    layers.transform(2026, 5)
    monkeypatch.delenv("POSTGRES_PASSWORD", raising=False)
    with pytest.raises(KeyError):
        gold.aggregate(spark, layers.silver, layers.gold)
    assert not storage.exists(spark, layers.gold)
    monkeypatch.setenv("POSTGRES_PASSWORD", "secret")
    monkeypatch.setenv("POSTGRES_USER", "writer")
    calls = []
    monkeypatch.setattr(sinks, "write_jdbc", lambda df, options: calls.append((df.count(), options)))
    gold.aggregate(spark, layers.silver, layers.gold)
    assert [c[1]["dbtable"] for c in calls] == [t.name for t in trips.GOLD]
    assert all(n == 1 for n, _ in calls)


def test_jdbc_options():
    env = {"POSTGRES_PASSWORD": "p", "POSTGRES_HOST": "h", "POSTGRES_PORT": "1", "POSTGRES_GOLD_DB": "d", "POSTGRES_USER": "u"}
    assert sinks.jdbc_options("t", env) == {
        "url": "jdbc:postgresql://h:1/d",
        "dbtable": "t",
        "user": "u",
        "password": "p",
        "driver": "org.postgresql.Driver",
    }
    assert sinks.jdbc_options("t", {"POSTGRES_PASSWORD": "p", "POSTGRES_USER": "u"})["url"] == "jdbc:postgresql://postgres:5432/gold"
    with pytest.raises(KeyError):
        sinks.jdbc_options("t", {})


class KeepOpen:
    """The test session in place of a job's own, which would be stopped at its end."""

    def __init__(self, spark):
        self._spark = spark

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def stop(self):
        pass


def month_of_trips(rows=60):
    good = [
        on(1 + i % 28, hour=i % 24, PULocationID=100, DOLocationID=200, payment_type=1 + i % 3, fare_amount=5.0 + i / 10)
        for i in range(rows)
    ]
    return [*good, {**good[0], "fare_amount": -5.0}, {**good[1], "trip_distance": 0.0}]


def test_whole_chain_and_its_commands(layers, spark, monkeypatch, capsys, caplog):
    monkeypatch.setattr(session, "get_spark", lambda _name: KeepOpen(spark))
    path = layers.raw("month", *month_of_trips())
    dirs = ["--bronze-dir", layers.bronze, "--silver-dir", layers.silver, "--gold-dir", layers.gold, "--zones", layers.zones]
    with caplog.at_level("INFO"):
        pipeline.main(["--year", "2026", "--month", "5", "--input", path, "--no-postgres", *dirs])
    text = [r.getMessage() for r in caplog.records if r.getMessage().startswith("all layers of 2026-05")][0]
    result = json.loads(text.split("\n", 1)[1])
    told = {k: v for k, v in result["silver"].items() if k != "failed"}
    assert told == dict(bronze_rows=62, silver_rows=60, rows_dropped=2, retention_pct=96.77, invalid=2, duplicates=0)
    assert {k: v for k, v in result["silver"]["failed"].items() if v} == {"range(fare_amount)": 1, "range(trip_distance)": 1}
    assert result["gold"]["silver_rows"] == 60

    bronze.main(["--year", "2026", "--month", "5", "--input", path, "--bronze-dir", layers.bronze])
    silver.main(["--year", "2026", "--month", "5", *dirs[:4], "--zones", layers.zones])
    gold.main(["--no-postgres", *dirs[2:6]])
    count_rows.main(["--path", layers.bronze])
    assert capsys.readouterr().out.strip().splitlines()[-1] == "62"

    check.main(["--layer", "bronze", "--path", layers.bronze])
    check.main(["--layer", "silver", "--path", layers.silver, "--bronze-row-count", "62", "--year", "2026", "--month", "5"])
    check.main(["--layer", "gold", "--path", f"{layers.gold}/gold_borough_fares", "--table-name", "gold_borough_fares"])
    assert "ok  expect_bronze_to_silver_retention_within_bounds: kept 60 of 62 bronze rows" in capsys.readouterr().out
    with pytest.raises(SystemExit) as stopped:
        check.main(["--layer", "silver", "--path", layers.silver, "--bronze-row-count", "1000"])
    assert stopped.value.code == 1
    with pytest.raises(SystemExit):
        check.main(["--layer", "gold", "--path", layers.gold])


def test_a_failed_gate_stops_the_chain(layers, spark):
    path = layers.raw("bad", on(1, DOLocationID=9), on(2))
    with pytest.raises(DataQualityError, match="dropoff_borough"):
        pipeline.run(spark, 2026, 5, path, layers.bronze, layers.silver, layers.gold, layers.zones, write_database=False)
    assert not storage.exists(spark, layers.gold)
    result = pipeline.run(
        spark, 2026, 5, path, layers.bronze, layers.silver, layers.gold, layers.zones, write_database=False, check=False
    )
    assert result["gold"]["gold_table_rows"]["gold_borough_fares"] == 1


def test_a_second_month_reads_only_its_own_silver(layers, spark):
    layers.ingest(4, *TWO_MONTHS[4])
    layers.transform(2026, 4)
    gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
    assert gold.stale_partitions(spark, layers.silver, layers.gold)[:2] == ([], [])
    layers.ingest(5, *TWO_MONTHS[5])
    layers.transform(2026, 5)
    stale, gone, _ = gold.stale_partitions(spark, layers.silver, layers.gold)
    assert len(stale) == 3 and not gone and all(d.startswith("_ingest_year=2026/_ingest_month=5/") for d in stale)
    meta = gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
    silver_df = spark.read.parquet(layers.silver)
    assert meta["silver_rows"] == silver_df.count() == 7
    for table in trips.GOLD:
        written = spark.read.parquet(f"{layers.gold}/{table.name}").collect()
        assert sorted(map(str, written)) == sorted(map(str, gold.build(silver_df, table.name).collect()))
    layers.ingest(5, on(31, 5))
    layers.transform(2026, 5)
    assert gold.aggregate(spark, layers.silver, layers.gold, write_database=False)["silver_rows"] == 5


def test_run_metrics_is_a_table(spark):
    results = {"bronze": {"row_count": 3, "source_file": "x"}, "gold": {"gold_table_rows": {"t": 2}, "none": None}}
    rows = sorted(tuple(r) for r in pipeline.run_metrics(spark, results).collect())
    assert rows == [
        ("bronze", "row_count", 3.0, None), ("bronze", "source_file", None, "x"), ("gold", "gold_table_rows.t", 2.0, None),
        ("gold", "none", None, None),
    ]


def test_the_shuffle_width_follows_each_stage(layers, spark, monkeypatch):
    with session.shuffle_sized_for(spark, 10**15) as width:
        assert width == 4  # the tests' session was given one
    monkeypatch.setattr(session, "_given", lambda *_: False)
    key, before, seen = session.SHUFFLE_PARTITIONS, spark.conf.get(session.SHUFFLE_PARTITIONS), []
    layers.ingest(5, on(1))
    written = sinks.replace_partitions
    monkeypatch.setattr(sinks, "replace_partitions", lambda *a, **k: (seen.append(int(spark.conf.get(key))), written(*a, **k))[1])
    try:
        spark.conf.set(key, "7")
        layers.transform(2026, 5)  # set on the session: kept
        spark.conf.set(key, session.DEFAULT_SHUFFLE_PARTITIONS)
        monkeypatch.setattr(files, "layer_bytes", lambda *_: 10**10)
        layers.transform(2026, 5)
        monkeypatch.setattr(files, "layer_bytes", lambda *_: 1000)
        gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
        assert spark.conf.get(key) == session.DEFAULT_SHUFFLE_PARTITIONS
        with session.shuffle_sized_for(spark, 10**14) as width:
            assert width == 745_059
    finally:
        spark.conf.set(key, before)
    assert seen == [7, 75, spark.sparkContext.defaultParallelism]


def days_held(spark, root):
    """(month, day) -> what the rows there say, as a reader finds it now."""
    try:
        rows = spark.read.parquet(root).select("_ingest_month", "pickup_date", "v").distinct().collect()
    except Exception:
        return None
    return {(r[0], r[1]): r[2] for r in rows}


def layer_of(spark, month_days, v):
    return spark.createDataFrame([(2026, m, d, v) for m, d in month_days], "_ingest_year int, _ingest_month int, pickup_date int, v string")


def test_a_reader_never_sees_old_and_new_days_of_a_month(spark, tmp_path, monkeypatch):
    root, by, seen = str(tmp_path / "layer"), ("_ingest_year", "_ingest_month", "pickup_date"), []
    old = [(5, d) for d in range(1, 6)] + [(6, 1), (6, 2)]
    sinks.replace_partitions(layer_of(spark, old, "old"), root, by, {"_ingest_year": None})
    move = storage.move

    def watched(*args):
        seen.append(days_held(spark, root))
        move(*args)
        seen.append(days_held(spark, root))

    monkeypatch.setattr(storage, "move", watched)
    new = [(5, d) for d in range(3, 9)] + [(6, 1)]
    within = {"_ingest_year": 2026, "_ingest_month": 5}
    rows = sinks.replace_partitions(layer_of(spark, new, "new"), root, by, within, also=[{**within, "_ingest_month": 6, "pickup_date": 1}])
    assert rows == 6 and len(seen) == 8
    for state in seen:
        assert {v for (m, _), v in state.items() if m == 5} in ({"old"}, {"new"}, set())
    assert days_held(spark, root) == {**{(5, d): "new" for d in range(3, 9)}, (6, 1): "new", (6, 2): "old"}
    assert [p for p in os.listdir(root) if p.startswith("_staged")] == []


def test_a_failed_rename_brings_the_old_month_back(spark, tmp_path, monkeypatch):
    root, by, within = str(tmp_path / "layer"), ("_ingest_year", "_ingest_month", "pickup_date"), {"_ingest_year": 2026, "_ingest_month": 5}
    sinks.replace_partitions(layer_of(spark, [(5, 1)], "old"), root, by, within)
    move, moves = storage.move, []

    def failing(session, source, target):
        moves.append(source)
        if len(moves) == 2:
            raise OSError("no")
        move(session, source, target)

    monkeypatch.setattr(storage, "move", failing)
    with pytest.raises(OSError):
        sinks.replace_partitions(layer_of(spark, [(5, 2)], "new"), root, by, within)
    assert days_held(spark, root) == {(5, 1): "old"}


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    root, by, within = str(tmp_path / "layer"), ("_ingest_year", "_ingest_month", "pickup_date"), {"_ingest_year": 2026, "_ingest_month": 5}
    sinks.replace_partitions(layer_of(spark, [(5, 1)], "old"), root, by, within)
    broken = layer_of(spark, [(5, 2)], "new").withColumn("v", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        sinks.replace_partitions(broken, root, by, within)
    assert days_held(spark, root) == {(5, 1): "old"} and os.listdir(root) == ["_ingest_year=2026"]


def calls_of(spark, action):
    """How often the driver's Python asks the JVM while the action runs."""
    client, n = spark.sparkContext._gateway._gateway_client, [0]
    send = client.send_command

    def counted(command, *args, **kwargs):
        n[0] += not command.startswith("m\n")  # but for objects let go, whenever that is
        return send(command, *args, **kwargs)

    client.send_command = counted
    try:
        action()
    finally:
        client.send_command = send
    return n[0]


def test_listing_makes_no_call_for_a_file(spark, tmp_path):
    roots = {}
    for n in (3, 300):
        roots[n] = tmp_path / f"files{n}"
        month = roots[n] / "_ingest_year=2026" / "_ingest_month=5"
        month.mkdir(parents=True)
        for i in range(n):
            (month / f"f{i}.parquet").write_text("x")

    def audit(root):
        with storage.listing(spark):
            rows = storage.file_table(spark, root).groupBy("directory").agg(F.count("*"), F.sum("bytes")).collect()
        assert [r[0] for r in rows] == ["_ingest_year=2026/_ingest_month=5"]
        storage.matching(spark, f"{root}/*/*/*")
        gold.partition_files(spark, root)

    few, many = (calls_of(spark, lambda n=n: audit(str(roots[n]))) for n in (3, 300))
    assert abs(many - few) <= 5 < few
    assert len(storage.matching(spark, f"{roots[300]}/*/*/*")) == 300


def test_files_by_directory(spark, tmp_path):
    for name in ("a=1/x.parquet", "a=1/_SUCCESS", "a=1/.x.crc", "_tmp/y.parquet", "_k=2/z e%é.parquet", "top.parquet"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("abc")
    found = sorted((r["directory"], r["name"], r["bytes"]) for r in storage.file_table(spark, str(tmp_path)).collect())
    assert found == [("", "top.parquet", 3), ("_k=2", "z e%é.parquet", 3), ("a=1", "x.parquet", 3)]
    assert [(r["directory"], r["name"]) for r in storage.file_table(spark, str(tmp_path / "top.parquet")).collect()] == [("", "top.parquet")]
    assert storage.file_table(spark, str(tmp_path / "none")).count() == 0


def test_a_rollup_of_another_definition_is_made_again(layers, spark, monkeypatch):
    layers.ingest(5, *TWO_MONTHS[5])
    layers.transform(2026, 5)
    gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
    assert gold.stale_partitions(spark, layers.silver, layers.gold)[:2] == ([], [])
    fares = trips.Summary("gold_max", ("pickup_date",), (trips.total("total_tolls", "tolls_amount", 100),))
    coarser = [
        trips.Summary(t.name, t.by, tuple(m if m.per != 10_000 else type(m)(m.name, m.kind, m.column, 100, m.places) for m in t.metrics), t.label, t.ordered)
        for t in trips.GOLD
    ]
    for changed in ((*trips.GOLD, fares), tuple(coarser)):
        monkeypatch.setattr(trips, "GOLD", changed)
        assert len(gold.stale_partitions(spark, layers.silver, layers.gold)[0]) == 3
        meta = gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
        assert meta["silver_rows"] == 5 and len(meta["gold_table_rows"]) == len(changed)
        silver_df = spark.read.parquet(layers.silver)
        for table in changed:
            written = spark.read.parquet(f"{layers.gold}/{table.name}").collect()
            assert sorted(map(str, written)) == sorted(map(str, gold.summarize(silver_df, table).collect()))


def test_gold_forgets_what_silver_lost(layers, spark):
    layers.ingest(5, on(1), on(2))
    layers.transform(2026, 5)
    gold.aggregate(spark, layers.silver, layers.gold, write_database=False)
    shutil.rmtree(f"{layers.silver}/_ingest_year=2026/_ingest_month=5/pickup_date=2026-05-02")
    assert gold.aggregate(spark, layers.silver, layers.gold, write_database=False)["silver_rows"] == 1
    assert gold.stale_partitions(spark, layers.silver, layers.gold)[:2] == ([], [])


def test_drops_are_counted_by_the_writing_pass(layers, spark, caplog):
    layers.ingest(4, on(30, 4), on(30, 4, fare_amount=-1.0), on(1, 5, hour=3))
    layers.ingest(5, on(1), on(1), on(30, 4), on(2, fare_amount=None), on(3, fare_amount=-5.0, trip_distance=0.0))
    layers.transform(2026, 4)
    found = layers.transform(2026, 5)
    assert (found["bronze_rows"], found["invalid"], found["duplicates"], found["silver_rows"]) == (5, 2, 2, 1)
    assert {k: v for k, v in found["failed"].items() if v} == {"required": 1, "range(fare_amount)": 2, "range(trip_distance)": 1}
    whole = layers.transform()
    assert (whole["bronze_rows"], whole["invalid"], whole["duplicates"], whole["silver_rows"]) == (8, 3, 2, 3)


def test_counts_of_a_stage_that_ran_twice_are_not_believed(layers, monkeypatch, caplog):
    layers.ingest(5, on(1), on(1), on(2, fare_amount=-5.0))
    right = layers.transform(2026, 5)
    monkeypatch.setattr(silver.Cleaning, "agrees", lambda *_: False)
    with caplog.at_level("WARNING"):
        assert layers.transform(2026, 5) == right
    assert "counting anew" in caplog.text and right["duplicates"] == 1


def test_both_types_in_one_partition(layers, spark):
    layers.ingest(4, on(2, 4))
    layers.ingest(5, on(1))
    month = f"{layers.bronze}/_ingest_year=2026/_ingest_month=5"
    drifted = RAW_DDL.replace("passenger_count double", "passenger_count string").replace("VendorID int", "VendorID bigint")
    row = tuple({**RAW, "passenger_count": "7"}[k] for k in RAW)
    spark.createDataFrame([row], drifted).coalesce(1).write.mode("append").parquet(month)
    df = files.read_conformed(spark, layers.bronze, trips.CONTRACT, trips.LINEAGE)
    assert sorted((r["_ingest_month"], r["passenger_count"]) for r in df.collect()) == [(4, 2), (5, 2), (5, 7)]
    found = files.by_schema(spark, layers.bronze, [month, month.replace("month=5", "month=4")])
    assert sorted(len(paths) for _, paths in found) == [1, 2]


def test_many_partitions_need_one_look_at_their_schemas(spark, tmp_path, monkeypatch):
    root, looks = str(tmp_path / "layer"), []
    spark.range(60).selectExpr("id", "2026 AS _ingest_year", "CAST(id % 30 AS int) AS _ingest_month").write.partitionBy("_ingest_year", "_ingest_month").parquet(root)
    look = files._schema_of
    monkeypatch.setattr(files, "_schema_of", lambda *a: (looks.append(a), look(*a))[1])
    assert files.read_conformed(spark, root, spark.range(1).schema).count() == 60 and len(looks) == 1


CSV_DDL = "id int, name string, price double"


def test_csv_with_broken_lines(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text('name,id,price\na,1,2.5\nb,2\n"c,d",3,x\ne,4,1,9\n,five,\n')
    schema = spark.createDataFrame([], CSV_DDL).schema
    rows = sorted(map(tuple, files.read_csv_table(spark, path, schema).collect()), key=str)
    assert rows == [(1, "a", 2.5), (3, "c,d", None), (None, None, None)]
    lines = files.csv_lines(spark, path)
    assert sorted(r[0] for r in lines.where("_corrupt_line IS NOT NULL").select("_corrupt_line").collect()) == ["b,2", "e,4,1,9"]
    assert files.csv_report(spark, path, schema).first().asDict() == dict(lines=5, broken=2, unfit_id=1, unfit_name=0, unfit_price=1)
    with pytest.raises(Exception, match="broken line"):
        files.read_csv_table(spark, path, schema, mode="strict").collect()
    (tmp_path / "u.csv").write_text("1,a,2.5\n2,b\n")
    found = files.read_csv_table(spark, str(tmp_path / "u.csv"), schema, columns=["id", "name", "price"])
    assert [tuple(r) for r in found.collect()] == [(1, "a", 2.5)]


def test_all_gates_as_one_table(layers, spark):
    path = layers.raw("month", *month_of_trips())
    chain = pipeline.Chain(spark, 2026, 5, path, layers.bronze, layers.silver, layers.gold, layers.zones, write_database=False)
    results = chain.run()
    found = chain.report(results)
    told = {r["suite"]: r for r in verdicts(found).collect()}
    assert len(told) == 8 and all(r["success"] for r in told.values())
    for suite, rows in (g for _, _, gates in chain.layers for g in gates(results)):
        assert suite.run(rows).summary().splitlines()[0] == told[suite.name]["summary"]


def test_strict_chain_fails_on_a_bad_value(layers, spark):
    path = layers.raw("bad", on(1, fare_amount="x"), ddl=RAW_DDL.replace("fare_amount double", "fare_amount string"))
    chain = pipeline.Chain(spark, 2026, 5, path, layers.bronze, layers.silver, layers.gold, layers.zones, write_database=False, mode="strict")
    with pytest.raises(Exception, match="fare_amount"):
        chain.run(check=False)
