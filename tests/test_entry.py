"""How the queries that write layers are planned, over tables of our own."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from lamina.plans import pipeline
from lamina.sources import sinks


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(1996, 1, 1)
    orders = [(i, i % 40, 300_000.0, day.replace(year=1995 + i % 3, day=1 + i % 28)) for i in range(300)]
    lines = [(i, 1 + i % 4, 12.0, 1000.0, 0.01, "A", "O") for i in range(300)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    columns = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, f"n{i}", 0) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "r")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def test_trips_are_cleaned_once_for_all_that_is_landed(tables, spark, monkeypatch):
    plans, replace = [], sinks.replace_partitions

    def seen(df, path, *rest, **options):
        if path.endswith("/silver"):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return replace(df, path, *rest, **options)

    monkeypatch.setattr(sinks, "replace_partitions", seen)
    assert entry.queries()["gold_incremental"](spark, tables).count() > 0
    assert len(plans) == 3 and not any("Join" in plan or "Window" in plan for plan in plans)


@pytest.mark.parametrize("width", [3, 12])
def test_raw_trips_are_written_as_wide_as_the_session_shuffles(tables, spark, monkeypatch, width):
    monkeypatch.setattr(pipeline.Chain, "run", lambda *_, **__: {})
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        chain, _ = entry.month_chain_over(spark, tables)
        raw = spark.read.parquet(chain.input_path)
        assert raw.selectExpr("count(distinct _metadata.file_path)").first()[0] == width
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
