"""Marts kept load by load, bucketed facts, clustered files, SQL over the models."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gridops.operators import kpis
from gridops.plans.graph import ModelGraph
from gridops.plans.incremental import STATE, Marts
from gridops.sources import landing, sinks
from gridops.sources.schemas import RAW_SCHEMAS

T0 = datetime(2026, 8, 20)


def cells(df):
    cols = sorted(df.columns)
    return sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def test_loads_one_by_one_equal_one_build(spark, tmp_path):
    full = ModelGraph(spark, SF_SMALL)
    raw = {n: landing.landed(spark, SF_SMALL, n) for n in STATE}
    built = Marts(spark, str(tmp_path), full.regions, marts=("solar_coverage", "kpi_maintenance", "fact_daily_weather"))
    for part in (1, 0):  # the later load first
        built.apply({n: df.filter(F.pmod(F.col(STATE[n][1]), F.lit(2)) == part) for n, df in raw.items()})
    for name in built.marts:
        assert cells(built.mart(name)) == cells(getattr(full, name)) and built.mart(name).count()


def hourly(spark, readings):
    """(load id, hours from T0 or None, radiation)"""
    rows = [(i, None if h is None else T0 + timedelta(hours=h), 1, "R", 1, 14.0, -15.0, 25.0, 0.0, r, r, 10.0, 0.0, 0.0, 9000.0, 1.0) for i, h, r in readings]
    return spark.createDataFrame(rows, RAW_SCHEMAS["raw_hourly"])


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    regions = spark.createDataFrame([(1, "R", 14.0, -15.0, 400.0)], RAW_SCHEMAS["regions"])
    built = Marts(spark, str(tmp_path), regions, marts=("fact_hourly_weather", "kpi_grid_stability", "maintenance_windows"))
    built.apply({"raw_hourly": hourly(spark, [(i, h, 800.0) for i, h in enumerate(range(72), 1)] + [(99, None, 1.0)])})
    assert built.state("raw_hourly").count() == 73 and built.mart("fact_hourly_weather").count() == 72
    before = files(str(tmp_path))
    days = built.apply({"raw_hourly": hourly(spark, [(100, 24 + 12, 100.0), (101, 24 + 13, 100.0), (50, 24 + 14, 100.0), (102, 24 + 14, 850.0)])})
    assert [str(d) for d in days] == ["2026-08-21"]
    after = files(str(tmp_path))
    untouched = {f for f in before if "2026-08-21" not in f}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert not any(f in after for f in before if "2026-08-21" in f)
    risky = built.mart("kpi_grid_stability").filter("grid_stability_risk = 1").select("hour", "generator_activation_recommended").collect()
    assert sorted(tuple(r) for r in risky) == [(12, 1), (13, 1)]
    # the newest copy is the one of the highest id, also if an older one comes later
    assert built.state("raw_hourly").filter(F.col("ts") == T0 + timedelta(hours=38)).first().shortwave_radiation_w_m2 == 850.0
    built.apply({"raw_hourly": hourly(spark, [(3, 38, 1.0)])})
    assert built.state("raw_hourly").filter(F.col("ts") == T0 + timedelta(hours=38)).first().shortwave_radiation_w_m2 == 850.0


def test_a_date_left_without_rows_has_none(spark, tmp_path):
    df = spark.createDataFrame([("2026-08-20", "a", 1), ("2026-08-21", "b", 2)], "d string, grid_point_id string, v int").withColumn("date", F.to_date("d")).drop("d")
    path = str(tmp_path / "m")
    days = [r.date for r in df.select("date").collect()]
    sinks.replace_dates(spark, df, path, "date", days)
    sinks.replace_dates(spark, df.filter("v = 9"), path, "date", days[:1])
    assert [r.v for r in spark.read.schema(df.schema).parquet(path).collect()] == [2]


def test_built_facts_join_without_an_exchange(spark):
    built = ModelGraph(spark, SF_SMALL, materialize=True, buckets=4)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(conf, "-1")
    try:
        joined = kpis.kpi_maintenance(built.fact_hourly_weather, built.fact_hourly_air_quality, built.dim_hour, built.params)
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # the one exchange is that of the roll-up by region and hour
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
        lazy = ModelGraph(spark, SF_SMALL)
        assert cells(joined) == cells(lazy.kpi_maintenance)
        assert cells(built.fact_hourly_weather) == cells(lazy.fact_hourly_weather)
    finally:
        spark.conf.unset(conf)


def _scanned(df) -> int:
    """Rows that the scan of an executed frame gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_drill_down_skips_pages(spark, tmp_path):
    # wide enough that a file has many pages
    df = spark.range(400_000).select(F.sha2(F.pmod(F.col("id"), F.lit(4000)).cast("string"), 256).alias("grid_point_id"), F.rand(1).alias("x"), F.lit("2026-08-20").cast("date").alias("date"))
    path = str(tmp_path / "mart")
    sinks.write_mart(df, path, files=2)
    key = df.orderBy("grid_point_id").first().grid_point_id
    one = sinks.read_mart(spark, path).filter(F.col("grid_point_id") == key)
    assert one.count() == 100
    assert _scanned(one) < 400_000 / 4
    assert _scanned(sinks.read_mart(spark, path).filter(F.col("grid_point_id") == "f" * 63 + "g")) == 0


def test_models_are_views(spark):
    names = ModelGraph(spark, SF_SMALL).register_views("v_")
    assert {"v_raw_hourly", "v_grid_points", "v_kpi_maintenance", "v_maintenance_windows"} <= set(names)
    got = spark.sql("SELECT count(*) AS n FROM v_fact_daily_weather JOIN v_dim_grid_point USING (grid_point_id)").first().n
    assert got == ModelGraph(spark, SF_SMALL).fact_daily_weather.count()
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.sql("SELECT * FROM v_unknown")
