"""Plans that stay within a task's and the driver's memory as the tables grow."""

import re

import pytest

from gridops.plans.analyses import ANALYSES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(conf, "-1")
    yield
    spark.conf.unset(conf)


@pytest.mark.parametrize(("seen", "expected"), [
    (["a", "a", None], [("b", 2)]),
    ([None], [("a", 1), ("b", 2), (None, 0)]),
    ([], [("a", 1), ("b", 2), (None, 0)]),
])
def test_missing_regions_without_a_broadcast_of_all_readings(spark, no_small_tables, seen, expected):
    spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "region_name string").createOrReplaceTempView("sizes_regions")
    spark.createDataFrame([(x,) for x in seen], "region_name string").createOrReplaceTempView("sizes_raw_hourly")
    df = spark.sql(ANALYSES["sql_missing_regions"].format(v="sizes_"))
    assert "BroadcastExchange" not in plan_of(df)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)
    old = spark.sql("SELECT region_name, count(region_name) AS total FROM sizes_regions WHERE region_name NOT IN (SELECT region_name FROM sizes_raw_hourly WHERE region_name IS NOT NULL) GROUP BY region_name")
    assert "BroadcastExchange" in plan_of(old) and sorted(map(tuple, old.collect()), key=str) == sorted(expected, key=str)


def test_dates_of_air_quality_are_not_shuffled(spark, no_small_tables):
    from gridops.operators.facts import fact_hourly_air_quality

    air = spark.createDataFrame([], "ts timestamp_ntz, region_name string, point_no long, pm10 double, pm2_5 double, dust double, region_id long, date date, hour_id long")
    points = spark.createDataFrame([], "grid_point_id string, region_id long, point_no long, region_name string")
    plan = plan_of(fact_hourly_air_quality(air, points, spark.createDataFrame([], "date date")))
    assert "hashpartitioning(date" not in plan


def test_newest_copies_are_aggregated_by_shuffle_partition(spark):
    from gridops.operators.dedup import latest_reading

    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "one"), (None, 3, "none")], "k long, load long, v string")
    found = latest_reading(df, ["k"], "load")
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning(k") == 1 and plan.rindex("Aggregate") < plan.index("Exchange hashpartitioning(k")
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 2, "new"), (2, 1, "one"), (None, 3, "none")]


def test_ingested_readings_are_shuffled_without_their_load(spark):
    from gridops.sources.payloads import HOURLY_VARIABLES
    from gridops.streaming import ingest

    columns = "ts timestamp_ntz, region_id long, region_name string, point_no long, latitude double, longitude double, " + ", ".join(f"{c} double" for _, c in HOURLY_VARIABLES)
    table = spark.createDataFrame([], f"{columns}, {ingest.LOAD} struct<time:timestamp,file:string>, load int")
    plan = plan_of(ingest.current_readings(table))
    assert plan.rindex("Aggregate") < plan.index("Exchange hashpartitioning(region_id") and f"{ingest.LOAD}#" not in plan[plan.index("Exchange"):].split("Scan")[0]


def test_marts_that_share_no_model_write_none(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from gridops.plans import graph
    from gridops.plans.incremental import Marts
    from gridops.sources.schemas import RAW_SCHEMAS

    regions = spark.createDataFrame([(1, "R", 14.0, -15.0, 400.0)], RAW_SCHEMAS["regions"])
    reading = [(i, datetime(2026, 8, 20, i), 1, "R", 1, 14.0, -15.0, 25.0, 0.0, 1.0, 1.0, 10.0, 0.0, 0.0, 9000.0, 1.0) for i in (1, 2)]
    made = []
    monkeypatch.setattr(graph, "scratch_path", lambda s, name: made.append(name) or str(tmp_path / f"{name}-{len(made)}"))
    for marts, count in ((("fact_daily_weather", "kpi_maintenance"), 0), (("fact_hourly_weather", "kpi_maintenance"), 1)):
        built = Marts(spark, str(tmp_path / str(count)), regions, marts=marts)
        built.apply({"raw_hourly": spark.createDataFrame(reading, RAW_SCHEMAS["raw_hourly"])})
        assert built.mart("kpi_maintenance").count() == 2 and bool(made) == bool(count)


def test_rejects_are_read_without_parsing_payloads_again(spark, tmp_path):
    from gridops.sources import payloads as pl

    pl.land(spark.createDataFrame([], pl.HOURLY_SCHEMA), str(tmp_path / "landed"))
    landed = pl.read_landed(spark, str(tmp_path / "landed"), pl.HOURLY_SCHEMA)
    grid = spark.createDataFrame([(1, "R", 1)], "region_id long, region_name string, point_no long")
    accepted, rejects = pl.split_complete(landed, "hourly", pl.HOURLY_VARIABLES, grid, "region_id")
    assert "FileScan json" not in plan_of(rejects) and plan_of(accepted).count("FileScan json") == 1


def test_the_grid_of_the_marts_is_not_broadcast(spark, tmp_path, monkeypatch):
    from datetime import date, datetime

    from gridops.plans.incremental import Marts
    from gridops.sources import sinks
    from gridops.sources.schemas import RAW_SCHEMAS

    regions = spark.createDataFrame([(1, "R", 14.0, -15.0, 400.0)], RAW_SCHEMAS["regions"])
    load = {
        "raw_hourly": [(1, datetime(2026, 8, 20, 1), 1, "R", 1, 14.0, -15.0, 25.0, 0.0, 1.0, 1.0, 10.0, 0.0, 0.0, 9000.0, 1.0)],
        "raw_daily": [(1, date(2026, 8, 20), 1, "R", 1, 14.0, -15.0, *[1.0] * 11)],
        "raw_air_quality": [(datetime(2026, 8, 20, 1), " R ", 1, 14.0, -15.0, 1, 9.0, 1.0, 1.0)],
    }
    plans, replace = {}, sinks.replace_dates
    monkeypatch.setattr(sinks, "replace_dates", lambda s, df, path, *a, **b: plans.update({path.rsplit("/", 1)[1]: plan_of(df)}) or replace(s, df, path, *a, **b))
    built = Marts(spark, str(tmp_path), regions, marts=("fact_daily_weather", "kpi_maintenance"))
    built.apply({n: spark.createDataFrame(rows, RAW_SCHEMAS[n]) for n, rows in load.items()})
    assert built.mart("kpi_maintenance").first().avg_pm10 == 9.0 and built.mart("fact_daily_weather").count() == 1
    for name, joins in (("fact_daily_weather", 1), ("kpi_maintenance", 3)):
        assert plans[name].count("ShuffledHashJoin [region") == joins and "BroadcastHashJoin [region" not in plans[name]
    # readings and air quality, both by point, are joined as they lie
    by = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", plans["kpi_maintenance"]))
    assert "region_id, point_no" in by and not any(x.startswith("region_id, point_no, date") for x in by)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", None) in (None, "true")


def test_dates_are_replaced_by_one_write(spark, tmp_path, monkeypatch):
    from datetime import date

    from gridops.sources import sinks

    days = [date(2026, 8, 20), date(2026, 8, 21), None]
    df = spark.createDataFrame([(d, "a", i) for i, d in enumerate(days)], "date date, grid_point_id string, v int")
    written = []
    write = type(df.write).parquet
    monkeypatch.setattr(type(df.write), "parquet", lambda self, path, *a, **b: written.append(path) or write(self, path, *a, **b))
    path = str(tmp_path / "m")
    sinks.replace_dates(spark, df, path, "date", days)
    assert written == [path]
    sinks.replace_dates(spark, df.filter("v = 1"), path, "date", days[1:])
    assert sorted(r.v for r in spark.read.schema(df.schema).parquet(path).collect()) == [0, 1]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in (files.apply(i).getName() for i in range(files.size())) if x.startswith("shuffle_")}


def test_shuffle_files_go_with_their_step(spark, tmp_path):
    import time

    from gridops.session import DROP_SHUFFLES, configured

    (key,) = DROP_SHUFFLES
    before = shuffle_files(spark)
    with configured(spark, DROP_SHUFFLES):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "step"))
        assert spark.read.parquet(str(tmp_path / "step")).groupBy("id").count().count() == 1000
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(key, None) in (None, "false")
    with pytest.raises(ValueError), configured(spark, DROP_SHUFFLES):
        raise ValueError
    assert spark.conf.get(key, None) in (None, "false")


def test_landed_refreshes_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    import os

    from gridops.sources import payloads as pl

    monkeypatch.setattr(pl, "FILE_PAYLOADS", 3)
    series = (0, 7200, 3600, *[[1.5, None]] * len(pl.HOURLY_VARIABLES))
    payloads = spark.createDataFrame([(1, "R", i, 14.0, -15.0, series) for i in range(8)], pl.HOURLY_SCHEMA).coalesce(1)
    src = str(tmp_path / "src")
    for n in (1, 2):
        pl.land_more(payloads, src)
        files = [f for f in os.listdir(src) if f.startswith("part-")]
        assert len(files) == 3 * n and all(f.endswith(".json.gz") for f in files)
        back = pl.read_landed(spark, src, pl.HOURLY_SCHEMA)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, payloads.collect() * n))


def test_ingested_readings_stay_by_point(spark):
    from datetime import datetime

    from gridops.streaming import ingest

    t = [datetime(2026, 8, 20, h) for h in range(3)]
    loads = [(t[1], "b"), (t[1], "c"), (t[2], "a")]
    rows = [(t[h], (at, f), 1, p, f"R{i}", float(i) if i else None) for h in (0, 1) for p in (1, None) for i, (at, f) in enumerate(loads[: 2 + h])]
    batch = spark.createDataFrame(rows[::-1], f"ts timestamp_ntz, {ingest.LOAD} struct<time:timestamp,file:string>, region_id long, point_no long, region_name string, v double")
    kept = ingest.latest_wins_batch(batch)
    assert kept.columns == batch.columns and kept.schema == batch.schema
    assert sorted((r.ts.hour, r.region_name, r.v, r[ingest.LOAD].file) for r in kept.collect()) == [(0, "R1", 1.0, "c")] * 2 + [(1, "R2", 2.0, "a")] * 2
    first = batch.filter("region_name = 'R2'").withColumn("v", spark.range(1).selectExpr("cast(null as double)").scalar())
    assert [(r.v, r.region_name) for r in ingest.latest_wins_batch(first).collect()] == [(None, "R2")] * 2
    for df in (kept, ingest.current_readings(batch.selectExpr("*", "1 as load"))):
        by = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", plan_of(df)))
        assert set(by) == {"region_id, point_no"}
