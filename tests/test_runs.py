"""Runs of hours by bit arithmetic, and mergeable profiles."""

import itertools
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gridops.operators import profile, profile_state, runs
from gridops.plans.graph import ModelGraph


def test_every_day_of_ten_hours(spark):
    days = spark.range(1 << 10).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(9)))).filter("getbit(id, hour) = 1")
    found = days.groupBy("id").agg(runs.packed("hour").alias("mask"))
    assert found.filter("mask <> id").count() == 0 and found.count() == (1 << 10) - 1
    rows = days.withColumn("mask", F.col("id")).select("id", "hour", runs.rank("mask", "hour").alias("rank"), runs.length("mask", "hour").alias("length"), runs.upward("mask", "hour").alias("up")).collect()
    for r in rows:
        bits = [h for h in range(10) if r.id >> h & 1]
        run = next(g for g in (list(x) for _, x in itertools.groupby(bits, key=lambda h: h - bits.index(h))) if r.hour in g)
        assert (r["rank"], r.length, r.up) == (bits.index(r.hour) + 1, len(run), run[-1] - r.hour + 1)
    firsts = {r.id: r.s for r in spark.range(1 << 10).select("id", runs.starts("id").alias("s")).collect()}
    assert all(s == [h for h in range(10) if i >> h & 1 and not (h and i >> (h - 1) & 1)] for i, s in firsts.items())


def test_the_whole_day_and_its_last_hour(spark):
    row = spark.range(1).select(F.lit((1 << 24) - 1).cast("long").alias("m"), F.lit(23).alias("h"), F.lit(0).alias("z"))
    got = row.select(runs.length("m", "h").alias("a"), runs.upward("m", "z").alias("b"), runs.rank("m", "h").alias("c"), runs.starts("m").alias("d")).first()
    assert tuple(got) == (24, 24, 24, [0])


def test_no_sort_and_no_window_for_runs(spark):
    g = ModelGraph(spark, SF_SMALL, materialize=True)
    from gridops.operators import extensions, kpis

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (kpis.kpi_grid_stability(g.fact_hourly_weather, g.dim_hour), extensions.maintenance_windows(g.kpi_maintenance)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Window" not in plan and "Sort " not in plan and "HashAggregate" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merged_profiles_equal_the_full_one_after_each_load(spark, tmp_path):
    rng = random.Random(5)
    schema = "region_name string, point_no long, v double, load int"
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, 40_000, 70_001, None]), rng.choice([None, rng.random()]), rng.randrange(4)) for _ in range(300)]
    df = spark.createDataFrame(rows, schema)
    kept = profile_state.Profiles(spark, str(tmp_path / "p"))
    assert kept.profile().count() == 0
    for load in range(4):
        for _ in range(2):  # taken in again: the same
            kept.add(load, "t", df.filter(F.col("load") == load), "v", "v")
        want = profile.profile_tables({"t": (df.filter(F.col("load") <= load), "v", "v")}).first()
        assert kept.profile().first().asDict() == want.asDict()
