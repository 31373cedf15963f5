"""What tasks hold and what is shuffled and written, as the tables grow."""

import pytest

from gridops.operators import spread
from gridops.sources.schemas import RAW_SCHEMAS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def readings(spark, tmp_path):
    rows = [(i % 50, i, f"v{i}") for i in range(500)]
    spark.createDataFrame(rows, "k long, load long, v string").write.parquet(str(tmp_path / "readings"))
    return spark.read.parquet(str(tmp_path / "readings"))


def test_partitions_follow_the_input(spark, readings, monkeypatch):
    from gridops.operators.dedup import latest_reading

    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread.partitions(readings) == usual == spread.partitions(spark.range(5))
    size = spread.input_bytes(readings)
    for more in (3, 6):  # of an input twice as large, twice as many
        monkeypatch.setattr(spread, "BYTES", -(-size // (usual * more)))
        n = spread.partitions(readings)
        assert usual * (more - 1) < n <= usual * more
        found = latest_reading(readings, ["k"], "load")
        assert "Exchange hashpartitioning(k#" in plan_of(found) and f", {n}), REPARTITION" in plan_of(found)
        assert sorted(map(tuple, found.collect())) == [(k, 450 + k, f"v{450 + k}") for k in range(50)]


def test_ids_are_dense_over_more_partitions(spark, readings, monkeypatch):
    from gridops.operators.ids import append_ids

    monkeypatch.setattr(spread, "BYTES", max(1, spread.input_bytes(readings) // 40))
    out = append_ids(readings, ["load"], "id", keep=["load", "twice"], derive=lambda df: df.selectExpr("load", "load * 2 as twice"))
    assert out.columns == ["load", "twice", "id"] and len(out.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, out.collect())) == [(i, 2 * i, i + 1) for i in range(500)]


@pytest.fixture
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_readings_are_shuffled_once_on_the_way_to_the_fact(spark, no_small_tables):
    from gridops.operators import facts, staging

    raw = spark.createDataFrame([], RAW_SCHEMAS["raw_hourly"])
    points = spark.createDataFrame([], "grid_point_id string, region_id long, point_no long, region_name string")
    plan = plan_of(facts.fact_hourly_weather(staging.stg_hourly(raw), points))
    assert plan.count("Exchange hashpartitioning(") == 2 and "SortMergeJoin" in plan  # one of them the points'


def test_payloads_are_grouped_where_their_copies_were_folded(spark):
    from gridops.operators import staging
    from gridops.sources import fixture_payloads as fp

    raw = spark.createDataFrame([], RAW_SCHEMAS["raw_hourly"])
    latest = staging.latest_reading(raw, staging.HOURLY_GROUP, "id_hourly", by=staging.POINT).drop("id_hourly")
    assert plan_of(fp.hourly_payloads(latest, "UTC")).count("Exchange hashpartitioning(") == 1


def test_one_set_of_keys_is_a_plain_grouping(spark):
    from gridops.operators import quality as q

    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k long, s string")
    one = q.run_checks({"t": df}, [q.unique_combo("t", "k", "s")])
    assert "Expand" not in plan_of(one) and one.first()["failures"] == 2
    two = q.run_checks({"t": df}, [q.unique("t", "s"), q.unique_combo("t", "k", "s")])
    assert {r["check_name"]: r["failures"] for r in two.collect()} == {"unique:t.s": 1, "unique_combo:t.k+s": 2}


def test_rows_without_a_parent_are_found_without_a_shuffle_of_all(spark):
    from gridops.operators import quality as q
    from gridops.operators.failures import failing_rows

    child = spark.range(3000).selectExpr("id", "if(id < 2990, id % 7, if(id < 2998, 7 + id % 2, null)) as parent")
    parent = spark.range(7).selectExpr("id as key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        lost = failing_rows({"c": child, "p": parent.union(spark.range(1000, 9000))}, [q.relationship("c", "parent", "p", "key")], {"c": ("id",), "p": ("key",)})
        assert "Exchange hashpartitioning" not in plan_of(lost)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = [("relationship:c.parent->p.key", "c", str(i), str(7 + i % 2)) for i in range(2990, 2998)]
    assert sorted(tuple(r)[1:] for r in lost.collect()) == sorted(e[1:] for e in expected)


def test_models_with_one_reader_are_not_written(spark, tmp_path, monkeypatch):
    from gridops.plans import graph, suite

    assert set(graph.READS) == set(graph.MODELS)
    made = []
    monkeypatch.setattr(graph, "scratch_path", lambda s, name: made.append(name) or str(tmp_path / name))
    checks = suite.checks_of("unique_combo")
    g = graph.ModelGraph(spark, "/root/testdata/sf0.001", materialize=suite.shared(checks))
    tables = suite.tables(g, suite.tables_used(checks))
    assert "model-fact_hourly_weather" in made and not {"model-stg_hourly", "model-kpi_generation_potential"} & set(made)
    lazy = suite.tables(graph.ModelGraph(spark, "/root/testdata/sf0.001"), suite.tables_used(checks))
    assert {n: t.count() for n, t in tables.items()} == {n: t.count() for n, t in lazy.items()}


def test_models_read_are_those_declared(spark):
    from gridops.plans import graph

    for name in graph.MODELS:
        g, read = graph.ModelGraph(spark, "/root/testdata/sf0.001"), []

        class Seen(graph.ModelGraph):
            def __getattribute__(self, x):
                if x in graph.READS:
                    read.append(x)
                return getattr(g, x) if x in graph.READS else object.__getattribute__(self, x)

        # the property wraps the model's own function
        fn = next(c.cell_contents for c in getattr(type(g), name).func.__closure__ if callable(c.cell_contents))
        fn(Seen(spark, "/root/testdata/sf0.001"))
        assert set(read) == set(graph.READS[name]), name


def test_rows_are_dealt_by_day_and_folded_there(spark, monkeypatch):
    from datetime import date

    from gridops.operators.dedup import folded

    days = [date(2026, 8, 20), date(1969, 12, 31), None]
    rows = [(d, k, load, float(load)) for d in days for k in range(40 if d else 4) for load in (2, 1, 3)]
    df = spark.createDataFrame(rows, "day date, k long, load long, v double").repartition(4)
    monkeypatch.setattr(spread, "ROWS", 30)
    dealt = spread.by_day(df, {r[0]: r[1] for r in df.groupBy("day").count().collect()}, "day", "k")
    found = folded(dealt, ["day", "k", spread.BUCKET], "load")
    assert plan_of(found).count("Exchange ") - plan_of(df).count("Exchange ") - plan_of(found).count("BroadcastExchange ") == 1
    in_bucket = {}
    for r in dealt.collect():
        in_bucket.setdefault(r[spread.BUCKET], set()).add(r.day)
    assert sorted(map(len, in_bucket.values())) == [1] * 9 and set(in_bucket) == set(range(9))
    assert sorted(tuple(r)[:4] for r in found.filter("day is not null").collect()) == sorted((d, k, 3, 3.0) for d in days[:2] for k in range(40))
    assert found.filter("day is null").count() == 4
    assert spread.by_day(df.filter("false"), {}, "day", "k").count() == 0
