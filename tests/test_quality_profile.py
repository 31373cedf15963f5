from datetime import date, datetime

from gridops.operators import facts, profile, quality as q
from gridops.operators.dims import dim_date
from gridops.operators.staging import with_grain


def test_checks_find_planted_violations_and_pass_clean(spark):
    t = spark.createDataFrame(
        [(1, "a", 5.0, True), (2, "a", -1.0, None), (2, None, 101.0, False), (None, "z", None, True)],
        "id long, s string, x double, b boolean",
    )
    parent = spark.createDataFrame([(1,)], "id long")
    checks = [
        q.Check("not_null", "t", ("id",)),
        q.in_range("t", "x", min=0, max=100),
        q.value_set("t", "s", ["a"]),
        q.accepted("t", "s", ["a"]),
        q.accepted("t", "b", [True, False]),
        q.unique("t", "id"),
        q.unique_combo("t", "id", "s"),
        q.relationship("t", "id", "p", "id"),
    ]
    for fold in (True, False):
        got = {r.check_name: r.failures for r in q.run_checks({"t": t, "p": parent}, checks, fold=fold).collect()}
        assert got == {
            "not_null:t.id": 1, "range:t.x": 2, "value_set:t.s": 2, "accepted:t.s": 1,
            "accepted:t.b": 0, "unique:t.id": 1, "unique_combo:t.id+s": 0, "relationship:t.id": 2,
        }
    strict = {r.check_name: r.failures for r in q.run_checks({"t": t}, [q.in_range("t", "x", min=-1, strict=True)]).collect()}
    assert strict == {"range:t.x": 1}


def test_not_in_semantics(spark):
    regions = spark.createDataFrame([("A",), ("B",), (None,)], "region_name string")
    seen = spark.createDataFrame([("A",)], "region_name string")
    assert sorted(r.region_name for r in profile.missing_regions(regions, seen).collect()) == ["B"]
    with_null = spark.createDataFrame([("A",), (None,)], "region_name string")
    assert profile.missing_regions(regions, with_null).count() == 0
    empty = spark.createDataFrame([], "region_name string")
    assert profile.missing_regions(regions, empty).count() == 3


def test_duplicate_keys_top_k_with_tie_break(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [("d",)], "k string")
    out = [(r.k, r.n) for r in profile.duplicate_keys(df, ["k"], k=2).collect()]
    assert out == [("a", 3), ("b", 2)]


def test_air_only_date_is_dropped(spark):
    hourly = spark.createDataFrame([(datetime(2026, 8, 20, 5),)], "ts timestamp_ntz")
    daily = spark.createDataFrame([(date(2026, 8, 21),)], "date date")
    dd = dim_date(hourly, daily)
    assert sorted(r.date for r in dd.collect()) == [date(2026, 8, 20), date(2026, 8, 21)]
    air = with_grain(spark.createDataFrame(
        [(datetime(2026, 8, 20, 3), "R", 1, 10.0, 5.0, 20.0, 1), (datetime(2026, 8, 25, 3), "R", 1, 10.0, 5.0, 20.0, 1)],
        "ts timestamp_ntz, region_name string, point_no long, pm10 double, pm2_5 double, dust double, region_id long",
    ))
    gp = spark.createDataFrame([("g", 1, 1, "R", 0.0, 0.0)], "grid_point_id string, region_id long, point_no long, region_name string, grid_lat double, grid_lon double")
    out = facts.fact_hourly_air_quality(air, gp, dd).collect()
    assert [(r.date, r.hour_id) for r in out] == [(date(2026, 8, 20), 3)]
