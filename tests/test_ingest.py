"""Dedupe, dense ids, payload explode (empty axis, short arrays), completeness split."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from gridops.operators.dedup import latest_reading
from gridops.operators.ids import append_ids
from gridops.sources import payloads as pl


def test_latest_reading_keeps_newest_and_is_order_free(spark):
    rows = [(k, i, float(i)) for i in range(200) for k in ("a", "b", "c") if random.Random(i).random() < 0.7]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, load long, v double").repartition(5)
    out = {r.k: (r.load, r.v) for r in latest_reading(df, ["k"], "load").collect()}
    for k in "abc":
        newest = max(i for kk, i, _ in rows if kk == k)
        assert out[k] == (newest, float(newest))


def test_append_ids_dense_and_continuing(spark):
    batch = spark.createDataFrame([(i,) for i in random.Random(3).sample(range(10_000), 500)], "x long").repartition(7)
    existing = spark.createDataFrame([(41,), (7,)], "id long")
    out = append_ids(batch, ["x"], "id", existing=existing).collect()
    ids = sorted(r.id for r in out)
    assert ids == list(range(42, 42 + 500))
    by_x = sorted(out, key=lambda r: r.x)
    assert [r.id for r in by_x] == ids  # monotone in the order
    first = append_ids(batch, ["x"], "id").agg(F.min("id"), F.max("id")).first()
    assert tuple(first) == (1, 500)


def _payload(spark, time, time_end, temps):
    arrays = {api: [1.0] * 3 for api, _ in pl.HOURLY_VARIABLES}
    arrays["temperature_2m"] = temps
    row = (1, "R", 1, 14.0, -15.0, (time, time_end, 3600, *[arrays[api] for api, _ in pl.HOURLY_VARIABLES]))
    return spark.createDataFrame([row], pl.HOURLY_SCHEMA)


def test_explode_left_closed_axis(spark):
    t0 = int(datetime(2026, 8, 20).timestamp()) - int(datetime(1970, 1, 1).timestamp())
    p = _payload(spark, t0, t0 + 3 * 3600, [20.0, 21.0, 22.0])
    out = pl.explode_payloads(p, "hourly", pl.HOURLY_VARIABLES, "Africa/Dakar").orderBy("ts").collect()
    assert [r.ts for r in out] == [datetime(2026, 8, 20, h) for h in range(3)]
    assert [r.temperature_2m for r in out] == [20.0, 21.0, 22.0]


def test_empty_axis_gives_no_rows_not_an_error(spark):
    p = _payload(spark, 7200, 0, [])
    assert pl.explode_payloads(p, "hourly", pl.HOURLY_VARIABLES, "UTC").count() == 0


def test_short_array_rejects_region(spark):
    p = _payload(spark, 0, 3 * 3600, [20.0, 21.0])  # one value short
    expected = spark.createDataFrame([(1, "R", 1)], "region_id long, region_name string, point_no long")
    ok, bad = pl.split_complete(p, "hourly", pl.HOURLY_VARIABLES, expected, "region_id")
    assert ok.count() == 0
    r = bad.first()
    assert r.error == "array length does not match the time axis" and r.received_points == 1


def test_missing_point_rejects_region(spark):
    p = _payload(spark, 0, 3 * 3600, [20.0, 21.0, 22.0])
    expected = spark.createDataFrame([(1, "R", k) for k in range(1, 17)], "region_id long, region_name string, point_no long")
    ok, bad = pl.split_complete(p, "hourly", pl.HOURLY_VARIABLES, expected, "region_id")
    assert ok.count() == 0 and bad.first().error == "expected 16 responses, got 1"


def test_require_grid(spark):
    import pytest

    with pytest.raises(RuntimeError):
        pl.require_grid(spark.createDataFrame([], "region_id long"))
    pl.require_grid(spark.createDataFrame([(1,)], "region_id long"))


def test_dead_letters_continue_ids(spark):
    rejects = spark.createDataFrame(
        [(2, "B", 0, "expected 16 responses, got 3"), (1, "A", 0, "expected 16 responses, got 15")],
        "region_id long, region_name string, _day long, error string",
    )
    log = spark.createDataFrame([(5, 9, "Z", "x", datetime(2026, 1, 1))], "id_failure long, region_id long, region_name string, error string, run_ts timestamp_ntz")
    out = pl.dead_letters(rejects, F.lit(datetime(2026, 8, 20, 6)).cast("timestamp_ntz"), existing=log).orderBy("id_failure").collect()
    assert [(r.id_failure, r.region_name) for r in out] == [(6, "A"), (7, "B")]
    assert list(out[0].asDict()) == list(pl.DEAD_LETTER_COLUMNS)


def test_append_matches_columns_by_name(spark, tmp_path):
    from gridops.sources import sinks

    path = str(tmp_path / "raw")
    sinks.append_raw(spark.createDataFrame([(1, "a")], "id long, name string"), path)
    sinks.append_raw(spark.createDataFrame([("b", 2)], "name string, id long"), path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "name").collect())
    assert got == [(1, "a"), (2, "b")]


def test_repeated_point_and_silent_region_are_rejected(spark):
    one = _payload(spark, 0, 3 * 3600, [20.0, 21.0, 22.0])
    twice = one.union(one)  # point 1 twice, point 2 never; region 2 silent
    expected = spark.createDataFrame(
        [(1, "R", 1), (1, "R", 2), (2, "S", 1)], "region_id long, region_name string, point_no long"
    )
    ok, bad = pl.split_complete(twice, "hourly", pl.HOURLY_VARIABLES, expected, "region_id")
    assert ok.count() == 0
    got = {r.region_name: (r.expected_points, r.received_points, r.error) for r in bad.collect()}
    assert got == {"R": (2, 2, "points missing, repeated or unknown"), "S": (1, 0, "expected 1 responses, got 0")}


def test_half_hours_and_long_days_keep_their_place(spark):
    from gridops.operators.staging import HOURLY_GROUP
    from gridops.sources import fixture_payloads as fp

    names = [c for _, c in pl.HOURLY_VARIABLES]
    schema = "region_id long, region_name string, point_no long, latitude double, longitude double, ts timestamp_ntz, id_hourly long, " + ", ".join(f"{c} double" for c in names)

    def reading(ts, load):
        return (1, "R", 1, 14.0, -15.0, ts, load, *[float(load)] * len(names))

    df = spark.createDataFrame([reading(datetime(2026, 8, 20, 10), 1), reading(datetime(2026, 8, 20, 10, 30), 2), reading(datetime(2026, 8, 20, 10), 3)], schema)
    latest = latest_reading(df, HOURLY_GROUP, "id_hourly")
    assert sorted((r.ts, r.id_hourly) for r in latest.collect()) == [(datetime(2026, 8, 20, 10), 3), (datetime(2026, 8, 20, 10, 30), 2)]
    back = pl.explode_payloads(fp.hourly_payloads(latest.drop("id_hourly"), "UTC"), "hourly", pl.HOURLY_VARIABLES, "UTC")
    assert back.count() == 48 and back.filter("temperature_2m IS NOT NULL").count() == 2
    autumn = spark.createDataFrame([reading(datetime(2026, 10, 25, 12), 1)], schema).drop("id_hourly")  # 25 hours in Paris
    assert pl.explode_payloads(fp.hourly_payloads(autumn, "Europe/Paris"), "hourly", pl.HOURLY_VARIABLES, "Europe/Paris").count() == 25


def test_stream_keeps_every_region_and_the_newest_load(spark, tmp_path):
    from gridops.streaming import ingest

    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))

    def refresh(region, temps, day=0):
        t0 = day * 86400
        arrays = {api: [1.0] * 3 for api, _ in pl.HOURLY_VARIABLES}
        arrays["temperature_2m"] = temps
        row = (region, f"R{region}", 1, 14.0, -15.0, (t0, t0 + 3 * 3600, 3600, *[arrays[api] for api, _ in pl.HOURLY_VARIABLES]))
        spark.createDataFrame([row], pl.HOURLY_SCHEMA).coalesce(1).write.mode("append").json(src)
        ingest.start_ingest(ingest.hourly_readings_stream(spark, src, "UTC"), out, ckpt).awaitTermination()

    refresh(1, [1.0, 2.0, 3.0], day=30)
    refresh(2, [4.0, 5.0, 6.0])  # a month older than what came before: not late
    refresh(1, [7.0, 8.0, 9.0], day=30)  # the observation replaces the forecast
    now = ingest.current_readings(spark.read.parquet(out))
    assert sorted((r.region_id, r.temperature_2m) for r in now.collect()) == [(1, 7.0), (1, 8.0), (1, 9.0), (2, 4.0), (2, 5.0), (2, 6.0)]


def test_given_tables_must_have_the_declared_columns(spark):
    import pytest

    from gridops.sources.schemas import conform

    regions = spark.createDataFrame([(1, "R", 14.0, -15.0, 4)], "region_id int, region_name string, latitude double, longitude double, area_km2 int")
    assert dict(conform(regions.withColumn("more", F.lit(1)), "regions").dtypes) == {
        "region_id": "bigint", "region_name": "string", "latitude": "double", "longitude": "double", "area_km2": "double"
    }
    with pytest.raises(ValueError, match="lacks the column area_km2"):
        conform(regions.drop("area_km2"), "regions")
    with pytest.raises(ValueError, match="declared bigint"):
        conform(regions.withColumn("region_id", F.lit("1")), "regions")
