"""Loads seen whole or not at all, regions accepted whole, broken payload lines."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridops.plans import ingestion
from gridops.sources import payloads as pl

GRID = "region_id long, region_name string, point_no long"


def now():
    return F.lit(datetime(2026, 8, 20, 6)).cast("timestamp_ntz")


def hourly(spark, regions, points=(1, 2), hours=3, day=0, values=None):
    rows = []
    for r in regions:
        for p in points:
            arrays = [[float(r)] * (values or hours) for _ in pl.HOURLY_VARIABLES]
            rows.append((r, f"R{r}", p, 14.0, -15.0, (day * 86400, day * 86400 + hours * 3600, 3600, *arrays)))
    return spark.createDataFrame(rows, pl.HOURLY_SCHEMA)


def daily(spark, regions, points=(1, 2), days=2):
    rows = [(r, f"R{r}", p, 14.0, -15.0, (0, days * 86400, 86400, *[[1.0] * days for _ in pl.DAILY_VARIABLES])) for r in regions for p in points]
    return spark.createDataFrame(rows, pl.DAILY_SCHEMA)


def feeds(h, d):
    return [pl.Feed("hourly", h, "hourly", pl.HOURLY_VARIABLES), pl.Feed("daily", d, "daily", pl.DAILY_VARIABLES, as_date=True)]


@pytest.fixture
def grid(spark):
    return spark.createDataFrame([(r, f"R{r}", p) for r in (1, 2, 3) for p in (1, 2)], GRID)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_a_region_goes_as_a_whole(spark, grid, tmp_path):
    loads = ingestion.raw_tables(spark, str(tmp_path))
    # region 2's daily payloads lack a point, region 3 sent nothing, region 9 is not on the grid
    h = hourly(spark, (1, 2, 9))
    d = daily(spark, (1,)).union(daily(spark, (2,), points=(1,)))
    assert ingestion.take_in(loads, 1, feeds(h, d), grid, "UTC", now(), whole_regions=True)
    assert rows(loads.table("raw_hourly"), "id_hourly", "region_id") == [(i, 1) for i in range(1, 7)]
    assert rows(loads.table("raw_daily"), "id_daily", "region_id") == [(i, 1) for i in range(1, 5)]
    assert rows(loads.table("extraction_failures"), "id_failure", "region_id", "region_name", "error") == [
        (1, 2, "R2", "daily: expected 2 responses, got 1"), (2, 3, "R3", "hourly: expected 2 responses, got 0"), (3, 9, "R9", "hourly: expected 0 responses, got 2"),
    ]
    # by itself, region 2's hourly run would be accepted
    apart = ingestion.raw_tables(spark, str(tmp_path / "apart"))
    ingestion.take_in(apart, 1, feeds(h, d), grid, "UTC", now())
    assert {r[0] for r in rows(apart.table("raw_hourly"), "region_id")} == {1, 2}


def test_a_bad_day_keeps_all_days_of_both_feeds_out(spark, grid, tmp_path):
    loads = ingestion.raw_tables(spark, str(tmp_path))
    h = hourly(spark, (1, 2, 3)).union(hourly(spark, (2, 3), day=1)).union(hourly(spark, (1,), day=1, values=2))
    ingestion.take_in(loads, 1, feeds(h, daily(spark, (1, 2, 3))), grid, "UTC", now(), whole_regions=True)
    assert {r[0] for r in rows(loads.table("raw_hourly"), "region_id")} == {2, 3} == {r[0] for r in rows(loads.table("raw_daily"), "region_id")}
    assert rows(loads.table("extraction_failures"), "region_id", "error") == [(1, "hourly: array length does not match the time axis")]


@pytest.mark.parametrize("failing", ["raw_daily", "extraction_failures", "commit"])
def test_a_failed_load_is_not_seen_and_can_be_run_again(spark, grid, tmp_path, monkeypatch, failing):
    loads = ingestion.raw_tables(spark, str(tmp_path))
    given = feeds(hourly(spark, (1, 2)), daily(spark, (1, 2)))
    ingestion.take_in(loads, 1, given, grid, "UTC", now(), whole_regions=True)
    before = {n: rows(loads.table(n), "*") for n in loads.schemas}
    put, commit = loads.put, loads.commit

    def broken_put(load, name, df):
        if name == failing:
            raise OSError("lost")
        put(load, name, df)

    def broken_commit(load):
        if failing == "commit":
            raise OSError("lost")
        commit(load)

    monkeypatch.setattr(loads, "put", broken_put)
    monkeypatch.setattr(loads, "commit", broken_commit)
    again = feeds(hourly(spark, (1, 3)), daily(spark, (1, 3)))
    with pytest.raises(OSError):
        ingestion.take_in(loads, 2, again, grid, "UTC", now(), whole_regions=True)
    assert {n: rows(loads.table(n), "*") for n in loads.schemas} == before
    monkeypatch.undo()
    # a new process on the same root
    loads = ingestion.raw_tables(spark, str(tmp_path))
    assert ingestion.take_in(loads, 2, again, grid, "UTC", now(), whole_regions=True)
    assert not ingestion.take_in(loads, 2, again, grid, "UTC", now(), whole_regions=True)
    assert [r[0] for r in rows(loads.table("raw_hourly"), "id_hourly")] == list(range(1, 25))
    assert [r[0] for r in rows(loads.table("raw_daily"), "id_daily")] == list(range(1, 17))
    assert rows(loads.table("extraction_failures"), "id_failure", "region_id", "load") == [(1, 3, 1), (2, 2, 2)]
    assert rows(loads.manifest().filter("load = 2"), "table", "rows", "top_id") == [("extraction_failures", 1, 2), ("raw_daily", 8, 16), ("raw_hourly", 12, 24)]


def test_tables_are_created_once_with_the_declared_columns(spark, tmp_path):
    loads = ingestion.raw_tables(spark, str(tmp_path))
    assert {n: loads.table(n).count() for n in loads.schemas} == dict.fromkeys(loads.schemas, 0)
    assert loads.table("raw_daily").schema["date"].dataType.simpleString() == "date"
    with pytest.raises(Exception, match="lacks|cannot be resolved|UNRESOLVED"):
        loads.put(1, "extraction_failures", spark.createDataFrame([(1,)], "id_failure long"))
    with pytest.raises(ValueError, match="wrote nothing"):
        loads.commit(7)


def test_only_folders_of_committed_loads_are_read(spark, grid, tmp_path):
    loads = ingestion.raw_tables(spark, str(tmp_path))
    for load in (1, 2):
        ingestion.take_in(loads, load, feeds(hourly(spark, (1, 2, 3)), daily(spark, (1, 2, 3))), grid, "UTC", now(), whole_regions=True)
    loads.put(3, "raw_hourly", loads.table("raw_hourly"))  # not committed
    assert loads.table("raw_hourly").count() == 36
    plan = loads.table("raw_hourly")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_broken_lines_are_kept_and_none_is_accepted(spark, grid, tmp_path):
    path = str(tmp_path / "landed")
    h = hourly(spark, (1, 2, 3))
    lines = [r.value for r in h.select(F.to_json(F.struct("*")).alias("value")).collect()]
    lines[0] = lines[0][: len(lines[0]) // 2]  # cut short
    lines[2] = lines[2].replace('"point_no":1', '"point_no":"one"')  # of the wrong type
    lines.append("")  # an empty line is no payload and no error
    lines.append("no payload at all")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, broken = pl.read_checked(spark, path, pl.HOURLY_SCHEMA)
    assert good.count() == 4
    assert sorted((r.region_id or 0, r.payload, r.error) for r in broken.collect()) == sorted(
        [(1, lines[0], "malformed payload"), (2, lines[2], "malformed payload"), (0, "no payload at all", "malformed payload")]
    )
    loads = ingestion.raw_tables(spark, str(tmp_path / "raw"))
    ingestion.take_in(loads, 1, [feeds(good, None)[0]], grid, "UTC", now(), broken=broken)
    assert {r[0] for r in rows(loads.table("raw_hourly"), "region_id")} == {3}
    assert loads.table("broken_payloads").count() == 3
    assert rows(loads.table("extraction_failures"), "region_id", "error") == [(1, "expected 2 responses, got 1"), (2, "expected 2 responses, got 1")]
