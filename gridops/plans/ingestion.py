"""Ingestion end to end: landed payloads -> accepted or rejected runs -> ids -> raw tables,
rejects -> failure log, committed together as one load.

A load that fails anywhere leaves nothing that is read (``sources.loads``); taken in again it
gives the same rows and ids once, and a load that was committed is left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from gridops.operators.ids import append_ids
from gridops.sources import payloads as pl
from gridops.sources.loads import Loads
from gridops.sources.schemas import LANDED, LANDED_IDS

#: Raw table of each feed.
TABLES = {"hourly": "raw_hourly", "daily": "raw_daily", "air_quality": "raw_air"}


def raw_tables(spark: SparkSession, root: str) -> Loads:
    """The raw tables and logs under ``root``, created if absent."""
    return Loads(spark, root, LANDED, LANDED_IDS)


def take_in(
    loads: Loads,
    load: int,
    feeds: Sequence[pl.Feed],
    grid: DataFrame,
    tz: str,
    run_ts: Column,
    key: str = "region_id",
    whole_regions: bool = False,
    broken: DataFrame | None = None,
) -> bool:
    """One refresh of one or more feeds; False if it was taken in before.

    With ``whole_regions`` a region is accepted or rejected once, over all feeds, with one
    failure row; else every run of every feed by itself. Accepted readings get ids that
    continue after the raw table's, in order of region, point and time; failures get ids
    that continue after the log's. ``broken`` (``payloads.read_checked``) is kept beside.
    """
    if loads.committed(load):
        return False
    pl.require_grid(grid)
    accepted, rejects = _judged(feeds, grid, key, whole_regions)
    for feed in feeds:
        rows = pl.explode_payloads(accepted[feed.name], feed.section, feed.variables, tz, as_date=feed.as_date)
        table = TABLES[feed.name]
        order = [key, "point_no", "date" if feed.as_date else "ts"]
        loads.put(load, table, append_ids(rows, order, LANDED_IDS[table], existing=loads.ids_of(table)))
    loads.put(load, "extraction_failures", pl.dead_letters(rejects, run_ts, existing=loads.ids_of("extraction_failures")))
    if broken is not None:
        loads.put(load, "broken_payloads", broken.withColumn("run_ts", run_ts))
    loads.commit(load)
    return True


def _judged(feeds: Sequence[pl.Feed], grid: DataFrame, key: str, whole_regions: bool) -> tuple[Mapping[str, DataFrame], DataFrame]:
    if whole_regions:
        return pl.split_regions(feeds, grid, key)
    accepted, rejects = {}, None
    for feed in feeds:
        accepted[feed.name], bad = pl.split_complete(feed.payloads, feed.section, feed.variables, grid, key, per_day=not feed.as_date)
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return accepted, rejects
