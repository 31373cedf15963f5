"""Payloads built from readings: test input in the shape of the API's responses.

A payload covers its whole axis, with nulls where no reading landed. The axis is made from
the readings: it has the coarsest usual step on which all of a group's readings lie, and an
hourly payload runs from one local midnight to the next, so readings off the hour and the
longer and shorter days of a clock change keep their place. Groups are bounded: one point
and local day, or one point and refresh of ``DAYS`` days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.sources.payloads import DAILY_VARIABLES, DAY, HOURLY_VARIABLES, epoch_from_local

#: Steps in seconds that an hourly axis can have, coarsest first.
STEPS = (3600, 1800, 900, 600, 300, 60, 1)
#: Days of a daily payload, counted from ``BASE``.
DAYS, BASE = 14, "2026-08-20"


def _at(column: str):
    return lambda t: F.try_element_at(F.col("_m"), t)[column]


def _series(axis_start: Column, axis_end: Column, step: Column, variables) -> Column:
    """A series struct over the axis; each array looks its slot's epoch up in the collected
    (epoch -> values) map."""
    axis = F.sequence(axis_start, axis_end - step, step)
    arrays = [F.transform(axis, _at(c)).alias(api) for api, c in variables]
    return F.struct(axis_start.alias("time"), axis_end.alias("time_end"), step.alias("interval"), *arrays)


def _collected(df: DataFrame, keys, variables, **more: Column) -> DataFrame:
    entries = F.collect_list(F.struct(F.col("_t"), F.struct(*[F.col(c) for _, c in variables])))
    grouped = df.groupBy(*keys).agg(entries.alias("_l"), *[x.alias(n) for n, x in more.items()])
    return grouped.withColumn("_m", F.map_from_entries("_l")).drop("_l")


def hourly_payloads(readings: DataFrame, tz: str, variables=HOURLY_VARIABLES, keyed_by_id: bool = True) -> DataFrame:
    """One payload per (point, local day)."""
    keys = (["region_id"] if keyed_by_id else []) + ["region_name", "point_no", "latitude", "longitude"]
    midnight = lambda d: epoch_from_local(d.cast("timestamp_ntz"), tz)
    df = readings.select(
        *keys, *[c for _, c in variables],
        epoch_from_local(F.col("ts"), tz).alias("_t"),
        midnight(F.to_date("ts")).alias("_from"),
        midnight(F.date_add(F.to_date("ts"), 1)).alias("_to"),
    )
    fits = {f"_fits{s}": F.min(((F.col("_t") - F.col("_from")) % s == 0).cast("int")) for s in STEPS}
    g = _collected(df, [*keys, "_from", "_to"], variables, **fits)
    step = F.coalesce(*[F.when(F.col(f"_fits{s}") == 1, F.lit(s)) for s in STEPS]).cast("long")
    return g.select(*keys, _series(F.col("_from"), F.col("_to"), step, variables).alias("hourly"))


def daily_payloads(readings: DataFrame, tz: str) -> DataFrame:
    """One payload per point and refresh: daily slots from its first to its last date."""
    keys = ["region_id", "region_name", "point_no", "latitude", "longitude"]
    refresh = F.floor(F.date_diff(F.col("date"), F.lit(BASE).cast("date")) / DAYS)
    df = readings.select(
        *keys, *[c for _, c in DAILY_VARIABLES], refresh.alias("_run"),
        epoch_from_local(F.col("date").cast("timestamp_ntz"), tz).alias("_t"),
    )
    g = _collected(df, [*keys, "_run"], DAILY_VARIABLES, _from=F.min("_t"), _to=F.max("_t"))
    return g.select(*keys, _series(F.col("_from"), F.col("_to") + DAY, F.lit(DAY).cast("long"), DAILY_VARIABLES).alias("daily"))
