"""Staging: typed, labelled, de-duplicated readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.functions.columns import sunshine_state
from gridops.operators.dedup import latest_reading
from gridops.params import DEFAULT, Params

HOURLY_KEY = ("region_id", "point_no", "ts")
# What latest readings are grouped on: the key, and the region's name, which the id
# decides. Grouping on the string keeps it out of the aggregation buffer, where it would
# turn the hash aggregate into a sorting one.
HOURLY_GROUP = (*HOURLY_KEY, "region_name")
DAILY_KEY = ("region_id", "point_no", "date")
DAILY_GROUP = (*DAILY_KEY, "region_name")
# What they are shuffled by: facts are joined to points and payloads grouped by them. A point
# has at most one reading per timestamp, so the largest is bounded by the period covered.
POINT = ("region_id", "point_no")
AIR_POINT = ("region_name", "point_no")
AIR_KEY = ("region_name", "point_no", "ts")


def with_grain(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("ts")).withColumn("hour_id", F.hour("ts").cast("long"))


def stg_hourly(raw: DataFrame, params: Params = DEFAULT, dedupe: bool | None = None) -> DataFrame:
    dedupe = params.dedupe_readings if dedupe is None else dedupe
    df = with_grain(latest_reading(raw, HOURLY_GROUP, "id_hourly", by=POINT) if dedupe else raw)
    vis_km = F.col("visibility_m") / F.lit(1000.0)
    return df.select(
        "id_hourly", "ts", "region_id", "region_name", "point_no", "latitude", "longitude",
        "temperature_2m", "cloud_cover_pct", "direct_radiation_w_m2", "shortwave_radiation_w_m2",
        "wind_speed_80m_kmh", "wind_direction_80m_deg", "precipitation_mm", "visibility_m",
        vis_km.alias("visibility_km"),
        "weather_code_wmo",
        sunshine_state(
            "shortwave_radiation_w_m2", params.radiation_sunny_threshold, params.radiation_cloudy_threshold
        ).alias("sunshine_state"),
        (vis_km <= F.lit(float(params.visibility_alert_km))).alias("visibility_alert"),
        "date", "hour_id",
    )


def stg_daily(raw: DataFrame, params: Params = DEFAULT, dedupe: bool | None = None) -> DataFrame:
    dedupe = params.dedupe_readings if dedupe is None else dedupe
    df = latest_reading(raw, DAILY_GROUP, "id_daily", by=POINT) if dedupe else raw
    sunny = params.daily_sunny_threshold if params.daily_sunny_threshold is not None else params.radiation_sunny_threshold
    cloudy = params.daily_cloudy_threshold if params.daily_cloudy_threshold is not None else params.radiation_cloudy_threshold
    return df.select(
        *[c for c in raw.columns],
        sunshine_state("shortwave_radiation_sum_mj_m2", sunny, cloudy).alias("sunshine_state"),
    )


def stg_air_quality(
    raw: DataFrame, grid: DataFrame, params: Params = DEFAULT, dedupe: bool | None = None
) -> DataFrame:
    """Trim the name, recover the region id by matching (name, point) against the
    grid (unmatched rows drop), and keep the newest load per region, point and
    timestamp. Region names are unique in the grid, so this equals de-duplicating by
    name first."""
    dedupe = params.dedupe_readings if dedupe is None else dedupe
    df = raw.withColumn("region_name", F.trim("region_name"))
    g = grid.select("region_name", "point_no", "region_id")
    df = df.join(g, ["region_name", "point_no"], "inner")
    if dedupe:
        df = latest_reading(df, HOURLY_GROUP, "load_seq", by=POINT)
    df = with_grain(df)
    return df.select("ts", "region_name", "point_no", "pm10", "pm2_5", "dust", "region_id", "date", "hour_id")
