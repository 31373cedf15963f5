"""Facts of the star schema.

Date and hour keys are derived on the row (``md5(date)``, ``hour(ts)``) instead of
joining the date and hour dimensions: the date dimension is built from these
very staging rows and the hour dimension holds every hour, so those inner joins
can only drop rows whose timestamp is null, which a filter does for free. Only
the grid-point join filters for real. Air quality is the exception: its dates
are checked against the weather-derived date dimension with a semi-join on the
date. Its rows are calendar dates, few however large the readings are, so it is broadcast:
a shuffle by date would put all readings into a task per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.functions.columns import surrogate_key

HOURLY_MEASURES = (
    "temperature_2m", "cloud_cover_pct", "direct_radiation_w_m2", "shortwave_radiation_w_m2",
    "wind_speed_80m_kmh", "wind_direction_80m_deg", "precipitation_mm", "visibility_m",
    "weather_code_wmo",
)
DAILY_MEASURES = (
    "temp_max_2m", "temp_mean_2m", "temp_min_2m", "precipitation_sum_mm", "rain_sum_mm",
    "precipitation_probability_max_pct", "sunshine_duration_sec", "daylight_duration_sec",
    "wind_speed_max_10m_kmh", "wind_gusts_max_10m_kmh", "shortwave_radiation_sum_mj_m2",
)
AIR_MEASURES = ("pm10", "pm2_5", "dust")

# Columns of each fact as published; the internal frames also carry region and date.
FACT_HOURLY_WEATHER_COLS = ("grid_point_id", "date_id", "hour_id", *HOURLY_MEASURES, "sunshine_state", "visibility_alert")
FACT_DAILY_WEATHER_COLS = ("grid_point_id", "date_id", *DAILY_MEASURES)
FACT_HOURLY_AIR_COLS = ("grid_point_id", "date_id", "hour_id", *AIR_MEASURES)


def _points(dim_gp: DataFrame) -> DataFrame:
    return dim_gp.select("grid_point_id", "region_id", "point_no", "region_name")


def _hour_keys(df: DataFrame) -> DataFrame:
    # staging already carries the grain columns date = to_date(ts), hour_id = hour(ts)
    return df.withColumn("date_id", surrogate_key("date"))


def fact_hourly_weather(stg_hourly: DataFrame, dim_gp: DataFrame) -> DataFrame:
    f = stg_hourly.filter(F.col("ts").isNotNull()).drop("region_name")
    f = f.join(_points(dim_gp), ["region_id", "point_no"], "inner")
    f = _hour_keys(f)
    return f.select(
        "grid_point_id", "region_id", "point_no", "region_name", "date", "date_id", "hour_id",
        *HOURLY_MEASURES, "sunshine_state", "visibility_alert",
    )


def fact_daily_weather(stg_daily: DataFrame, dim_gp: DataFrame) -> DataFrame:
    f = stg_daily.filter(F.col("date").isNotNull()).drop("region_name")
    f = f.join(_points(dim_gp), ["region_id", "point_no"], "inner")
    return f.select(
        "grid_point_id", "region_id", "region_name", "date", surrogate_key("date").alias("date_id"),
        *DAILY_MEASURES,
    )


def fact_hourly_air_quality(stg_air: DataFrame, dim_gp: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = stg_air.filter(F.col("ts").isNotNull()).drop("region_name")
    f = f.join(_points(dim_gp), ["region_id", "point_no"], "inner")
    f = _hour_keys(f)
    # a reading on a date the weather never saw is dropped, as the date join does
    f = f.join(F.broadcast(dim_date.select("date")), "date", "left_semi")
    return f.select("grid_point_id", "region_id", "point_no", "region_name", "date", "date_id", "hour_id", *AIR_MEASURES)
