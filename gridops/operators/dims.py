"""Dimensions: grid point, calendar date (from the data), hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.functions.columns import period_of_day, surrogate_key


def dim_grid_point(grid: DataFrame) -> DataFrame:
    return grid.select(
        surrogate_key("region_id", "point_no").alias("grid_point_id"),
        "region_id", "region_name", "point_no", "grid_lat", "grid_lon",
    )


def date_attributes(date_col: str = "date") -> list:
    d = F.col(date_col)
    return [
        surrogate_key(d).alias("date_id"),
        d.alias("date"),
        F.year(d).cast("long").alias("year"),
        F.month(d).cast("long").alias("month"),
        F.dayofmonth(d).cast("long").alias("day"),
        (F.dayofweek(d) - 1).cast("long").alias("day_of_week"),  # Sunday = 0
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
    ]


def dim_date(stg_hourly: DataFrame, stg_daily: DataFrame) -> DataFrame:
    """Distinct calendar dates of hourly and daily weather (air quality excluded).

    One union under one DISTINCT: each arm is reduced map-side by the partial
    aggregate, so only distinct dates per task cross the single shuffle.
    """
    dates = stg_hourly.select(F.to_date("ts").alias("date")).unionByName(stg_daily.select("date"))
    return dates.distinct().select(*date_attributes("date"))


def dim_hour(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("long")
    return spark.range(24).select(h.alias("hour_id"), h.alias("hour"), period_of_day(h).alias("period_of_day"))
