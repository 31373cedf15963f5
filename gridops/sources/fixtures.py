"""Landed raw tables derived from the benchmark tables.

The engine's real inputs are the landed readings (raw hourly weather, raw daily
weather, raw air quality) and the region seed. For testing and benchmarking at
every scale they are derived, row for row, from the driver's parquet tables:

    regions      <- supplier      hourly  <- lineitem
    daily        <- orders        air     <- events

All expressions are narrow (per-row) projections: no join, no shuffle, so a raw
table is exactly as parallel as the parquet scan that feeds it. Every measure is a
multiple of 1/8, so sums are exact in any order. The same expressions are written
independently as DuckDB SQL in ``gridops.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.functions.columns import idiv

# fixed values of the derivation: base day of the landed window
BASE_TS = "2026-08-20 00:00:00"
BASE_DATE = "2026-08-20"
REGION_NAME_PREFIX = "Supplier#"
# what orders the loads of hourly readings
LOAD_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(c: Column) -> Column:
    return F.round(c * F.lit(100.0), 0).cast("long")


def _region_name(idx: Column) -> Column:
    return F.concat(F.lit(REGION_NAME_PREFIX), F.lpad(idx.cast("string"), 9, "0"))


def _centroid_lat(idx: Column) -> Column:
    return F.when(idx % 25 == 23, F.lit(None).cast("double")).otherwise(
        F.lit(12.5) + (idx % 32) / F.lit(8)
    )


def _centroid_lon(idx: Column) -> Column:
    return F.lit(-17.0) + ((idx * 7) % 40) / F.lit(8)


def _base_ts() -> Column:
    return F.lit(BASE_TS).cast("timestamp_ntz")


def _add_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region seed: id, name, centroid and area. Some rows are invalid on purpose
    (null latitude, zero area) so the validity filter has work to do."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        (k + 1).alias("region_id"),
        F.col("s_name").alias("region_name"),
        _centroid_lat(k).alias("latitude"),
        _centroid_lon(k).alias("longitude"),
        F.when(k % 25 == 24, F.lit(0.0))
        .otherwise(F.lit(13.0) + (cents(F.abs(F.col("s_acctbal"))) % 1440000) / F.lit(64))
        .alias("area_km2"),
    )


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hourly weather readings; duplicates per (region, point, ts) are intended
    (overlapping refreshes). ``load_seq`` orders loads: a larger value is newer."""
    return hourly_readings(read_table(spark, sf_dir, "lineitem"), F.struct(*LOAD_ORDER).alias("load_seq"))


def hourly_readings(li: DataFrame, *more: Column) -> DataFrame:
    """A reading of each row, with the columns ``more``."""
    k = F.col("l_suppkey")
    p = cents(F.col("l_extendedprice"))
    d = cents(F.col("l_discount"))
    sw = (p % 8800) / F.lit(8)
    hours = (F.col("l_linenumber") % 2) * 24 + (F.col("l_orderkey") % 24)
    return li.select(
        _add_hours(_base_ts(), hours).alias("ts"),
        (k + 1).alias("region_id"),
        _region_name(k).alias("region_name"),
        (F.col("l_partkey") % 16 + 1).alias("point_no"),
        _centroid_lat(k).alias("latitude"),
        _centroid_lon(k).alias("longitude"),
        (F.lit(15.0) + F.col("l_quantity") / F.lit(2)).alias("temperature_2m"),
        (p % 101).cast("double").alias("cloud_cover_pct"),
        (sw / F.lit(2)).alias("direct_radiation_w_m2"),
        sw.alias("shortwave_radiation_w_m2"),
        F.col("l_quantity").cast("double").alias("wind_speed_80m_kmh"),
        (F.col("l_orderkey") % 361).cast("double").alias("wind_direction_80m_deg"),
        F.when(d >= 9, (d - 8) * F.lit(0.5)).otherwise(F.lit(0.0)).alias("precipitation_mm"),
        ((p % 101) * 250).cast("double").alias("visibility_m"),
        F.col("l_linenumber").cast("double").alias("weather_code_wmo"),
        *more,
    )


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily weather readings; ``id_daily`` is the load id (larger = newer)."""
    o = read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    ridx = idiv(F.col("o_custkey"), 15)
    frac = (ok % 80) / F.lit(8)
    wind = (ok % 320) / F.lit(8)
    return o.select(
        (ok + 1).alias("id_daily"),
        F.date_add(F.lit(BASE_DATE).cast("date"), (idiv(ok, 16) % 14).cast("int")).alias("date"),
        (ridx + 1).alias("region_id"),
        _region_name(ridx).alias("region_name"),
        (ok % 16 + 1).alias("point_no"),
        _centroid_lat(ridx).alias("latitude"),
        _centroid_lon(ridx).alias("longitude"),
        (F.lit(30.0) + frac).alias("temp_max_2m"),
        (F.lit(25.0) + frac).alias("temp_mean_2m"),
        (F.lit(20.0) + frac).alias("temp_min_2m"),
        ((ok % 24) / F.lit(8)).alias("precipitation_sum_mm"),
        ((ok % 16) / F.lit(8)).alias("rain_sum_mm"),
        (ok % 101).cast("double").alias("precipitation_probability_max_pct"),
        ((ok % 25) * 1800).cast("double").alias("sunshine_duration_sec"),
        ((ok % 16) * 450 + 39600).cast("double").alias("daylight_duration_sec"),
        wind.alias("wind_speed_max_10m_kmh"),
        (wind + F.lit(5.0)).alias("wind_gusts_max_10m_kmh"),
        ((cents(F.col("o_totalprice")) % 3600) / F.lit(8)).alias("shortwave_radiation_sum_mj_m2"),
    )


def raw_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hourly air quality. Keyed by a padded region *name* (no id), so staging
    must trim before matching; ``load_seq`` orders loads."""
    e = read_table(spark, sf_dir, "events")
    u = F.col("user_id")
    hours = (F.dayofmonth("ts") % 2) * 24 + F.hour("ts")
    pm10 = (cents(F.col("value")) % 800) / F.lit(8)
    return e.select(
        _add_hours(_base_ts(), hours).alias("ts"),
        F.concat(F.lit(" "), _region_name(u), F.lit("  ")).alias("region_name"),
        (F.col("event_id") % 16 + 1).alias("point_no"),
        _centroid_lat(u).alias("latitude"),
        _centroid_lon(u).alias("longitude"),
        pm10.alias("pm10"),
        (pm10 / F.lit(2)).alias("pm2_5"),
        F.col("value").alias("dust"),
        F.col("event_id").alias("load_seq"),
    )
