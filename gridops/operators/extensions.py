"""Indicators declared upstream but never implemented there (our own definitions):
maintenance windows per region-day, capacity sizing per region, solar coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.functions.columns import round_half_away
from gridops.operators import runs
from gridops.operators.grid import valid_regions
from gridops.params import DEFAULT, Params


def maintenance_windows(kpi_maint: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Contiguous runs of ideal hours per (region, date), read off the day's hours as bits. A
    false or unknown hour breaks a window. ``meets_min_length`` flags windows long enough to schedule."""
    day = ["region_id", "region_name", "date", "date_id"]
    days = kpi_maint.filter(F.col("is_ideal_hour")).groupBy(*day).agg(runs.packed("hour").alias("_ideal"))
    windows = days.select(*day, "_ideal", F.explode(runs.starts("_ideal")).alias("window_start_hour"))
    windows = windows.withColumn("window_length_hours", runs.upward("_ideal", "window_start_hour"))
    return windows.select(
        *day, "window_start_hour",
        (F.col("window_start_hour") + F.col("window_length_hours") - 1).alias("window_end_hour"),
        "window_length_hours",
        (F.col("window_length_hours") >= params.maintenance_min_window_hours).alias("meets_min_length"),
    )


def capacity_sizing(regions: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Installable PV per region if a fixed share of its land were used: hectares =
    km2 * 100 * share; kW and panel count from per-hectare densities."""
    ha = F.col("area_km2") * F.lit(100.0) * F.lit(params.default_solar_land_pct)
    return valid_regions(regions).select(
        "region_id", "region_name", "area_km2",
        ha.alias("usable_land_ha"),
    ).select(
        "region_id", "region_name", "area_km2", "usable_land_ha",
        round_half_away(F.col("usable_land_ha") * F.lit(params.capacity_kw_per_ha), 1).alias("capacity_kw"),
        round_half_away(F.col("usable_land_ha") * F.lit(params.panels_per_ha), 0).cast("long").alias("panel_count"),
    )


def solar_coverage(fact_hw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per point-day: hours at or above the producing irradiance, out of all hours."""
    producing = F.when(F.col("shortwave_radiation_w_m2") >= F.lit(params.solar_coverage_threshold_w_m2), 1).otherwise(0)
    agg = fact_hw.groupBy("grid_point_id", "region_id", "date", "date_id").agg(
        F.sum(producing).cast("long").alias("producing_hours"),
        F.count(F.lit(1)).alias("total_hours"),
    )
    return agg.withColumn(
        "coverage_pct",
        round_half_away(F.lit(100.0) * F.col("producing_hours") / F.col("total_hours"), 1),
    )
