"""The data-quality suite: every declared check, on every table of the model graph,
plus source-level checks on the landed tables (where duplicates and bad names live)
and two planted checks with a deliberately narrowed set, so the value-set and
accepted-values paths are seen failing as well as passing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.functions.columns import NIGHT, PERIODS, SUNSHINE_LABELS
from gridops.operators.quality import (
    ROW_LOCAL,
    Check,
    accepted,
    in_range,
    not_null,
    relationship,
    unique,
    unique_combo,
    value_set,
)
from gridops.plans.graph import ModelGraph, shared_models

GP, DD, DH = "dim_grid_point", "dim_date", "dim_hour"
FHW, FDW, FAQ = "fact_hourly_weather", "fact_daily_weather", "fact_hourly_air_quality"


def _fk(table: str, *dims: str) -> list[Check]:
    keys = {GP: "grid_point_id", DD: "date_id", DH: "hour_id"}
    out: list[Check] = []
    for d in dims:
        out += not_null(table, keys[d]) + [relationship(table, keys[d], d, keys[d])]
    return out


CHECKS: list[Check] = [
    # landed sources
    *not_null("regions", "region_id", "region_name", "latitude", "longitude", "area_km2"),
    in_range("regions", "area_km2", min=0, strict=True),
    unique("regions", "region_name"),
    unique_combo("raw_hourly", "region_id", "point_no", "ts"),
    unique("stg_hourly", "id_hourly"),
    relationship("raw_air_quality", "region_name", "regions", "region_name"),
    # staging
    *not_null("grid_points", "region_id", "point_no", "grid_lat", "grid_lon"),
    unique("stg_daily", "id_daily"),
    *not_null("stg_daily", "date", "region_name", "point_no", "latitude", "longitude", "temp_max_2m",
              "temp_mean_2m", "temp_min_2m", "precipitation_sum_mm", "rain_sum_mm",
              "precipitation_probability_max_pct", "sunshine_duration_sec", "daylight_duration_sec",
              "wind_speed_max_10m_kmh", "wind_gusts_max_10m_kmh", "shortwave_radiation_sum_mj_m2",
              "sunshine_state"),
    *[in_range("stg_daily", c, min=0) for c in (
        "precipitation_sum_mm", "rain_sum_mm", "sunshine_duration_sec", "daylight_duration_sec",
        "wind_speed_max_10m_kmh", "wind_gusts_max_10m_kmh", "shortwave_radiation_sum_mj_m2")],
    in_range("stg_daily", "precipitation_probability_max_pct", min=0, max=100),
    value_set("stg_daily", "sunshine_state", SUNSHINE_LABELS),
    *not_null("stg_hourly", "ts", "region_name", "point_no", "latitude", "longitude", "temperature_2m",
              "cloud_cover_pct", "direct_radiation_w_m2", "shortwave_radiation_w_m2", "wind_speed_80m_kmh",
              "wind_direction_80m_deg", "precipitation_mm", "visibility_m", "visibility_km",
              "weather_code_wmo", "sunshine_state"),
    *[in_range("stg_hourly", c, min=0) for c in (
        "temperature_2m", "direct_radiation_w_m2", "shortwave_radiation_w_m2", "wind_speed_80m_kmh",
        "precipitation_mm", "weather_code_wmo")],
    in_range("stg_hourly", "cloud_cover_pct", min=0, max=100),
    in_range("stg_hourly", "wind_direction_80m_deg", min=0, max=360),
    in_range("stg_hourly", "visibility_m", min=0, strict=True),
    in_range("stg_hourly", "visibility_km", min=0, strict=True),
    value_set("stg_hourly", "sunshine_state", SUNSHINE_LABELS),
    # dimensions
    unique(GP, "grid_point_id"),
    *not_null(GP, "grid_point_id", "region_id", "region_name", "point_no"),
    in_range(GP, "grid_lat", min=12, max=17),
    in_range(GP, "grid_lon", min=-18, max=-11),
    unique_combo(GP, "region_id", "point_no"),
    unique(DD, "date_id"), *not_null(DD, "date_id"), unique(DD, "date"), *not_null(DD, "date"),
    unique(DH, "hour_id"), *not_null(DH, "hour_id"), unique(DH, "hour"), *not_null(DH, "hour"),
    in_range(DH, "hour", min=0, max=23),
    value_set(DH, "period_of_day", [p[2] for p in PERIODS] + [NIGHT]),
    value_set(DH, "period_of_day", [p[2] for p in PERIODS], label="planted"),
    # facts
    *_fk(FHW, GP, DD, DH),
    in_range(FHW, "shortwave_radiation_w_m2", min=0, max=1400),
    in_range(FHW, "wind_speed_80m_kmh", min=0, max=250),
    unique_combo(FHW, "grid_point_id", "date_id", "hour_id"),
    *_fk(FDW, GP, DD),
    unique_combo(FDW, "grid_point_id", "date_id"),
    *_fk(FAQ, GP, DD, DH),
    in_range(FAQ, "pm10", min=0, max=2000),
    unique_combo(FAQ, "grid_point_id", "date_id", "hour_id"),
    # indicators
    *_fk("kpi_generation_potential", GP),
    *not_null("kpi_generation_potential", "solar_score", "wind_score"),
    in_range("kpi_generation_potential", "solar_score", min=0, max=100),
    in_range("kpi_generation_potential", "wind_score", min=0, max=100),
    in_range("kpi_generation_potential", "kpi_potential_score", min=0, max=100),
    in_range("kpi_generation_potential", "performance_ratio", min=0, max=1.1),
    unique_combo("kpi_generation_potential", "grid_point_id", "date_id", "hour_id"),
    in_range("kpi_grid_stability", "pct_drop_from_clear_sky", min=0, max=100),
    accepted("kpi_grid_stability", "grid_stability_risk", (0, 1)),
    accepted("kpi_grid_stability", "generator_activation_recommended", (0, 1)),
    unique_combo("kpi_grid_stability", "grid_point_id", "date_id", "hour_id"),
    in_range("kpi_dust_risk", "harmattan_risk_score", min=0, max=100),
    accepted("kpi_dust_risk", "harmattan_risk_score", (0, 30, 60, 100)),
    accepted("kpi_dust_risk", "harmattan_risk_score", (0, 30, 60), label="planted"),
    unique_combo("kpi_dust_risk", "grid_point_id", "date_id", "hour_id"),
    *not_null("kpi_maintenance", "region_id"),
    accepted("kpi_maintenance", "is_ideal_hour", (True, False)),
    unique_combo("kpi_maintenance", "region_id", "date_id", "hour_id"),
    *not_null("maintenance_windows", "window_length_hours"),
    in_range("maintenance_windows", "window_length_hours", min=1, max=24),
]


TABLES = {
    "regions": lambda g: g.regions,
    "raw_hourly": lambda g: g.raw_hourly,
    "raw_air_quality": lambda g: g.raw_air_quality.withColumn("region_name", F.trim("region_name")),
    "grid_points": lambda g: g.grid_points,
    "stg_hourly": lambda g: g.stg_hourly,
    "stg_daily": lambda g: g.stg_daily,
    GP: lambda g: g.dim_grid_point,
    DD: lambda g: g.dim_date,
    DH: lambda g: g.dim_hour,
    FHW: lambda g: g.fact_hourly_weather,
    FDW: lambda g: g.fact_daily_weather,
    FAQ: lambda g: g.fact_hourly_air_quality,
    "kpi_generation_potential": lambda g: g.kpi_generation_potential,
    "kpi_grid_stability": lambda g: g.kpi_grid_stability,
    "kpi_dust_risk": lambda g: g.kpi_dust_risk,
    "kpi_maintenance": lambda g: g.kpi_maintenance,
    "maintenance_windows": lambda g: g.maintenance_windows,
}


#: What tells the rows of a table apart, in reports of failing rows.
_POINT_HOUR = ("grid_point_id", "date_id", "hour_id")
KEYS = {
    "regions": ("region_id",),
    "raw_hourly": ("id_hourly",),
    "raw_air_quality": ("load_seq",),
    "grid_points": ("region_id", "point_no"),
    "stg_hourly": ("id_hourly",),
    "stg_daily": ("id_daily",),
    GP: ("grid_point_id",), DD: ("date_id",), DH: ("hour_id",),
    FHW: _POINT_HOUR, FDW: ("grid_point_id", "date_id"), FAQ: _POINT_HOUR,
    "kpi_generation_potential": _POINT_HOUR,
    "kpi_grid_stability": _POINT_HOUR,
    "kpi_dust_risk": _POINT_HOUR,
    "kpi_maintenance": ("region_id", "date_id", "hour_id"),
    "maintenance_windows": ("region_id", "date_id", "window_start_hour"),
}


def tables_used(checks) -> set[str]:
    return {c.table for c in checks} | {c.to_table for c in checks if c.to_table}


def tables(g: ModelGraph, names=None) -> dict[str, DataFrame]:
    """Name -> frame for the tables a check can name (only ``names`` if given)."""
    return {k: f(g) for k, f in TABLES.items() if names is None or k in names}


def shared(checks) -> frozenset[str]:
    """The models that a run of ``checks`` reads more than once. A table is scanned once for
    its row-local checks, once for its key checks, and for each relationship."""
    scans = {(c.table, "row" if c.kind in ROW_LOCAL else "key") for c in checks if c.kind != "relationship"}
    names = [t for t, _ in scans]
    names += [t for c in checks if c.kind == "relationship" for t in (c.table, c.to_table)]
    return shared_models(names)


def checks_of(kind: str | None = None) -> list[Check]:
    return [c for c in CHECKS if kind is None or c.kind == kind]
