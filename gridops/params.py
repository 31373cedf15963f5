"""All tunable model parameters in one frozen dataclass (one place, like project vars)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # grid generation: lattice coefficients (seed values), in units of half the
    # square root of the region's area
    km_per_deg_lat: float = 111.32
    grid_coefficients: tuple[float, ...] = (-1.5, -0.5, 0.5, 1.5)
    # sunshine classification (W/m2; applied to the daily MJ/m2 sum as well, as upstream does)
    radiation_sunny_threshold: float = 300.0
    radiation_cloudy_threshold: float = 150.0
    # optional separate daily thresholds; None = reuse the hourly ones (upstream behaviour)
    daily_sunny_threshold: float | None = None
    daily_cloudy_threshold: float | None = None
    visibility_alert_km: float = 5.0
    # wind
    air_density_kg_m3: float = 1.225
    wind_cutin_speed_ms: float = 3.0
    wind_rated_speed_ms: float = 12.0
    # solar
    solar_reference_irradiance_w_m2: float = 1000.0
    pv_nominal_power_kw: float = 1.0
    pv_noct_c: float = 45.0
    pv_gamma_per_c: float = -0.0035
    pv_tstc_c: float = 25.0
    # dust
    dust_light: float = 50.0
    dust_moderate: float = 150.0
    dust_severe: float = 300.0
    # maintenance
    maintenance_max_wind_kmh: float = 20.0
    maintenance_max_pm10: float = 50.0
    maintenance_min_window_hours: int = 3
    require_air_quality: bool = False
    # grid stability
    peak_hour_start: int = 11
    peak_hour_end: int = 15
    grid_risk_threshold_pct: float = 40.0
    solar_coverage_threshold_w_m2: float = 200.0
    clear_sky_peak_radiation_w_m2: int = 900
    grid_risk_persistence_hours: int = 2
    # capacity sizing
    panels_per_ha: float = 2094.5
    capacity_kw_per_ha: float = 681.8
    default_solar_land_pct: float = 0.01
    # ingestion
    timezone: str = "Africa/Dakar"
    # staging keeps the newest load per reading key (see operators.dedup)
    dedupe_readings: bool = True


DEFAULT = Params()
