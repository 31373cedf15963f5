"""Operational indicators: generation potential, grid stability, dust, maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.functions.columns import clamp, round_half_away
from gridops.operators import runs
from gridops.operators.islands import with_islands
from gridops.params import DEFAULT, Params


def kpi_generation_potential(fact_hw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    p = params
    g = F.col("shortwave_radiation_w_m2")
    t = F.col("temperature_2m")
    v = F.col("wind_speed_80m_kmh") / F.lit(3.6)
    cut3, rated3 = p.wind_cutin_speed_ms ** 3, p.wind_rated_speed_ms ** 3
    cell = t + F.lit((p.pv_noct_c - 20.0) / 800.0) * g
    g_rel = g / F.lit(p.solar_reference_irradiance_w_m2)
    solar_score = clamp(g_rel * F.lit(100))
    density = F.lit(0.5 * p.air_density_kg_m3) * F.pow(v, 3)
    ramp = clamp((F.pow(v, 3) - F.lit(cut3)) / F.lit(rated3 - cut3) * F.lit(100))
    wind_score = (
        F.when(v < F.lit(p.wind_cutin_speed_ms), F.lit(0.0))
        .when(v >= F.lit(p.wind_rated_speed_ms), F.lit(100.0))
        .otherwise(ramp)
    )
    ratio = F.lit(1) + F.lit(p.pv_gamma_per_c) * (F.col("cell_temp_c") - F.lit(p.pv_tstc_c))
    base = fact_hw.select(
        "grid_point_id", "region_id", "date", "date_id", "hour_id",
        g.alias("g"), t.alias("t"),
        v.alias("wind_speed_ms"),
        cell.alias("cell_temp_c"),
        solar_score.alias("solar_score"),
        density.alias("wind_power_density_w_m2"),
        wind_score.alias("wind_score"),
    )
    return base.select(
        "grid_point_id", "region_id", "date", "date_id", "hour_id",
        round_half_away("g", 1).alias("shortwave_radiation_w_m2"),
        round_half_away("t", 1).alias("temperature_2m"),
        round_half_away("cell_temp_c", 1).alias("cell_temp_c"),
        round_half_away(ratio, 4).alias("performance_ratio"),
        round_half_away(F.lit(p.pv_nominal_power_kw) * ratio * (F.col("g") / F.lit(p.solar_reference_irradiance_w_m2)), 4)
        .alias("solar_output_kwh_per_kw"),
        round_half_away("solar_score", 1).alias("solar_score"),
        round_half_away("wind_speed_ms", 2).alias("wind_speed_ms"),
        round_half_away("wind_power_density_w_m2", 1).alias("wind_power_density_w_m2"),
        round_half_away("wind_score", 1).alias("wind_score"),
        round_half_away(
            (F.coalesce("solar_score", F.lit(0.0)) + F.coalesce("wind_score", F.lit(0.0))) / F.lit(2), 1
        ).alias("kpi_potential_score"),
    )


def _drop(radiation: Column, params: Params) -> Column:
    cs = params.clear_sky_peak_radiation_w_m2
    return clamp((F.lit(cs) - radiation) / F.lit(cs) * F.lit(100))


def _risk(radiation: Column, params: Params) -> Column:
    return F.when(_drop(radiation, params) > F.lit(float(params.grid_risk_threshold_pct)), 1).otherwise(0)


def _with_risk(hours: DataFrame, params: Params) -> DataFrame:
    g = F.col("shortwave_radiation_w_m2")
    return hours.withColumns({
        "clear_sky_reference_w_m2": F.lit(params.clear_sky_peak_radiation_w_m2).cast("int"),
        "pct_drop_from_clear_sky": _drop(g, params),
        "grid_stability_risk": _risk(g, params),
    })


def _peak_hours(fact_hw: DataFrame, dim_hour: DataFrame, params: Params) -> DataFrame:
    # filter hour_id on the fact itself (it equals the hour by construction), so the
    # predicate sits below every join and exchange
    f = fact_hw.filter(F.col("hour_id").between(params.peak_hour_start, params.peak_hour_end))
    f = f.join(F.broadcast(dim_hour.select("hour_id", "hour")), "hour_id")
    return _with_risk(f.select("grid_point_id", "region_id", "region_name", "date", "date_id", "hour_id", "hour", "shortwave_radiation_w_m2"), params)


def risk_islands(fact_hw: DataFrame, dim_hour: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Peak-window rows with their run id and run length, per (point, date, risk).

    A point-day is one group of a hash aggregate: its peak hours' radiation in a column each
    and the hours seen as bits. Its rows, risky hours and runs are read off that, and nothing
    is sorted. One reading per point and hour (of copies the one of the highest radiation)."""
    day = ["grid_point_id", "region_id", "region_name", "date", "date_id"]
    hours = range(params.peak_hour_start, params.peak_hour_end + 1)
    peak = fact_hw.filter(F.col("hour_id").between(hours.start, hours.stop - 1))
    at = {h: F.max(F.when(F.col("hour_id") == h, F.col("shortwave_radiation_w_m2"))) for h in hours}
    days = peak.groupBy(*day).agg(runs.packed("hour_id").alias("_seen"), *[x.alias(f"_g{h}") for h, x in at.items()])
    risky = sum((F.when(_risk(F.col(f"_g{h}"), params) == 1, F.lit(1 << h)).otherwise(F.lit(0)) for h in hours), F.lit(0).cast("long"))
    slots = F.array(*[F.struct(F.lit(h).cast("long").alias("hour_id"), F.col(f"_g{h}").alias("shortwave_radiation_w_m2")) for h in hours])
    rows = days.withColumn("_risky", risky).select(*day, "_seen", "_risky", F.inline(slots)).filter("getbit(_seen, cast(hour_id as int)) = 1")
    rows = _with_risk(rows.join(F.broadcast(dim_hour.select("hour_id", "hour")), "hour_id"), params)
    rows = rows.withColumn("_run", F.expr("if(grid_stability_risk = 1, _risky, _seen & ~_risky)"))
    island, run = F.col("hour") - runs.rank("_run", "hour"), runs.length("_run", "hour")
    return rows.withColumns({"risk_grp": island.cast("long"), "consecutive_hours": run}).drop("_seen", "_risky", "_run")


def _stability_output(df: DataFrame, activation) -> DataFrame:
    return df.select(
        "grid_point_id", "region_id", "region_name", "date", "date_id", "hour_id", "hour",
        round_half_away("shortwave_radiation_w_m2", 1).alias("shortwave_radiation_w_m2"),
        "clear_sky_reference_w_m2",
        round_half_away("pct_drop_from_clear_sky", 1).alias("pct_drop_from_clear_sky"),
        "grid_stability_risk",
        activation.alias("generator_activation_recommended"),
    )


def kpi_grid_stability(fact_hw: DataFrame, dim_hour: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Risk = drop from clear sky above the threshold; activation = the hour lies in
    a risky run of at least ``grid_risk_persistence_hours`` consecutive peak hours.
    One pass: one hash aggregate, no sort and no self-join."""
    found = risk_islands(fact_hw, dim_hour, params)
    act = F.when(
        (F.col("grid_stability_risk") == 1) & (F.col("consecutive_hours") >= params.grid_risk_persistence_hours), 1
    ).otherwise(0)
    return _stability_output(found, act)


def risk_hours_exists(fact_hw: DataFrame, dim_hour: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The activation flag in its existence form: flag = 1 iff the (point, date, hour)
    appears among risky hours of a long-enough run (left join on the key set)."""
    flagged = _peak_hours(fact_hw, dim_hour, params)
    islands = with_islands(
        flagged.filter(F.col("grid_stability_risk") == 1), ["grid_point_id", "date_id"], "hour", "risk_grp", "consecutive_hours"
    )
    hits = (
        islands.filter(F.col("consecutive_hours") >= params.grid_risk_persistence_hours)
        .select("grid_point_id", "date_id", "hour_id", F.lit(1).alias("hit"))
    )
    out = flagged.join(hits, ["grid_point_id", "date_id", "hour_id"], "left")
    return out.select(
        "grid_point_id", "date_id", "hour_id",
        F.coalesce("hit", F.lit(0)).alias("generator_activation_recommended"),
    )


def kpi_grid_stability_selfjoin(fact_hw: DataFrame, dim_hour: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Upstream's shape (run lengths joined back onto every peak row); kept to
    measure against the one-pass form."""
    flagged = _peak_hours(fact_hw, dim_hour, params)
    flag = risk_hours_exists(fact_hw, dim_hour, params)
    j = flagged.join(flag, ["grid_point_id", "date_id", "hour_id"], "inner")
    return _stability_output(j, F.col("generator_activation_recommended"))


def kpi_dust_risk(fact_air: DataFrame, params: Params = DEFAULT) -> DataFrame:
    d = F.col("dust")
    score = (
        F.when(d >= F.lit(params.dust_severe), 100)
        .when(d >= F.lit(params.dust_moderate), 60)
        .when(d >= F.lit(params.dust_light), 30)
        .otherwise(0)
    )
    return fact_air.select(
        "grid_point_id", "region_id", "region_name", "date", "date_id", "hour_id", "pm10", "dust",
        score.alias("harmattan_risk_score"),
    )


def kpi_maintenance(fact_hw: DataFrame, fact_air: DataFrame, dim_hour: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Region-hour roll-up of point rows; an hour is ideal when mean wind, total
    rain and mean pm10 are all under their limits (missing air quality counts as
    clean unless ``require_air_quality``). Three-valued: null stays null."""
    # (region_id, point_no) is the grid point and date the date key: joining on the
    # staging grain lets both sides keep the partitioning of their de-duplication
    key = ["region_id", "point_no", "date", "hour_id"]
    w = fact_hw.select(*key, "region_name", "date_id", "wind_speed_80m_kmh", "precipitation_mm")
    a = fact_air.select(*key, "pm10")
    agg = (
        w.join(a, key, "left")
        .groupBy("region_id", "region_name", "date", "date_id", "hour_id")
        .agg(
            F.avg("wind_speed_80m_kmh").alias("wind"),
            F.sum("precipitation_mm").alias("rain"),
            F.avg("pm10").alias("pm10"),
        )
    )
    pm = F.col("pm10") if params.require_air_quality else F.coalesce("pm10", F.lit(0.0))
    ideal = (
        (F.col("wind") <= F.lit(float(params.maintenance_max_wind_kmh)))
        & (F.col("rain") == F.lit(0.0))
        & (pm <= F.lit(float(params.maintenance_max_pm10)))
    )
    return agg.join(F.broadcast(dim_hour.select("hour_id", "hour")), "hour_id").select(
        "region_id", "region_name", "date", "date_id", "hour_id", "hour",
        round_half_away("wind", 1).alias("avg_wind_speed_80m_kmh"),
        F.col("rain").alias("total_precipitation_mm"),
        round_half_away("pm10", 1).alias("avg_pm10"),
        ideal.alias("is_ideal_hour"),
    )
