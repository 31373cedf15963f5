"""Hand-computed rows: every threshold edge, null path and run length."""

from datetime import date

import pytest

from gridops.operators import extensions, kpis
from gridops.operators.dims import dim_hour
from gridops.params import DEFAULT

FACT = ("grid_point_id string, region_id long, point_no long, region_name string, date date, date_id string, hour_id long, "
        "temperature_2m double, shortwave_radiation_w_m2 double, wind_speed_80m_kmh double, precipitation_mm double")
AIR = ("grid_point_id string, region_id long, point_no long, region_name string, date date, date_id string, "
       "hour_id long, pm10 double, dust double")


def _no(p: str) -> int:
    """point number of a test point name like 'p3' or 'a'"""
    return int(p[1:]) if p[1:].isdigit() else ord(p[0])
D = date(2026, 8, 20)


def fact(spark, rows):
    """rows: (point, hour, temperature, G, wind, rain), all in region 1 on one day."""
    return spark.createDataFrame([(p, 1, _no(p), "R", D, "d", h, t, g, w, rain) for p, h, t, g, w, rain in rows], FACT)


def test_solar(spark):
    f = fact(spark, [("a", 12, 30.0, 800.0, 0.0, 0.0), ("b", 12, 30.0, 1100.0, 0.0, 0.0), ("c", 12, 30.0, None, 0.0, 0.0)])
    k = {r.grid_point_id: r for r in kpis.kpi_generation_potential(f).collect()}
    a = k["a"]
    assert (a.cell_temp_c, a.performance_ratio, a.solar_output_kwh_per_kw, a.solar_score) == (55.0, 0.895, 0.716, 80.0)
    assert k["b"].solar_score == 100.0
    c = k["c"]
    assert c.solar_score == 0.0 and c.cell_temp_c is None and c.performance_ratio is None and c.solar_output_kwh_per_kw is None


def test_wind(spark):
    f = fact(spark, [("a", 12, 30.0, 800.0, 27.0, 0.0), ("b", 12, 30.0, 0.0, 10.7, 0.0),
                     ("c", 12, 30.0, 0.0, 43.3, 0.0), ("d", 12, 30.0, 0.0, None, 0.0)])
    k = {r.grid_point_id: r for r in kpis.kpi_generation_potential(f).collect()}
    a = k["a"]
    assert (a.wind_speed_ms, a.wind_power_density_w_m2, a.wind_score, a.kpi_potential_score) == (7.5, 258.4, 23.2, 51.6)
    assert k["b"].wind_score == 0.0 and k["c"].wind_score == 100.0
    d = k["d"]
    assert d.wind_score == 0.0 and d.wind_speed_ms is None and d.wind_power_density_w_m2 is None


def _stability(spark, rows):
    out = kpis.kpi_grid_stability(fact(spark, rows), dim_hour(spark))
    return {r.hour: r for r in out.collect()}


def test_stability_drop_risk_activation(spark):
    gs = [500.0, 530.0, 600.0, 539.0, None]
    s = _stability(spark, [("a", 11 + i, 30.0, g, 0.0, 0.0) for i, g in enumerate(gs)])
    assert [s[h].pct_drop_from_clear_sky for h in range(11, 16)] == [44.4, 41.1, 33.3, 40.1, 0.0]
    assert [s[h].grid_stability_risk for h in range(11, 16)] == [1, 1, 0, 1, 0]
    assert [s[h].generator_activation_recommended for h in range(11, 16)] == [1, 1, 0, 0, 0]
    assert all(s[h].clear_sky_reference_w_m2 == 900 for h in s)


def test_stability_edge_and_gap_and_scope(spark):
    s = _stability(spark, [("a", 12, 30.0, 540.0, 0.0, 0.0)])
    assert s[12].pct_drop_from_clear_sky == 40.0 and s[12].grid_stability_risk == 0
    gap = _stability(spark, [("a", 11, 30.0, 100.0, 0.0, 0.0), ("a", 13, 30.0, 100.0, 0.0, 0.0)])
    assert [gap[11].generator_activation_recommended, gap[13].generator_activation_recommended] == [0, 0]
    scope = _stability(spark, [("a", 10, 30.0, 100.0, 0.0, 0.0), ("a", 11, 30.0, 100.0, 0.0, 0.0)])
    assert sorted(scope) == [11] and scope[11].generator_activation_recommended == 0


def test_stability_one_pass_equals_selfjoin(spark):
    import random

    rnd = random.Random(7)
    rows = [(f"p{p}", h, 30.0, rnd.choice([100.0, 800.0, None]), 0.0, 0.0) for p in range(20) for h in range(8, 18) if rnd.random() < 0.8]
    f, dh = fact(spark, rows), dim_hour(spark)
    a = sorted(tuple(r) for r in kpis.kpi_grid_stability(f, dh).collect())
    b = sorted(tuple(r) for r in kpis.kpi_grid_stability_selfjoin(f, dh).select(*kpis.kpi_grid_stability(f, dh).columns).collect())
    assert a == b


def test_dust(spark):
    data = [(f"p{i}", 1, i, "R", D, "d", 3, 0.0, d) for i, d in enumerate([49.9, 50.0, 150.0, 300.0, None])]
    out = kpis.kpi_dust_risk(spark.createDataFrame(data, AIR))
    got = {r.grid_point_id: r.harmattan_risk_score for r in out.collect()}
    assert [got[f"p{i}"] for i in range(5)] == [0, 30, 60, 100, 0]


@pytest.mark.parametrize("winds,rain,pm10,expected", [
    ([20.0], 0.0, [], True),
    ([20.1], 0.0, [], False),
    ([None], 0.0, [], None),
    ([None], 1.0, [], False),
    ([10.0, 30.0], 0.0, [40.0], True),
    ([10.0], 0.0, [60.0], False),
])
def test_maintenance(spark, winds, rain, pm10, expected):
    f = spark.createDataFrame([(f"p{i}", 1, i, "R", D, "d", 9, 30.0, 0.0, w, rain if i == 0 else 0.0) for i, w in enumerate(winds)], FACT)
    a = spark.createDataFrame([(f"p{i}", 1, i, "R", D, "d", 9, v, 0.0) for i, v in enumerate(pm10)], AIR)
    out = kpis.kpi_maintenance(f, a, dim_hour(spark)).collect()
    assert len(out) == 1 and out[0].is_ideal_hour is expected and out[0].hour == 9


def test_maintenance_require_air_quality(spark):
    from dataclasses import replace

    f = spark.createDataFrame([("p", 1, 1, "R", D, "d", 9, 30.0, 0.0, 5.0, 0.0)], FACT)
    a = spark.createDataFrame([], AIR)
    strict = replace(DEFAULT, require_air_quality=True)
    assert kpis.kpi_maintenance(f, a, dim_hour(spark)).first().is_ideal_hour is True
    assert kpis.kpi_maintenance(f, a, dim_hour(spark), strict).first().is_ideal_hour is None


def test_maintenance_windows(spark):
    schema = "region_id long, region_name string, date date, date_id string, hour long, is_ideal_hour boolean"
    rows = [(1, "R", D, "d", h, h in (3, 4, 5, 9)) for h in range(24) if h != 6] + [(1, "R", D, "d", 6, None)]
    out = extensions.maintenance_windows(spark.createDataFrame(rows, schema)).collect()
    got = sorted((r.window_start_hour, r.window_end_hour, r.window_length_hours, r.meets_min_length) for r in out)
    assert got == [(3, 5, 3, True), (9, 9, 1, False)]


def test_capacity(spark):
    regions = spark.createDataFrame([(1, "R", 14.0, -15.0, 4.0)], "region_id long, region_name string, latitude double, longitude double, area_km2 double")
    r = extensions.capacity_sizing(regions).first()
    assert (r.usable_land_ha, r.capacity_kw, r.panel_count) == (4.0, 2727.2, 8378)


def test_solar_coverage(spark):
    f = fact(spark, [("a", h, 30.0, g, 0.0, 0.0) for h, g in zip(range(10, 14), [199.0, 200.0, 201.0, None])])
    r = extensions.solar_coverage(f).first()
    assert (r.producing_hours, r.total_hours, r.coverage_pct) == (2, 4, 50.0)
