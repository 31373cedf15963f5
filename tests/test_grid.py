import math

from gridops.operators.grid import grid_points, lattice

SCHEMA = "region_id long, region_name string, latitude double, longitude double, area_km2 double"


def test_grid_offsets_and_numbering(spark):
    regions = spark.createDataFrame([(1, "A", 0.0, 0.0, 4.0)], SCHEMA)
    g = {r.point_no: r for r in grid_points(regions).collect()}
    assert sorted(g) == list(range(1, 17))
    step = 1.0 / 111.32  # offset 1 km at the equator
    assert math.isclose(g[1].grid_lat, -1.5 * step) and math.isclose(g[1].grid_lon, -1.5 * step)
    assert math.isclose(g[2].grid_lat, -1.5 * step) and math.isclose(g[2].grid_lon, -0.5 * step)
    assert math.isclose(g[5].grid_lat, -0.5 * step) and math.isclose(g[5].grid_lon, -1.5 * step)
    assert math.isclose(g[16].grid_lat, 1.5 * step) and math.isclose(g[16].grid_lon, 1.5 * step)


def test_grid_validity_filter(spark):
    regions = spark.createDataFrame(
        [(1, "nolat", None, 0.0, 4.0), (2, "nolon", 0.0, None, 4.0), (3, "noarea", 0.0, 0.0, 0.0), (4, "ok", 14.0, -15.0, 9.0)],
        SCHEMA,
    )
    g = grid_points(regions)
    assert {r.region_id for r in g.collect()} == {4}
    assert g.count() == 16


def test_lattice_numbering_is_row_number_by_dx_dy():
    lat = lattice((-1.5, -0.5, 0.5, 1.5))
    assert [n for n, _, _ in lat] == list(range(1, 17))
    assert lat[0][1:] == (-1.5, -1.5) and lat[1][1:] == (-1.5, -0.5) and lat[4][1:] == (-0.5, -1.5)


def test_lattice_from_the_coefficient_seed(spark, tmp_path):
    from gridops.operators.grid import grid_points
    from gridops.sources.seeds import read_coefficients

    path = tmp_path / "coefs.csv"
    path.write_text("coef\n1.5\n-0.5\n-1.5\n0.5\n")
    regions = spark.createDataFrame([(1, "R", 14.0, -15.0, 4.0), (2, "S", None, -15.0, 4.0)], "region_id long, region_name string, latitude double, longitude double, area_km2 double")
    seeded = grid_points(regions, coefficients=read_coefficients(spark, str(path)))
    assert sorted(map(tuple, seeded.collect())) == sorted(map(tuple, grid_points(regions).collect()))
    assert seeded.count() == 16
