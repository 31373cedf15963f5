"""Sample-grid generator: an n x n lattice of points over each region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.params import DEFAULT, Params


def lattice(coefs: Sequence[float]) -> list[tuple[int, float, float]]:
    """(point_no, dx, dy) for every coefficient pair, numbered in (dx, dy) order,
    i.e. exactly as a row_number over the pairs ordered by dx then dy."""
    pairs = sorted((float(dx), float(dy)) for dx in coefs for dy in coefs)
    return [(i + 1, dx, dy) for i, (dx, dy) in enumerate(pairs)]


def valid_regions(regions: DataFrame) -> DataFrame:
    return regions.filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("area_km2") > 0)
    )


def _points_of(coefficients: DataFrame):
    """The lattice of a coefficient table (column coef), from one scalar subquery."""
    return coefficients.agg(F.sort_array(F.collect_list(F.col("coef").cast("double")))).scalar()


_LATTICE = """transform(sequence(0, size(coefs) * size(coefs) - 1), i -> struct(
    cast(i + 1 as bigint) as point_no, coefs[i div size(coefs)] as dx, coefs[i % size(coefs)] as dy))"""


def grid_points(regions: DataFrame, params: Params = DEFAULT, coefficients: DataFrame | None = None) -> DataFrame:
    """region_id, region_name, point_no (1..n^2), grid_lat, grid_lon.

    The n^2 lattice is an array exploded on each region row: no join, no shuffle, no
    window; each region emits its own points where it is read. It comes from the
    coefficient seed if one is given, else from the parameters.
    """
    kpd = float(params.km_per_deg_lat)
    valid = valid_regions(regions)
    if coefficients is None:
        points = F.array(*[
            F.struct(F.lit(n).cast("long").alias("point_no"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
            for n, dx, dy in lattice(params.grid_coefficients)
        ])
    else:
        valid = valid.withColumn("coefs", _points_of(coefficients))
        points = F.expr(_LATTICE)
    base = valid.select(
        "region_id",
        "region_name",
        F.col("latitude").alias("centroid_lat"),
        F.col("longitude").alias("centroid_lon"),
        (F.lit(1.0) / F.lit(kpd)).alias("deg_lat_per_km"),
        (F.lit(1.0) / (F.lit(kpd) * F.cos(F.radians("latitude")))).alias("deg_lon_per_km"),
        (F.sqrt("area_km2") / F.lit(2)).alias("offset_km"),
        F.explode(points).alias("p"),
    )
    return base.select(
        "region_id",
        "region_name",
        F.col("p.point_no").alias("point_no"),
        (F.col("centroid_lat") + F.col("p.dx") * F.col("offset_km") * F.col("deg_lat_per_km")).alias("grid_lat"),
        (F.col("centroid_lon") + F.col("p.dy") * F.col("offset_km") * F.col("deg_lon_per_km")).alias("grid_lon"),
    )
