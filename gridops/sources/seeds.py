"""Seed files: the region table (CSV, header row) and the lattice coefficients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the region seed's column layout (names are matched case-insensitively)
REGION_SEED_SCHEMA = T.StructType([
    T.StructField("FID", T.IntegerType()),
    T.StructField("CODE", T.IntegerType()),
    T.StructField("THEME", T.StringType()),
    T.StructField("PAYS", T.StringType()),
    T.StructField("IDUU", T.StringType()),
    T.StructField("Shape_Le_1", T.DoubleType()),
    T.StructField("Shape_Area", T.DoubleType()),
    T.StructField("NOM", T.StringType()),
    T.StructField("SUM_SUPERF", T.DoubleType()),
    T.StructField("Shape_Leng", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("map_format", T.StringType()),
])
COEF_SEED_SCHEMA = T.StructType([T.StructField("coef", T.DoubleType())])


def read_region_seed(spark: SparkSession, path: str) -> DataFrame:
    """Region id, name, centroid and area from the seed (the perimeter column is
    named like an area but holds a length in metres; it is dropped)."""
    raw = spark.read.schema(REGION_SEED_SCHEMA).option("header", True).csv(path)
    return raw.select(
        F.col("fid").cast("long").alias("region_id"),
        F.col("nom").alias("region_name"),
        F.col("latitude"),
        F.col("longitude"),
        F.col("sum_superf").alias("area_km2"),
    )


def read_coefficients(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COEF_SEED_SCHEMA).option("header", True).csv(path)


def write_coefficients(spark: SparkSession, coefficients: Sequence[float], path: str) -> None:
    """Write the lattice's coefficients in the seed layout."""
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(float(x)) for x in coefficients])).alias("coef"))
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_region_seed(regions: DataFrame, path: str) -> None:
    """Write regions in the seed layout (fields the model does not use left empty)."""
    point = F.format_string("POINT (%s, %s)", F.col("longitude").cast("string"), F.col("latitude").cast("string"))
    regions.select(
        F.col("region_id").cast("int").alias("FID"),
        F.lit(None).cast("int").alias("CODE"),
        F.lit(None).cast("string").alias("THEME"),
        F.lit(None).cast("string").alias("PAYS"),
        F.lit(None).cast("string").alias("IDUU"),
        F.lit(None).cast("double").alias("Shape_Le_1"),
        F.lit(None).cast("double").alias("Shape_Area"),
        F.col("region_name").alias("NOM"),
        F.col("area_km2").alias("SUM_SUPERF"),
        F.lit(None).cast("double").alias("Shape_Leng"),
        "latitude",
        "longitude",
        point.alias("map_format"),
    ).write.mode("overwrite").option("header", True).csv(path)
