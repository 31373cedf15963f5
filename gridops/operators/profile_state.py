"""Profiles that grow load by load: mergeable states instead of a scan of all raw rows.

A load's state has a row per table, region and block of point numbers: an exact bitmap of the
points, the number of rows, and the least and greatest value. States merge by bitmap union,
sum, min and max, so the profile after each load reads that load's rows and the small states
of the earlier ones, and equals the profile of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.sources.sinks import exists

SCHEMA = "table_name string, region_name string, block long, points binary, n long, lo double, hi double, load long"


def state(df: DataFrame, table: str, lo: str, hi: str) -> DataFrame:
    """The state of some rows; ``lo`` and ``hi`` are the columns of the least and greatest value."""
    block = F.bitmap_bucket_number(F.col("point_no").cast("long")).alias("block")
    return df.groupBy("region_name", block).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("point_no").cast("long"))).alias("points"),
        F.count(F.lit(1)).alias("n"), F.min(lo).cast("double").alias("lo"), F.max(hi).cast("double").alias("hi"),
    ).select(F.lit(table).alias("table_name"), "region_name", "block", "points", "n", "lo", "hi")


def merged(states: DataFrame) -> DataFrame:
    """A state row per table, region and block out of any number."""
    return states.groupBy("table_name", "region_name", "block").agg(
        F.bitmap_or_agg("points").alias("points"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def profile(states: DataFrame) -> DataFrame:
    """table_name, row_count, distinct_regions, distinct_points, min_value, max_value."""
    one = merged(states)
    points = one.groupBy("table_name", "block").agg(F.bitmap_count(F.bitmap_or_agg("points")).alias("n")).groupBy("table_name").agg(F.sum("n").alias("distinct_points"))
    rest = one.groupBy("table_name").agg(
        F.sum("n").alias("row_count"), F.countDistinct("region_name").alias("distinct_regions"), F.min("lo").alias("min_value"), F.max("hi").alias("max_value")
    )
    return rest.join(points, "table_name").select("table_name", "row_count", "distinct_regions", "distinct_points", "min_value", "max_value")


class Profiles:
    """The states of all loads under ``root``, a folder per load and table (a load taken in
    again replaces its own)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, load: int, table: str, rows: DataFrame, lo: str, hi: str) -> None:
        state(rows, table, lo, hi).drop("table_name").write.mode("overwrite").parquet(f"{self.root}/load={load}/table_name={table}")

    def states(self) -> DataFrame:
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.root)

    def profile(self) -> DataFrame:
        return profile(self.states())
