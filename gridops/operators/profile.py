"""Profiling and analyst queries: counts, duplicates, fan-out, missing regions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_tables(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """One row per table: rows, distinct regions and points, min and max of a measure.
    ``tables`` maps name -> (frame, column for min, column for max)."""
    rows = None
    for name, (df, lo, hi) in tables.items():
        # one row per region and point, then a roll-up of these: no Expand of the table
        per_point = df.groupBy("region_name", "point_no").agg(F.count(F.lit(1)).alias("n"), F.min(lo).alias("lo"), F.max(hi).alias("hi"))
        r = per_point.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
            F.countDistinct("region_name").alias("distinct_regions"),
            F.countDistinct("point_no").alias("distinct_points"),
            F.min("lo").cast("double").alias("min_value"),
            F.max("hi").cast("double").alias("max_value"),
        ).select(F.lit(name).alias("table_name"), "*")
        rows = r if rows is None else rows.unionByName(r)
    return rows


def duplicate_keys(df: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """Top-k keys by number of copies (only keys seen more than once); ties are
    broken by the key itself so the report is deterministic."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .orderBy(F.col("n").desc(), *keys)
        .limit(k)
    )


def region_fanout(dim_gp: DataFrame, region_name: str) -> DataFrame:
    return (
        dim_gp.filter(F.col("region_name") == region_name)
        .groupBy("region_id", "region_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def missing_regions(regions: DataFrame, readings: DataFrame, name_col: str = "region_name") -> DataFrame:
    """Region names (with their seed count) that never occur in ``readings``, with
    SQL ``NOT IN`` semantics: if the seen set holds a null nothing is reported, and
    a null seed name is reported only when the seen set is empty.

    Built from an equi anti join (hash-partitioned, scales) plus two scalar
    subqueries over the seen set, instead of a nested-loop null-aware join.
    """
    seen = readings.select(F.col(name_col).alias("_seen")).distinct()
    n_seen = seen.agg(F.count(F.lit(1))).scalar()
    has_null = seen.agg(F.coalesce(F.max(F.col("_seen").isNull().cast("int")), F.lit(0))).scalar()
    per_name = regions.groupBy(name_col).agg(F.count(name_col).alias("total"))
    unmatched = per_name.join(seen, per_name[name_col] == seen["_seen"], "left_anti")
    return unmatched.filter(
        (n_seen == 0) | ((has_null == 0) & F.col(name_col).isNotNull())
    ).select("total", name_col)
