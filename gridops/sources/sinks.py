"""Sinks: marts are rebuilt whole (overwrite) or date by date, partitioned by date; facts can
be bucketed for joins; raw tables append."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

#: Folder name of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _names(spark: SparkSession, folder: str) -> set[str]:
    """The files in a folder; a write gives names of its own."""
    if not exists(spark, folder):
        return set()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return {f.getPath().getName() for f in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)}


def _dealt(df: DataFrame, partition_by: str, cluster_by: str, files: int) -> DataFrameWriter:
    """Rows dealt by date and one of ``files`` buckets of ``cluster_by``, so a date has at most
    that many files, whatever the number of tasks, and a large date is not one task; sorted
    by ``cluster_by`` in a file and with a bloom filter on it, so that a reader of one value
    opens few pages of few files."""
    bucket = F.pmod(F.xxhash64(cluster_by), F.lit(files))
    return _clustered(df.repartition(partition_by, bucket), partition_by, cluster_by)


def _clustered(dealt: DataFrame, partition_by: str, cluster_by: str, *order: str) -> DataFrameWriter:
    rows = dealt.sortWithinPartitions(partition_by, cluster_by, *order)
    return rows.write.option(f"parquet.bloom.filter.enabled#{cluster_by}", "true").mode("overwrite").partitionBy(partition_by)


def write_mart(df: DataFrame, path: str, partition_by: str = "date", cluster_by: str = "grid_point_id", files: int = 8) -> None:
    """Full rebuild, a folder for each date, so that date filters prune whole folders."""
    _dealt(df, partition_by, cluster_by, files).parquet(path)


def replace_dates(
    spark: SparkSession, df: DataFrame, path: str, column: str, days: Iterable[date | None], cluster_by: str | None = None, files: int = 8,
) -> None:
    """Replaces the folders of ``days`` by the rows of ``df``, which has rows of these dates
    only, and leaves all others alone. A date left without rows gets an empty file. Rows are
    dealt as they are computed; a folder that the writer left as it was got none."""
    cluster_by = cluster_by or next(x for x in ("grid_point_id", "region_id", "region_name") if x in df.columns)
    folders = {f"{path}/{column}={NO_DATE if day is None else day}" for day in days}
    before = {f: _names(spark, f) for f in folders}
    _dealt(df, column, cluster_by, files).option("partitionOverwriteMode", "dynamic").parquet(path)
    for folder in folders:
        if _names(spark, folder) == before[folder]:
            df.drop(column).limit(0).write.mode("overwrite").parquet(folder)


def replace_dealt(dealt: DataFrame, path: str, column: str, cluster_by: str, *order: str) -> None:
    """Replaces the folders of the dates of ``dealt`` by its rows, a file for each of its
    partitions. It may be computed from these folders: they are replaced when all is written."""
    _clustered(dealt, column, cluster_by, *order).option("partitionOverwriteMode", "dynamic").parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The table ``name`` at ``path``, bucketed and sorted by ``keys``, one file a bucket: two
    tables bucketed alike join on the keys without an exchange."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_raw(df: DataFrame, path: str) -> None:
    """Append a landed batch, matching columns by name (never by position)."""
    df.write.mode("append").option("mergeSchema", "false").parquet(path)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
