"""Shuffle partitions that follow the input.

``spark.sql.shuffle.partitions`` is one number for all tables, so a task that aggregates or
sorts one partition holds more the larger the table is, and adaptive execution only ever
joins partitions of a keyed repartitioning. Here their number follows the bytes of the files
that a frame is read from, known without a job: a partition gets about ``BYTES`` of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES = 16 << 20
#: Rows of a bucket of ``by_day``, about.
ROWS = 500_000
#: Column that tells a row's partition.
BUCKET = "_bucket"
#: Number of no day.
NO_DAY = -(1 << 40)


def input_bytes(df: DataFrame) -> int:
    """The size of the files that ``df`` is read from (0 if from none)."""
    sc = df.sparkSession.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    total = 0
    for file in df.inputFiles():
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        total += at.getFileSystem(conf).getFileStatus(at).getLen()
    return total


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, or as many more as the input asks for."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(input_bytes(df) / BYTES))


def _more(df: DataFrame) -> list[int]:
    """The number, if it is above the session's: that one is left to adaptive execution."""
    n = partitions(df)
    return [n] if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a key in one partition."""
    return df.repartition(*_more(df), *keys)


def in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df.orderBy(*order)``."""
    return df.repartitionByRange(*_more(df), *order).sortWithinPartitions(*order)


def by_day(df: DataFrame, rows: Mapping[date | None, int], day: str, key: str) -> DataFrame:
    """``df`` dealt by ``day`` and by buckets of ``key``, with its partition in ``BUCKET``: a
    partition holds rows of one day, and a day has one for about every ``ROWS`` of its rows, of
    which there are ``rows``. Grouped on ``BUCKET`` and more, rows stay where they are."""
    at, first = [], 0
    for d, n in rows.items():
        buckets = max(1, ceil(n / ROWS))
        at.append((NO_DAY if d is None else (d - date(1970, 1, 1)).days, first, buckets))
        first += buckets
    # by number: a table of numbers is broadcast in as many bytes as it has, one of dates in pages
    days = df.sparkSession.createDataFrame(at, "_of long, _first int, _n int")
    located = df.join(F.broadcast(days), F.coalesce(F.unix_date(day).cast("long"), F.lit(NO_DAY)) == F.col("_of"))
    bucket = F.col("_first") + F.pmod(F.xxhash64(key), F.col("_n")).cast("int")
    return located.select(*df.columns, bucket.alias(BUCKET)).repartitionById(max(first, 1), BUCKET)
