"""Dense, monotone row ids in load order, continuing after an existing table's max.

The batch is range-sorted (by partitions of bounded size) and written once to the shared folder, each row with its
partition and its position there (from ``monotonically_increasing_id``), so a lost
executor cannot renumber it. Per-partition counts (one row per partition) are
prefix-summed in a window over that small table alone, and every row adds its
partition's offset when the written table is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.operators.spread import in_order
from gridops.session import scratch_path


def max_id(existing: DataFrame | None, id_col: str) -> Column:
    """Max existing id (0 when there is none), as a scalar subquery."""
    if existing is None:
        return F.lit(0).cast("long")
    return existing.agg(F.coalesce(F.max(id_col).cast("long"), F.lit(0).cast("long"))).scalar()


def append_ids(
    batch: DataFrame,
    order: Sequence[str | Column],
    id_col: str,
    existing: DataFrame | None = None,
    keep: Sequence[str] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``batch`` (its columns in ``keep``, by default all) plus ``id_col`` = max(existing
    ids, or 0) + 1, 2, ... in ``order``. The batch is written here and now.

    ``order`` must be a total order over the batch for the ids to be reproducible.
    ``derive``, a projection row by row, is applied to the sorted rows, so that the sort moves
    what they are derived from; ``keep`` then names derived columns.
    """
    spark = batch.sparkSession
    base = max_id(existing, id_col)
    rows = in_order(batch, *order)
    rows = derive(rows) if derive else rows
    columns = list(keep or rows.columns)
    located = (
        rows
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33))
        .select(*columns, "_pid", "_pos")
    )
    path = scratch_path(spark, f"numbered-{id_col}")
    located.write.parquet(path)
    located = spark.read.schema(located.schema).parquet(path)
    counts = located.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the batch: bounded by its partition count, safe to broadcast
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = located.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, base + F.col("_off") + F.col("_pos") + 1).drop("_pid", "_pos", "_off")
