"""Gaps-and-islands: consecutive runs of an integer position within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_islands(
    df: DataFrame, group: Sequence[str], pos: str, island_col: str = "island", run_col: str = "run_length"
) -> DataFrame:
    """Add ``island`` = pos - row_number() within ``group`` ordered by ``pos``, and
    ``run_length`` = rows sharing (group, island).

    Both windows run on one exchange: hashing by ``group`` already clusters
    (group, island). ``pos`` must be unique within ``group``.
    """
    by_pos = Window.partitionBy(*group).orderBy(pos)
    out = df.withColumn(island_col, (F.col(pos) - F.row_number().over(by_pos)).cast("long"))
    return out.withColumn(run_col, F.count(F.lit(1)).over(Window.partitionBy(*group, island_col)))
