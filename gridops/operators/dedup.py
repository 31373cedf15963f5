"""Latest reading per key (overlapping refreshes land the same reading twice).

Implemented as a keyed aggregate, one ``max_by(column, load order)`` per column, on rows
shuffled by their key, rather than a ``row_number`` window:

* a task aggregates one shuffle partition; their number follows the size of the input
  (``operators.spread``), so what a task holds does not grow with it. A combine before
  the shuffle would hold the keys of a whole input split in memory, each column with a copy
  of the load order beside it, and shuffle those; readings rarely have many copies in one
  split, so it would save few rows;
* copies are folded as they come, so no task ever holds one whole group;
* one aggregate per column (instead of one struct of the row) lets Catalyst drop
  the columns no consumer reads, so a KPI that needs three measures only
  shuffles three measures.

The load order must be total within a key, so every ``max_by`` picks the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.operators.spread import by_key


def latest_reading(df: DataFrame, keys: Sequence[str], order_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order_col`` (newest load).

    Rows are shuffled by ``keys``, or by those of them in ``by`` if a join or grouping on
    these follows, which then needs no shuffle of its own."""
    return folded(by_key(df, *(by or keys)), keys, order_col)


def folded(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """The same of rows that were shuffled by some of ``keys`` already."""
    order = F.col(order_col)
    aggs = [
        (F.max(order) if c == order_col else F.max_by(F.col(c), order)).alias(c)
        for c in df.columns
        if c not in keys
    ]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)
