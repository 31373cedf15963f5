"""Landed raw tables: derived from the driver tables once per application, then read
back like any landed table.

Landing is where the raw hourly rows receive their load id (``id_hourly``): dense,
monotone in load order, assigned by ``operators.ids.append_ids``, which writes the
numbered rows once; that table is the landed one. Downstream, "newest load wins" is
a max over one bigint per key. The other tables are written as parquet under the
checkpoint root (the cluster's shared folder) in a fresh directory per application.
Readers that do not need the load id take ``unnumbered``, a projection of the source
scan without any sort.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from gridops.operators.ids import append_ids
from gridops.session import scratch_path
from gridops.sources import fixtures

_LOCK = threading.Lock()
_LANDED: dict[tuple[str, str, str], DataFrame] = {}


def unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw hourly readings before they get their load ids."""
    return fixtures.raw_hourly(spark, sf_dir).drop("load_seq")


def _written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"landed-{name}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _land(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "raw_hourly":
        # the source rows are sorted, and readings derived from them where they then are
        source = fixtures.read_table(spark, sf_dir, "lineitem").select(*fixtures.LOAD_ORDER, "l_suppkey")
        numbered = append_ids(source, fixtures.LOAD_ORDER, "id_hourly", derive=fixtures.hourly_readings)
        return numbered.select("id_hourly", *[c for c in numbered.columns if c != "id_hourly"])
    derive = {"regions": fixtures.regions, "raw_daily": fixtures.raw_daily, "raw_air_quality": fixtures.raw_air_quality}
    return _written(spark, derive[name](spark, sf_dir), name)


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The landed table ``name`` for ``sf_dir``; landed on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        if key not in _LANDED:
            _LANDED[key] = _land(spark, sf_dir, name)
        return _LANDED[key]
