"""Incremental ingestion of landed payload files with Structured Streaming.

Refreshes overlap (each one re-lands the last days and replaces forecasts by
observations), so the same reading arrives more than once and the newest load must win.
The stream explodes each new payload file inside the executors and appends every reading
with its load (the file's time and name): no watermark, no state, nothing is dropped as
late. ``current_readings`` reads the newest copy of each key, by the same keyed
maximum as staging; a micro-batch's own repeats are reduced before they are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridops.operators.dedup import latest_reading
from gridops.operators.spread import by_key
from gridops.sources import payloads as pl

KEY = ["region_id", "point_no", "ts"]
#: What rows are shuffled by: those of a payload, or of a point in a file, which are much alike,
#: then stay together and compress to less than when they are dealt by hour.
POINT = ["region_id", "point_no"]
LOAD = "load_order"


def hourly_readings_stream(spark: SparkSession, source_dir: str, tz: str) -> DataFrame:
    raw = spark.readStream.schema(pl.HOURLY_SCHEMA).json(source_dir)
    load = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_name").alias("file"))
    rows = pl.explode_payloads(raw.withColumn(LOAD, load), "hourly", pl.HOURLY_VARIABLES, tz)
    return rows


def latest_wins_batch(batch: DataFrame) -> DataFrame:
    """A micro-batch reduced to its newest row per key: one maximum of whole rows, since all
    columns are written and loads are compared by name."""
    rest = [c for c in batch.columns if c not in KEY]
    newest = by_key(batch, *POINT).groupBy(*KEY).agg(F.max_by(F.struct(*rest), F.col(LOAD)).alias("_row"))
    return newest.select(*[F.col(c if c in KEY else f"_row.{c}") for c in batch.columns])


def start_ingest(stream: DataFrame, sink_dir: str, checkpoint_dir: str, once: bool = True) -> StreamingQuery:
    """Append new readings to a parquet table, a folder per micro-batch: the checkpoint (in
    the shared folder) makes a restart replay the unfinished files, and a replayed batch
    overwrites its own folder."""

    def put(batch: DataFrame, batch_id: int) -> None:
        latest_wins_batch(batch).sortWithinPartitions(*KEY).write.mode("overwrite").parquet(f"{sink_dir}/load={batch_id}")

    w = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()


def current_readings(table: DataFrame) -> DataFrame:
    """The newest copy of each reading in the ingested table: a micro-batch holds one copy of
    a reading, so the number of its folder tells the newest."""
    return latest_reading(table.drop(LOAD), KEY, "load", by=POINT).drop("load")
