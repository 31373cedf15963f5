"""Raw tables that grow by loads, each seen whole or not at all.

A root folder holds the tables, each created if absent from its declared schema, and
``_loads``, the manifest. A load writes its rows of every table into folders of its own
(``<table>/load=<n>``, overwritten if they are there) and its manifest row last: that row is
the commit. Readers join the manifest, so rows of a load that failed half way are never seen,
and running the load again replaces them. A committed load is not taken in again.

The manifest has one row per load and table, with the number of rows and the highest id, so
continuing ids needs no scan of the table. One writer at a time: loads are numbered by the
caller and come one after the other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.sources.sinks import exists

MANIFEST = "table string, rows long, top_id long, load long"


class Loads:
    """``ids`` maps each table with a running id to that column."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType], ids: Mapping[str, str]):
        self.spark, self.root, self.schemas, self.ids = spark, root.rstrip("/"), dict(schemas), dict(ids)
        for name in self.schemas:
            self._create(name)

    def _there(self, path: str) -> bool:
        return exists(self.spark, path)

    def _create(self, name: str) -> None:
        """The table as an empty load 0, if it is not there."""
        if not self._there(f"{self.root}/{name}/load=0/_SUCCESS"):
            empty = self.spark.createDataFrame([], self.schemas[name])
            empty.write.mode("overwrite").parquet(f"{self.root}/{name}/load=0")
        if not self._there(f"{self.root}/_loads/load=0/_SUCCESS"):
            self.spark.createDataFrame([], MANIFEST).drop("load").write.mode("overwrite").parquet(f"{self.root}/_loads/load=0")

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_loads")

    def committed(self, load: int) -> bool:
        return self._there(f"{self.root}/_loads/load={load}/_SUCCESS")

    def table(self, name: str) -> DataFrame:
        """The rows of committed loads, with their ``load``. The manifest decides which
        folders are read (a partition filter at run time)."""
        schema = T.StructType([*self.schemas[name].fields, T.StructField("load", T.LongType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        done = self.manifest().filter(F.col("table") == name).select("load")
        return rows.join(done, "load", "left_semi").select(*[f.name for f in schema.fields])

    def ids_of(self, name: str) -> DataFrame:
        """The highest id of each committed load, under the table's id column."""
        return self.manifest().filter(F.col("table") == name).select(F.col("top_id").alias(self.ids[name]))

    def put(self, load: int, name: str, rows: DataFrame) -> None:
        """Writes a load's rows of one table, by the declared columns; not yet seen."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schemas[name].fields]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{name}/load={load}")

    def commit(self, load: int) -> None:
        """Makes the load's rows seen. Tables that it did not write get no manifest row."""
        parts = []
        for name, schema in self.schemas.items():
            path = f"{self.root}/{name}/load={load}"
            if self._there(f"{path}/_SUCCESS"):
                top = F.max(self.ids[name]) if name in self.ids else F.lit(None)
                rows = self.spark.read.schema(schema).parquet(path)
                parts.append(rows.agg(F.count(F.lit(1)).alias("rows"), top.cast("long").alias("top_id")).select(F.lit(name).alias("table"), "rows", "top_id"))
        if not parts:
            raise ValueError(f"load {load} wrote nothing")
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        whole.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_loads/load={load}")
