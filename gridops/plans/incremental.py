"""The marts kept up to date load by load.

A load's readings are merged into state tables that hold the newest copy of every reading,
in folders by date; only the dates that the load touches are read and rewritten (dynamic
partition overwrite). The indicators of a date depend on the readings of that date alone, so
the marts of the touched dates are rebuilt from the state and the other folders stay as they
are. Applying all loads, in any order and however often, gives the marts of one full build:
the newest copy is the one of the highest load id, not of the last call.

A load's dates are listed on the driver: a refresh covers some days, and a backfill as many
as the table has. What replaces a folder is written beside it first and moved in
by the writer's commit; a call that failed half way is repaired by making it again.

A merge shuffles the rows once, dealt as the files are: by date and region, so many files that
a task's rows are bounded. The grid has a row per point and grows with the regions, so it is
never broadcast: its size is estimated without the points that are derived from a region.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.operators.dedup import folded
from gridops.operators.spread import BUCKET, by_day
from gridops.operators.staging import DAILY_GROUP, HOURLY_GROUP
from gridops.params import DEFAULT, Params
from gridops.plans.graph import MODELS, ModelGraph
from gridops.session import DROP_SHUFFLES, JOIN_IN_PLACE, configured, scratch_path
from gridops.sources import sinks
from gridops.sources.schemas import RAW_SCHEMAS, conform

#: Raw table -> (what a reading is told by, load id, its date).
STATE = {
    "raw_hourly": (HOURLY_GROUP, "id_hourly", F.to_date),
    "raw_daily": (DAILY_GROUP, "id_daily", F.col),
    "raw_air_quality": (("region_name", "point_no", "ts"), "load_seq", F.to_date),
}
TIME = {"raw_hourly": "ts", "raw_daily": "date", "raw_air_quality": "ts"}
MARTS = (
    "fact_hourly_weather", "fact_daily_weather", "fact_hourly_air_quality", "kpi_generation_potential",
    "kpi_grid_stability", "kpi_dust_risk", "kpi_maintenance", "maintenance_windows", "solar_coverage",
)
GRID = ("grid_points", "dim_grid_point")
#: Partition column of the state tables (a reading without a time is on no date).
DAY = "state_date"


class Marts:
    """State and marts under ``root``; ``marts`` names those to keep."""

    def __init__(self, spark: SparkSession, root: str, regions: DataFrame, params: Params = DEFAULT, marts: Sequence[str] = MARTS):
        self.spark, self.root, self.regions, self.params, self.marts = spark, root.rstrip("/"), regions, params, tuple(marts)

    def _state_schema(self, name: str) -> T.StructType:
        return T.StructType([*RAW_SCHEMAS[name].fields, T.StructField(DAY, T.DateType())])

    def state(self, name: str) -> DataFrame:
        """The newest copy of every reading taken in so far."""
        path, schema = f"{self.root}/state/{name}", self._state_schema(name)
        if not sinks.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def mart(self, name: str) -> DataFrame:
        return sinks.read_mart(self.spark, f"{self.root}/marts/{name}")

    def apply(self, load: Mapping[str, DataFrame]) -> list[date | None]:
        """Takes in readings by raw table; returns the dates that were rebuilt."""
        # readings lie by their points, which have few at a time each
        with configured(self.spark, DROP_SHUFFLES | JOIN_IN_PLACE):
            return self._apply(load)

    def _apply(self, load: Mapping[str, DataFrame]) -> list[date | None]:
        fresh = {}
        for name, rows in load.items():
            day = STATE[name][2](TIME[name]).alias(DAY)
            path = scratch_path(self.spark, f"load-{name}")
            conform(rows, name).select("*", day).write.parquet(path)
            fresh[name] = self.spark.read.schema(self._state_schema(name)).parquet(path)
        touched: set[date | None] = set()
        for name, rows in fresh.items():
            keys, order, _ = STATE[name]
            days = {r[0] for r in rows.select(DAY).distinct().collect()}
            touched |= days
            now = rows.unionByName(self.state(name).filter(_on(DAY, days)))
            sizes = {r[0]: r[1] for r in now.groupBy(DAY).count().collect()}
            place = next(x for x in ("region_id", "region_name") if x in keys)
            # a repeated key on one date is one reading; the date follows from its time
            merged = folded(by_day(now, sizes, DAY, place), [*keys, DAY, BUCKET], order).drop(BUCKET)
            if days:
                sinks.replace_dealt(merged, f"{self.root}/state/{name}", DAY, place, *[k for k in keys if k != place])
        self._rebuild(touched)
        return sorted(touched, key=lambda d: (d is None, d or date.min))

    def _rebuild(self, days: set[date | None]) -> None:
        sources = {n: self.state(n).filter(_on(DAY, days)).drop(DAY) for n in STATE}
        # models are written only where more than one mart reads them, but for the grid, which is
        # derived where it is read; the state of the weather holds each reading once (that of air
        # quality has its names untrimmed)
        shared = sum(name != "fact_daily_weather" for name in self.marts) > 1
        written = [m for m in MODELS if m not in GRID] if shared else False
        regions = self.regions.hint("shuffle_hash")  # goes for the points derived from them
        g = ModelGraph(self.spark, params=self.params, sources={"regions": regions, **sources}, materialize=written, unique=("raw_hourly", "raw_daily"))
        dated = {d for d in days if d is not None}  # facts have no rows without a date
        for name in self.marts:
            sinks.replace_dates(self.spark, getattr(g, name), f"{self.root}/marts/{name}", "date", dated)


def _on(column: str, days: set[date | None]) -> Column:
    """The rows of some dates, as a filter that prunes folders."""
    listed = F.col(column).isin([d for d in days if d is not None])
    return listed | F.col(column).isNull() if None in days else listed
