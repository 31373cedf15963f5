"""The model graph: raw -> staging -> dimensions -> facts -> indicators.

Each property is a lazy DataFrame. With ``sources`` building the graph runs no job;
with ``sf_dir`` the tables that a model reads are landed first (see
``sources.landing``). Join sides carry no hints but for hours and dates:
Spark's byte threshold and AQE decide. Consumers select the columns they need and Catalyst prunes everything else
down to the parquet scan.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from gridops.operators import dims, extensions, facts, grid, kpis, staging
from gridops.params import DEFAULT, Params
from gridops.session import scratch_path
from gridops.sources import landing, sinks
from gridops.sources.schemas import conform


#: What the weather and air facts are joined on, and bucketed by where they are built.
JOIN_KEY = ("region_id", "point_no", "date", "hour_id")
MODELS: list[str] = []
#: The models that each model reads. ``VIEWS`` are computed row by row from one of them.
READS = {
    "grid_points": (), "stg_hourly": (), "stg_daily": (), "dim_date": (), "dim_hour": (),
    "stg_air_quality": ("grid_points",),
    "dim_grid_point": ("grid_points",),
    "fact_hourly_weather": ("stg_hourly", "dim_grid_point"),
    "fact_daily_weather": ("stg_daily", "dim_grid_point"),
    "fact_hourly_air_quality": ("stg_air_quality", "dim_grid_point", "dim_date"),
    "kpi_generation_potential": ("fact_hourly_weather",),
    "kpi_grid_stability": ("fact_hourly_weather", "dim_hour"),
    "kpi_dust_risk": ("fact_hourly_air_quality",),
    "kpi_maintenance": ("fact_hourly_weather", "fact_hourly_air_quality", "dim_hour"),
    "maintenance_windows": ("kpi_maintenance",),
    "capacity_sizing": (),
    "solar_coverage": ("fact_hourly_weather",),
}
VIEWS = ("kpi_generation_potential", "kpi_dust_risk")


def shared_models(scans: Iterable[str]) -> frozenset[str]:
    """The models to write for a job that scans the models ``scans`` (named once per scan):
    those read more than once, but for views, each of which reads its model as often."""
    times = Counter(scans)
    for name in reversed(list(READS)):
        # one that is written reads its models once, whatever reads it
        n = times[name] if name in VIEWS else min(times[name], 1)
        times.update({x: n for x in READS[name]})
    return frozenset(n for n in READS if times[n] > 1 and n not in VIEWS)


def model(fn=None, *, bucket_by: tuple[str, ...] = ()):
    """A model of the graph: lazy by default; with ``materialize`` it is written
    once as parquet under the checkpoint root and read back (like a table
    materialisation), so later models and checks scan it instead of recomputing.
    With ``bucket_by`` it is then a table bucketed by these columns."""
    if fn is None:
        return lambda f: model(f, bucket_by=bucket_by)
    MODELS.append(fn.__name__)

    def build(self):
        df = fn(self)
        if self.materialize is True or self.materialize and fn.__name__ in self.materialize:
            path = scratch_path(self.spark, f"model-{fn.__name__}")
            if bucket_by and self.buckets:
                return sinks.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, bucket_by, self.buckets)
            df.write.mode("overwrite").parquet(path)
            df = self.spark.read.parquet(path)
        return df

    build.__name__ = fn.__name__
    build.__doc__ = fn.__doc__
    return cached_property(build)


class ModelGraph:
    """The model graph over landed inputs.

    ``sf_dir`` names a directory of benchmark tables from which the raw inputs are
    derived and landed once (tests, benchmark). In production pass ``sources``:
    the already-landed ``regions``, ``raw_hourly`` (with ``id_hourly``),
    ``raw_daily`` and ``raw_air_quality`` tables, e.g. ``spark.read.parquet(...)``, and
    if wanted the ``coefficients`` seed of the lattice (``seeds.read_coefficients``).

    ``materialize`` writes every model once, or only those it names. With ``buckets`` the two hourly facts become
    tables of so many buckets of their join key, which join without an exchange. ``unique``
    names raw tables (raw_hourly, raw_daily) that hold each reading once already.
    """

    RAW = ("regions", "raw_hourly", "raw_daily", "raw_air_quality")

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str | None = None,
        params: Params = DEFAULT,
        materialize: bool | Collection[str] = False,
        sources: dict[str, DataFrame] | None = None,
        buckets: int = 0,
        unique: tuple[str, ...] = (),
    ):
        if sf_dir is None and not sources:
            raise ValueError("give sf_dir or sources")
        self.spark, self.sf_dir, self.params = spark, sf_dir, params
        self.materialize, self.buckets = materialize, buckets
        self.sources = dict(sources or {})
        self.unique = tuple(unique)

    def _raw(self, name: str) -> DataFrame:
        if name in self.sources:
            return conform(self.sources[name], name)
        return landing.landed(self.spark, self.sf_dir, name)

    # --- landed inputs -----------------------------------------------------------------
    @cached_property
    def regions(self) -> DataFrame:
        return self._raw("regions")

    @cached_property
    def raw_hourly(self) -> DataFrame:
        return self._raw("raw_hourly")

    @cached_property
    def hourly_rows(self) -> DataFrame:
        """The raw hourly readings for readers that do not need ``id_hourly``: the same
        rows without the sort that numbers them."""
        if "raw_hourly" in self.sources:
            return self.raw_hourly
        return landing.unnumbered(self.spark, self.sf_dir)

    @cached_property
    def raw_daily(self) -> DataFrame:
        return self._raw("raw_daily")

    @cached_property
    def raw_air_quality(self) -> DataFrame:
        return self._raw("raw_air_quality")

    # --- staging -----------------------------------------------------------------------
    @model
    def grid_points(self) -> DataFrame:
        return grid.grid_points(self.regions, self.params, self.sources.get("coefficients"))

    @model
    def stg_hourly(self) -> DataFrame:
        return staging.stg_hourly(self.raw_hourly, self.params, dedupe=False if "raw_hourly" in self.unique else None)

    @model
    def stg_daily(self) -> DataFrame:
        return staging.stg_daily(self.raw_daily, self.params, dedupe=False if "raw_daily" in self.unique else None)

    @model
    def stg_air_quality(self) -> DataFrame:
        return staging.stg_air_quality(self.raw_air_quality, self.grid_points, self.params)

    # --- dimensions --------------------------------------------------------------------
    @model
    def dim_grid_point(self) -> DataFrame:
        return dims.dim_grid_point(self.grid_points)

    @model
    def dim_date(self) -> DataFrame:
        # de-duplication keeps every (point, timestamp) key, so the staged date set equals
        # the raw one: read dates straight off the landed tables, skipping the dedupe
        return dims.dim_date(self.hourly_rows, self.raw_daily)

    @model
    def dim_hour(self) -> DataFrame:
        return dims.dim_hour(self.spark)

    # --- facts -------------------------------------------------------------------------
    @model(bucket_by=JOIN_KEY)
    def fact_hourly_weather(self) -> DataFrame:
        return facts.fact_hourly_weather(self.stg_hourly, self.dim_grid_point)

    @model
    def fact_daily_weather(self) -> DataFrame:
        return facts.fact_daily_weather(self.stg_daily, self.dim_grid_point)

    @model(bucket_by=JOIN_KEY)
    def fact_hourly_air_quality(self) -> DataFrame:
        return facts.fact_hourly_air_quality(self.stg_air_quality, self.dim_grid_point, self.dim_date)

    # --- indicators --------------------------------------------------------------------
    @model
    def kpi_generation_potential(self) -> DataFrame:
        return kpis.kpi_generation_potential(self.fact_hourly_weather, self.params)

    @model
    def kpi_grid_stability(self) -> DataFrame:
        return kpis.kpi_grid_stability(self.fact_hourly_weather, self.dim_hour, self.params)

    @model
    def kpi_dust_risk(self) -> DataFrame:
        return kpis.kpi_dust_risk(self.fact_hourly_air_quality, self.params)

    @model
    def kpi_maintenance(self) -> DataFrame:
        return kpis.kpi_maintenance(self.fact_hourly_weather, self.fact_hourly_air_quality, self.dim_hour, self.params)

    @model
    def maintenance_windows(self) -> DataFrame:
        return extensions.maintenance_windows(self.kpi_maintenance, self.params)

    @model
    def capacity_sizing(self) -> DataFrame:
        return extensions.capacity_sizing(self.regions, self.params)

    @model
    def solar_coverage(self) -> DataFrame:
        return extensions.solar_coverage(self.fact_hourly_weather, self.params)

    # --- SQL access --------------------------------------------------------------------
    def register_views(self, prefix: str = "") -> list[str]:
        """Every raw table and model as a temporary view named ``prefix`` + its name, so that
        analyses can be written as SQL. A lazy model's view is its query."""
        names = [*self.RAW, *MODELS]
        for name in names:
            getattr(self, name).createOrReplaceTempView(prefix + name)
        return [prefix + n for n in names]
