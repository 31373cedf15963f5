"""Query registry: one callable (spark, sf_dir) -> DataFrame per query key.

Each query reads the driver's tables through the model graph and publishes the
column set of its oracle (``gridops.plans.oracles``), aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.functions.columns import round_half_away, surrogate_key
from gridops.operators import facts as facts_mod
from gridops.operators import kpis, profile, staging
from gridops.operators.quality import union_all
from gridops.operators.spread import partitions
from gridops.plans import suite
from gridops.plans.graph import ModelGraph

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str, materialize: bool | Collection[str] = False):
    def deco(fn: Callable[[ModelGraph], DataFrame]) -> Callable[[ModelGraph], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(ModelGraph(spark, sf_dir, materialize=materialize))
        return fn

    return deco


def _coords(df: DataFrame) -> DataFrame:
    # cos() may differ in the last bit between libm implementations: publish 1e-9 degrees
    return df.withColumn("grid_lat", round_half_away("grid_lat", 9)).withColumn(
        "grid_lon", round_half_away("grid_lon", 9)
    )


@query("scan_regions")
def _scan_regions(g: ModelGraph) -> DataFrame:
    """Regions written in the seed's CSV layout, then scanned back with the
    declared schema (header row, quoted commas, case-insensitive names)."""
    from gridops.session import scratch_path
    from gridops.sources import seeds

    path = scratch_path(g.spark, "region-seed")
    seeds.write_region_seed(g.regions, path)
    return seeds.read_region_seed(g.spark, path)


@query("grid_points")
def _grid_points(g: ModelGraph) -> DataFrame:
    return _coords(g.grid_points)


@query("grid_points_seeded")
def _grid_points_seeded(g: ModelGraph) -> DataFrame:
    """The grid from both seed files: regions and lattice coefficients, written and scanned."""
    from gridops.session import scratch_path
    from gridops.sources import seeds

    regions, coefficients = scratch_path(g.spark, "region-seed"), scratch_path(g.spark, "coefficient-seed")
    seeds.write_region_seed(g.regions, regions)
    seeds.write_coefficients(g.spark, g.params.grid_coefficients, coefficients)
    seeded = {"regions": seeds.read_region_seed(g.spark, regions), "coefficients": seeds.read_coefficients(g.spark, coefficients)}
    return _coords(ModelGraph(g.spark, params=g.params, sources=seeded).grid_points)


@query("dim_grid_point")
def _dim_grid_point(g: ModelGraph) -> DataFrame:
    return _coords(g.dim_grid_point)


@query("dim_date")
def _dim_date(g: ModelGraph) -> DataFrame:
    return g.dim_date


@query("latest_reading")
def _latest_reading(g: ModelGraph) -> DataFrame:
    return staging.latest_reading(g.raw_hourly, staging.HOURLY_GROUP, "id_hourly")


@query("stg_hourly")
def _stg_hourly(g: ModelGraph) -> DataFrame:
    return g.stg_hourly.drop("date", "hour_id")


@query("stg_daily")
def _stg_daily(g: ModelGraph) -> DataFrame:
    return g.stg_daily


@query("stg_air_quality")
def _stg_air_quality(g: ModelGraph) -> DataFrame:
    return g.stg_air_quality.drop("date", "hour_id")


@query("fact_hourly_weather")
def _fact_hourly_weather(g: ModelGraph) -> DataFrame:
    return g.fact_hourly_weather.select(*facts_mod.FACT_HOURLY_WEATHER_COLS)


@query("fact_daily_weather")
def _fact_daily_weather(g: ModelGraph) -> DataFrame:
    return g.fact_daily_weather.select(*facts_mod.FACT_DAILY_WEATHER_COLS)


@query("fact_hourly_air_quality")
def _fact_hourly_air_quality(g: ModelGraph) -> DataFrame:
    return g.fact_hourly_air_quality.select(*facts_mod.FACT_HOURLY_AIR_COLS)


@query("kpi_generation_potential")
def _kpi_generation_potential(g: ModelGraph) -> DataFrame:
    return g.kpi_generation_potential.drop("date")


@query("risk_islands")
def _risk_islands(g: ModelGraph) -> DataFrame:
    return kpis.risk_islands(g.fact_hourly_weather, g.dim_hour, g.params).select(
        "grid_point_id", "date_id", "hour_id", "hour", "grid_stability_risk", "risk_grp", "consecutive_hours"
    )


@query("risk_hours_exists")
def _risk_hours_exists(g: ModelGraph) -> DataFrame:
    return kpis.risk_hours_exists(g.fact_hourly_weather, g.dim_hour, g.params)


@query("kpi_grid_stability")
def _kpi_grid_stability(g: ModelGraph) -> DataFrame:
    return g.kpi_grid_stability.drop("date")


@query("kpi_dust_risk")
def _kpi_dust_risk(g: ModelGraph) -> DataFrame:
    return g.kpi_dust_risk.drop("date")


@query("kpi_maintenance")
def _kpi_maintenance(g: ModelGraph) -> DataFrame:
    return g.kpi_maintenance.drop("date")


@query("maintenance_windows")
def _maintenance_windows(g: ModelGraph) -> DataFrame:
    return g.maintenance_windows.drop("date")


@query("capacity_sizing")
def _capacity_sizing(g: ModelGraph) -> DataFrame:
    return g.capacity_sizing


@query("solar_coverage")
def _solar_coverage(g: ModelGraph) -> DataFrame:
    return g.solar_coverage.drop("date", "region_id")


@query("profile_tables")
def _profile_tables(g: ModelGraph) -> DataFrame:
    return profile.profile_tables(
        {
            "raw_hourly": (g.hourly_rows, "temperature_2m", "temperature_2m"),
            "raw_daily": (g.raw_daily, "temp_min_2m", "temp_max_2m"),
            "raw_air_quality": (g.raw_air_quality, "dust", "dust"),
        }
    )


@query("profile_merged")
def _profile_merged(g: ModelGraph) -> DataFrame:
    """The same profile from the mergeable states of three loads."""
    from gridops.operators.profile_state import Profiles
    from gridops.session import scratch_path

    kept = Profiles(g.spark, scratch_path(g.spark, "profiles"))
    tables = {
        "raw_hourly": (g.raw_hourly, "id_hourly", "temperature_2m", "temperature_2m"),
        "raw_daily": (g.raw_daily, "id_daily", "temp_min_2m", "temp_max_2m"),
        "raw_air_quality": (g.raw_air_quality, "load_seq", "dust", "dust"),
    }
    for load in range(3):
        for name, (df, order, lo, hi) in tables.items():
            kept.add(load, name, df.filter(F.pmod(F.col(order), F.lit(3)) == load), lo, hi)
    return kept.profile()


@query("duplicate_keys")
def _duplicate_keys(g: ModelGraph) -> DataFrame:
    stg_all = staging.stg_air_quality(g.raw_air_quality, g.grid_points, g.params, dedupe=False)
    return profile.duplicate_keys(stg_all, ["ts", "region_name", "point_no"], k=10)


@query("region_fanout")
def _region_fanout(g: ModelGraph) -> DataFrame:
    return profile.region_fanout(g.dim_grid_point, "Supplier#000000003")


@query("missing_regions")
def _missing_regions(g: ModelGraph) -> DataFrame:
    """Seed regions that a raw table never mentions, for each raw table."""
    trimmed = g.raw_air_quality.select(F.trim("region_name").alias("region_name"))
    raw = {"raw_hourly": g.hourly_rows, "raw_daily": g.raw_daily, "raw_air_quality": trimmed}
    parts = [profile.missing_regions(g.regions, t).select(F.lit(n).alias("source"), "total", "region_name") for n, t in raw.items()]
    return union_all(parts)


@query("drilldown_point")
def _drilldown_point(g: ModelGraph) -> DataFrame:
    k = g.kpi_generation_potential
    return (
        k.filter((F.col("region_id") == 1) & (F.col("grid_point_id") == surrogate_key(F.lit(1), F.lit(1))))
        .select("grid_point_id", "region_id", "date_id", "hour_id", "solar_score", "wind_score", "kpi_potential_score")
        .orderBy("date_id", "hour_id")
    )


def _dq(kind: str):
    def run(g: ModelGraph) -> DataFrame:
        from gridops.operators.quality import run_checks

        checks = suite.checks_of(kind)
        return run_checks(suite.tables(g, suite.tables_used(checks)), checks)

    return run


# over built models: each that the checks of a kind or its other models read more than once is
# written once and scanned; one with a single reader is read as it is computed
for _kind in ("not_null", "unique", "range", "value_set", "accepted", "relationship", "unique_combo"):
    query(f"dq_{_kind}", materialize=suite.shared(suite.checks_of(_kind)))(_dq(_kind))


@query("dq_failures", materialize=suite.shared(suite.CHECKS))
def _dq_failures(g: ModelGraph) -> DataFrame:
    """The rows, values and keys behind every summary of the suite."""
    from gridops.operators.failures import failing_rows

    return failing_rows(suite.tables(g, suite.tables_used(suite.CHECKS)), suite.CHECKS, suite.KEYS)


def _quarantined(g: ModelGraph) -> tuple[DataFrame, DataFrame]:
    from gridops.operators.failures import quarantine
    from gridops.operators.quality import ROW_LOCAL

    return quarantine(g.stg_hourly, [c for c in suite.CHECKS if c.table == "stg_hourly" and c.kind in ROW_LOCAL])


@query("dq_clean_hourly")
def _dq_clean_hourly(g: ModelGraph) -> DataFrame:
    """Staged hourly readings that pass every row-level check."""
    return _quarantined(g)[0].drop("date", "hour_id")


@query("dq_quarantine_hourly")
def _dq_quarantine_hourly(g: ModelGraph) -> DataFrame:
    """The other ones, with the checks they fail."""
    bad = _quarantined(g)[1]
    return bad.select("id_hourly", "ts", "region_id", "point_no", F.array_join("failed", ",").alias("failed"))


# --- ingestion of landed payloads ------------------------------------------------------
def _landed(g: ModelGraph, payloads: DataFrame, schema, name: str) -> DataFrame:
    from gridops.session import scratch_path
    from gridops.sources import payloads as pl

    path = scratch_path(g.spark, name)
    pl.land(payloads, path)
    return pl.read_landed(g.spark, path, schema)


def _expected(g: ModelGraph, key: str) -> DataFrame:
    return g.grid_points.select("region_id", "region_name", "point_no")


def _hourly_landing(g: ModelGraph):
    from gridops.sources import fixture_payloads as fp
    from gridops.sources import payloads as pl

    pl.require_grid(g.grid_points)
    latest = staging.latest_reading(g.raw_hourly, staging.HOURLY_GROUP, "id_hourly", by=staging.POINT).drop("id_hourly")
    landed = _landed(g, fp.hourly_payloads(latest, g.params.timezone), pl.HOURLY_SCHEMA, "landed-hourly")
    return pl.split_complete(landed, "hourly", pl.HOURLY_VARIABLES, _expected(g, "region_id"), "region_id")


def _air_landing(g: ModelGraph):
    from gridops.sources import fixture_payloads as fp
    from gridops.sources import payloads as pl

    trimmed = g.raw_air_quality.withColumn("region_name", F.trim("region_name"))
    latest = staging.latest_reading(trimmed, staging.AIR_KEY, "load_seq", by=staging.AIR_POINT).drop("load_seq")
    p = fp.hourly_payloads(latest, g.params.timezone, pl.AIR_VARIABLES, keyed_by_id=False)
    landed = _landed(g, p, pl.AIR_SCHEMA, "landed-air")
    return pl.split_complete(landed, "hourly", pl.AIR_VARIABLES, _expected(g, "region_name"), "region_name")


@query("payload_hourly")
def _payload_hourly(g: ModelGraph) -> DataFrame:
    from gridops.sources import payloads as pl

    accepted, _ = _hourly_landing(g)
    return pl.explode_payloads(accepted, "hourly", pl.HOURLY_VARIABLES, g.params.timezone)


@query("payload_air")
def _payload_air(g: ModelGraph) -> DataFrame:
    from gridops.sources import payloads as pl

    accepted, _ = _air_landing(g)
    return pl.explode_payloads(accepted, "hourly", pl.AIR_VARIABLES, g.params.timezone)


@query("payload_daily")
def _payload_daily(g: ModelGraph) -> DataFrame:
    from gridops.sources import fixture_payloads as fp
    from gridops.sources import payloads as pl

    latest = staging.latest_reading(g.raw_daily, staging.DAILY_KEY, "id_daily", by=staging.POINT).drop("id_daily")
    landed = _landed(g, fp.daily_payloads(latest, g.params.timezone), pl.DAILY_SCHEMA, "landed-daily")
    accepted, _ = pl.split_complete(
        landed, "daily", pl.DAILY_VARIABLES, _expected(g, "region_id"), "region_id", per_day=False
    )
    return pl.explode_payloads(accepted, "daily", pl.DAILY_VARIABLES, g.params.timezone, as_date=True)


@query("payload_rejects")
def _payload_rejects(g: ModelGraph) -> DataFrame:
    from gridops.sources import payloads as pl

    tz = g.params.timezone
    out = []
    for source, (_, rejects) in (("hourly", _hourly_landing(g)), ("air_quality", _air_landing(g))):
        out.append(rejects.select(
            F.lit(source).alias("source"), "region_name",
            F.to_date(pl.local_from_epoch(F.col("_day"), tz)).alias("day"),
            "expected_points", "received_points", "error",
        ))
    return out[0].unionByName(out[1])


@query("append_ids")
def _append_ids(g: ModelGraph) -> DataFrame:
    """Two refreshes landed one after the other: the first day's rows get ids 1..n in
    load order, the next refresh continues from the first one's max id."""
    from gridops.operators.ids import append_ids
    from gridops.sources.fixtures import BASE_DATE, raw_hourly

    raw = raw_hourly(g.spark, g.sf_dir)
    # a reading without a time belongs to the later refresh, not to neither
    first_day = F.coalesce(F.to_date("ts") == F.lit(BASE_DATE).cast("date"), F.lit(False))
    first = append_ids(raw.filter(first_day), ["load_seq"], "id_hourly")
    later = append_ids(raw.filter(~first_day), ["load_seq"], "id_hourly", existing=first)
    return first.unionByName(later).drop("load_seq")


def _grid(g: ModelGraph) -> DataFrame:
    return g.grid_points.select("region_id", "region_name", "point_no")


def _newest(g: ModelGraph) -> dict[str, DataFrame]:
    """The newest copy of each reading, by feed."""
    trimmed = g.raw_air_quality.withColumn("region_name", F.trim("region_name"))
    return {
        "hourly": staging.latest_reading(g.raw_hourly, staging.HOURLY_GROUP, "id_hourly", by=staging.POINT).drop("id_hourly"),
        "daily": staging.latest_reading(g.raw_daily, staging.DAILY_KEY, "id_daily", by=staging.POINT).drop("id_daily"),
        "air_quality": staging.latest_reading(trimmed, staging.AIR_KEY, "load_seq", by=staging.AIR_POINT).drop("load_seq"),
    }


def _feed(g: ModelGraph, name: str, readings: DataFrame):
    """Readings landed as payload files and read again, as a feed of a refresh."""
    from gridops.sources import fixture_payloads as fp
    from gridops.sources import payloads as pl

    tz = g.params.timezone
    if name == "daily":
        landed = _landed(g, fp.daily_payloads(readings, tz), pl.DAILY_SCHEMA, "refresh-daily")
        return pl.Feed(name, landed, "daily", pl.DAILY_VARIABLES, as_date=True)
    if name == "air_quality":
        landed = _landed(g, fp.hourly_payloads(readings, tz, pl.AIR_VARIABLES, keyed_by_id=False), pl.AIR_SCHEMA, "refresh-air")
        return pl.Feed(name, landed, "hourly", pl.AIR_VARIABLES)
    landed = _landed(g, fp.hourly_payloads(readings, tz), pl.HOURLY_SCHEMA, "refresh-hourly")
    return pl.Feed(name, landed, "hourly", pl.HOURLY_VARIABLES)


def _run_ts():
    return F.lit("2026-08-20 06:00:00").cast("timestamp_ntz")


def _ingested(g: ModelGraph):
    """Two refreshes of the hourly feed (the first day, then the rest) and one of the air
    quality feed, taken in one after the other: the raw tables and the failure log."""
    from gridops.plans.ingestion import raw_tables, take_in
    from gridops.session import scratch_path
    from gridops.sources.fixtures import BASE_DATE

    loads, newest = raw_tables(g.spark, scratch_path(g.spark, "ingested")), _newest(g)
    # a reading without a time belongs to the later refresh, not to neither
    first_day = F.coalesce(F.to_date("ts") == F.lit(BASE_DATE).cast("date"), F.lit(False))
    for load, part in enumerate((first_day, ~first_day), 1):
        take_in(loads, load, [_feed(g, "hourly", newest["hourly"].filter(part))], _grid(g), g.params.timezone, _run_ts())
    take_in(loads, 3, [_feed(g, "air_quality", newest["air_quality"])], _grid(g), g.params.timezone, _run_ts(), key="region_name")
    return loads


@query("ingest_append")
def _ingest_append(g: ModelGraph) -> DataFrame:
    return _ingested(g).table("raw_hourly").drop("load")


@query("dead_letters")
def _dead_letters(g: ModelGraph) -> DataFrame:
    # as text: the air quality feed has no region ids
    return _ingested(g).table("extraction_failures").drop("load").withColumn("region_id", F.col("region_id").cast("string"))


@query("ingest_region_atomic")
def _ingest_region_atomic(g: ModelGraph) -> DataFrame:
    """One refresh of the hourly and the daily feed, each region accepted or rejected with
    all it sent: the rows of both raw tables and of the failure log. The refresh is taken in
    twice; the second time changes nothing."""
    from gridops.plans.ingestion import raw_tables, take_in
    from gridops.session import scratch_path

    loads, newest = raw_tables(g.spark, scratch_path(g.spark, "ingested-regions")), _newest(g)
    feeds = [_feed(g, n, newest[n]) for n in ("hourly", "daily")]
    for _ in range(2):
        take_in(loads, 1, feeds, _grid(g), g.params.timezone, _run_ts(), whole_regions=True)
    no = F.lit(None)
    hourly = loads.table("raw_hourly").select(F.lit("hourly").alias("source"), F.col("id_hourly").alias("id"), "region_id", "region_name", "point_no", F.col("ts").alias("at"), F.col("temperature_2m").alias("value"), no.cast("string").alias("error"))
    daily = loads.table("raw_daily").select(F.lit("daily"), "id_daily", "region_id", "region_name", "point_no", F.col("date").cast("timestamp_ntz"), "temp_max_2m", no.cast("string"))
    failed = loads.table("extraction_failures").select(F.lit("failure"), "id_failure", "region_id", "region_name", F.lit(0).cast("long"), "run_ts", no.cast("double"), "error")
    return hourly.union(daily).union(failed)


@query("broken_payloads")
def _broken_payloads(g: ModelGraph) -> DataFrame:
    """The hourly payloads with the line of one point of every region cut short: the broken
    lines kept, and the region's run rejected for want of that point."""
    from gridops.plans.ingestion import raw_tables, take_in
    from gridops.session import scratch_path
    from gridops.sources import fixture_payloads as fp
    from gridops.sources import payloads as pl

    payloads = fp.hourly_payloads(_newest(g)["hourly"], g.params.timezone)
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("point_no") == F.col("region_id") % 16 + 1, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))).otherwise(line)
    path = scratch_path(g.spark, "refresh-broken")
    payloads.select(cut.alias("value")).write.text(path)
    good, broken = pl.read_checked(g.spark, path, pl.HOURLY_SCHEMA)
    loads = raw_tables(g.spark, scratch_path(g.spark, "ingested-broken"))
    feed = pl.Feed("hourly", good, "hourly", pl.HOURLY_VARIABLES)
    take_in(loads, 1, [feed], _grid(g), g.params.timezone, _run_ts(), broken=broken)
    kept = loads.table("broken_payloads").groupBy("region_id", "error").agg(F.count(F.lit(1)).alias("n"))
    failed = loads.table("extraction_failures").groupBy("region_id", "error").agg(F.count(F.lit(1)).alias("n"))
    accepted = loads.table("raw_hourly").groupBy("region_id", F.lit("accepted").alias("error")).agg(F.count(F.lit(1)).alias("n"))
    return kept.union(failed).union(accepted)


@query("sink_roundtrip")
def _sink_roundtrip(g: ModelGraph) -> DataFrame:
    """The grid-stability mart written as a date-partitioned table and read back."""
    from gridops.session import scratch_path
    from gridops.sources import sinks

    path = scratch_path(g.spark, "kpi_grid_stability")
    sinks.write_mart(g.kpi_grid_stability, path)
    return sinks.read_mart(g.spark, path).drop("date")


@query("stream_hourly")
def _stream_hourly(g: ModelGraph) -> DataFrame:
    """Two overlapping refreshes of the hourly payloads, each taken in by a trigger of its
    own: the table then holds every copy, and its newest per (region, point, hour) is read."""
    from gridops.session import DROP_SHUFFLES, configured, scratch_path
    from gridops.sources import fixture_payloads as fp
    from gridops.sources import payloads as pl
    from gridops.streaming import ingest

    # every step is written: its shuffle files go when it is, or all would lie beside each other
    with configured(g.spark, DROP_SHUFFLES):
        latest = staging.latest_reading(g.raw_hourly, staging.HOURLY_GROUP, "id_hourly", by=staging.POINT).drop("id_hourly")
        # both refreshes land the same payloads: they are derived once
        made = scratch_path(g.spark, "stream-payloads")
        fp.hourly_payloads(latest, g.params.timezone).write.parquet(made)
        payloads = g.spark.read.schema(pl.HOURLY_SCHEMA).parquet(made)
        src = scratch_path(g.spark, "stream-src")
        out, ckpt = scratch_path(g.spark, "stream-out"), scratch_path(g.spark, "stream-ckpt")
        for _ in range(2):
            pl.land_more(payloads, src)
            stream = ingest.hourly_readings_stream(g.spark, src, g.params.timezone)
            ingest.start_ingest(stream, out, ckpt).awaitTermination()
    return ingest.current_readings(g.spark.read.parquet(out))


# --- marts kept load by load, bucketed facts, clustered files, SQL over the models ------
def _incremental(g: ModelGraph, marts: tuple[str, ...]):
    """The raw tables in three overlapping loads, taken in one after the other."""
    from gridops.plans.incremental import STATE, Marts
    from gridops.session import scratch_path

    built = Marts(g.spark, scratch_path(g.spark, "incremental"), g.regions, g.params, marts)
    for part in range(3):
        built.apply({n: getattr(g, n).filter(F.pmod(F.col(order), F.lit(3)) == part) for n, (_, order, _) in STATE.items()})
    return built


@query("incremental_marts")
def _incremental_marts(g: ModelGraph) -> DataFrame:
    """The daily fact and the maintenance indicator after three loads; the same rows as of
    one full build."""
    built = _incremental(g, ("fact_daily_weather", "kpi_maintenance"))
    hours = built.mart("kpi_maintenance").select(
        F.lit("kpi_maintenance").alias("mart"), F.col("region_id").cast("string").alias("place"), "date_id", "hour_id",
        F.col("avg_wind_speed_80m_kmh").alias("a"), F.col("total_precipitation_mm").alias("b"), F.col("is_ideal_hour").alias("flag"),
    )
    days = built.mart("fact_daily_weather").select(
        F.lit("fact_daily_weather"), "grid_point_id", "date_id", F.lit(-1).cast("long"), "temp_max_2m", "rain_sum_mm", F.lit(None).cast("boolean")
    )
    return hours.union(days)


#: Staging has one reader: the fact, which is joined to points as its copies were shuffled.
BUILT = ("grid_points", "dim_grid_point", "fact_hourly_weather", "fact_hourly_air_quality")


@query("kpi_maintenance_built")
def _kpi_maintenance_built(g: ModelGraph) -> DataFrame:
    """The maintenance indicator from built facts, bucketed by their join key."""
    built = ModelGraph(g.spark, g.sf_dir, params=g.params, materialize=BUILT, buckets=partitions(g.raw_hourly))
    return kpis.kpi_maintenance(built.fact_hourly_weather, built.fact_hourly_air_quality, built.dim_hour, g.params).drop("date")


@query("drilldown_mart")
def _drilldown_mart(g: ModelGraph) -> DataFrame:
    """One point of the generation mart, read from clustered files."""
    from gridops.session import scratch_path
    from gridops.sources import sinks

    path = scratch_path(g.spark, "mart-generation")
    sinks.write_mart(g.kpi_generation_potential, path)
    k = sinks.read_mart(g.spark, path).filter(F.col("grid_point_id") == surrogate_key(F.lit(1), F.lit(1)))
    return k.select("grid_point_id", "region_id", "date_id", "hour_id", "solar_score", "wind_score", "kpi_potential_score").orderBy("date_id", "hour_id")


def _analysis(name: str):
    def run(g: ModelGraph) -> DataFrame:
        from gridops.plans import analyses

        # staging without duplicates has none to show
        return analyses.run(_copies(g) if name == "sql_duplicates" else g, name, prefix="gridops_")

    return run


for _name in ("sql_coverage", "sql_missing_regions", "sql_point_generation", "sql_point_stability", "sql_duplicates", "sql_fanout"):
    query(_name)(_analysis(_name))


# --- the models without de-duplication: copies multiply, as in the raw tables ----------
def _copies(g: ModelGraph) -> ModelGraph:
    from dataclasses import replace

    return ModelGraph(g.spark, g.sf_dir, params=replace(g.params, dedupe_readings=False))


@query("fact_hourly_weather_copies")
def _fact_hourly_weather_copies(g: ModelGraph) -> DataFrame:
    return _copies(g).fact_hourly_weather.select(*facts_mod.FACT_HOURLY_WEATHER_COLS)


@query("fact_hourly_air_quality_copies")
def _fact_hourly_air_quality_copies(g: ModelGraph) -> DataFrame:
    return _copies(g).fact_hourly_air_quality.select(*facts_mod.FACT_HOURLY_AIR_COLS)


@query("kpi_maintenance_copies")
def _kpi_maintenance_copies(g: ModelGraph) -> DataFrame:
    return _copies(g).kpi_maintenance.drop("date")
