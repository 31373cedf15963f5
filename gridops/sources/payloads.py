"""Landed forecast / air-quality payloads -> long readings.

A payload is one API response for one grid point: a regular time axis given as
(``time``, ``time_end``, ``interval``) in epoch seconds, left-closed and
right-open, plus one value array per variable. Landing writes them as JSON lines;
ingestion reads them with an explicit schema, rebuilds the axis with
``sequence``, zips the arrays beside it and ``inline``-explodes, all inside the
executors. A region's run (a local day of an hourly feed, the whole of a daily one) is
accepted only when every expected grid point delivered exactly one payload, no other point
did, and every array matches its axis. All else is rejected, silent regions included: a run
that any region delivered is expected of all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.session import scratch_path

# fixed values: payload variable name -> landed column name
HOURLY_VARIABLES = (
    ("temperature_2m", "temperature_2m"),
    ("cloud_cover", "cloud_cover_pct"),
    ("direct_radiation", "direct_radiation_w_m2"),
    ("shortwave_radiation", "shortwave_radiation_w_m2"),
    ("wind_speed_80m", "wind_speed_80m_kmh"),
    ("wind_direction_80m", "wind_direction_80m_deg"),
    ("precipitation", "precipitation_mm"),
    ("visibility", "visibility_m"),
    ("weather_code", "weather_code_wmo"),
)
DAILY_VARIABLES = (
    ("temperature_2m_max", "temp_max_2m"),
    ("temperature_2m_mean", "temp_mean_2m"),
    ("temperature_2m_min", "temp_min_2m"),
    ("precipitation_sum", "precipitation_sum_mm"),
    ("rain_sum", "rain_sum_mm"),
    ("precipitation_probability_max", "precipitation_probability_max_pct"),
    ("sunshine_duration", "sunshine_duration_sec"),
    ("daylight_duration", "daylight_duration_sec"),
    ("wind_speed_10m_max", "wind_speed_max_10m_kmh"),
    ("wind_gusts_10m_max", "wind_gusts_max_10m_kmh"),
    ("shortwave_radiation_sum", "shortwave_radiation_sum_mj_m2"),
)
AIR_VARIABLES = (("pm10", "pm10"), ("pm2_5", "pm2_5"), ("dust", "dust"))
HOUR, DAY = 3600, 86400
EPOCH = "1970-01-01 00:00:00"


def series_type(variables: Sequence[tuple[str, str]]) -> T.StructType:
    return T.StructType(
        [T.StructField("time", T.LongType()), T.StructField("time_end", T.LongType()), T.StructField("interval", T.LongType())]
        + [T.StructField(api, T.ArrayType(T.DoubleType())) for api, _ in variables]
    )


def payload_schema(section: str, variables, keyed_by_id: bool = True) -> T.StructType:
    fields = [T.StructField("region_id", T.LongType())] if keyed_by_id else []
    fields += [
        T.StructField("region_name", T.StringType()),
        T.StructField("point_no", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField(section, series_type(variables)),
    ]
    return T.StructType(fields)


HOURLY_SCHEMA = payload_schema("hourly", HOURLY_VARIABLES)
DAILY_SCHEMA = payload_schema("daily", DAILY_VARIABLES)
AIR_SCHEMA = payload_schema("hourly", AIR_VARIABLES, keyed_by_id=False)


# --- epoch <-> local wall clock (session-zone independent) ---------------------------
def _epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def local_from_epoch(seconds: Column, tz: str) -> Column:
    utc_wall = F.timestamp_add("SECOND", seconds, _epoch())
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def epoch_from_local(ts: Column, tz: str) -> Column:
    utc_wall = F.convert_timezone(F.lit(tz), F.lit("UTC"), ts)
    return F.timestamp_diff("SECOND", _epoch(), utc_wall)


# --- landing -----------------------------------------------------------------------------
def land(payloads: DataFrame, path: str) -> None:
    payloads.write.mode("overwrite").json(path)


#: Payloads of a compressed file, at most: it is read by one task.
FILE_PAYLOADS = 10_000


def land_more(payloads: DataFrame, path: str) -> None:
    """Adds a refresh's files to a landing folder, compressed (at the least effort)."""
    files = payloads.write.mode("append").option("maxRecordsPerFile", FILE_PAYLOADS)
    files.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").json(path)


def read_landed(spark, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


#: Column that keeps the text of a line that is no payload.
BROKEN = "_broken"


def read_checked(spark, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(payloads, broken lines: region_id if the text still tells it, payload, error). A line
    is broken if it is no JSON object or does not fit the schema; none is lost. Lines are
    parsed whole, whatever columns are read later, so both sides agree on them."""
    whole = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    lines = lines.select("value", F.from_json("value", whole, {"columnNameOfCorruptRecord": BROKEN}).alias("p"))
    bad = F.coalesce(F.col(f"p.{BROKEN}").isNotNull(), F.lit(True))
    region = F.regexp_extract("value", r'"region_id"\s*:\s*([0-9]{1,18})[,}\s]', 1)
    broken = lines.filter(bad).select(region.try_cast("long").alias("region_id"), F.col("value").alias("payload"), F.lit("malformed payload").alias("error"))
    return lines.filter(~bad).select("p.*").drop(BROKEN), broken


# --- ingestion: payloads -> readings ---------------------------------------------------
def _axis(s: Column) -> Column:
    """Left-closed, right-open axis; an empty or inverted range gives an empty axis
    (``sequence`` would raise on it)."""
    ok = s["time"] < s["time_end"]
    return F.when(ok, F.sequence(s["time"], s["time_end"] - s["interval"], s["interval"])).otherwise(
        F.array().cast("array<bigint>")
    )


def arrays_match(section: str, variables) -> Column:
    s = F.col(section)
    n = F.size(_axis(s))
    ok = F.lit(True)
    for api, _ in variables:
        ok = ok & (F.coalesce(F.size(s[api]), F.lit(-1)) == n)
    return ok


def explode_payloads(payloads: DataFrame, section: str, variables, tz: str, as_date: bool = False) -> DataFrame:
    """One row per axis slot: the local wall-clock time plus one column per variable."""
    s = F.col(section)
    keys = [c for c in payloads.columns if c != section]
    zipped = F.arrays_zip(_axis(s).alias("_t"), *[s[api].alias(col) for api, col in variables])
    # arrays_zip pads short arrays with nulls and keeps going past the axis: only
    # slots on the axis are readings (mismatched payloads are rejected upstream)
    rows = payloads.select(*keys, F.inline(zipped)).filter(F.col("_t").isNotNull())
    t = local_from_epoch(F.col("_t"), tz)
    tcol = F.to_date(t).alias("date") if as_date else t.alias("ts")
    return rows.select(tcol, *keys, *[col for _, col in variables])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_stats(
    payloads: DataFrame, section: str, variables, expected: DataFrame, key: str, per_day: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(the payloads with their run ``_day``, a row per key and run: points expected and
    received, and ``error``, null where the run is complete).

    ``expected`` holds the expected points (key, point_no). Runs are the days that any
    region delivered; their number is bounded by the refresh window.
    """
    day = F.col(section)["time"] if per_day else F.lit(None).cast("long")
    p = payloads.withColumn("_day", day).withColumn("_ok", arrays_match(section, variables))
    points = p.groupBy(key, "_day", "point_no").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.col("_ok").cast("int")).alias("_good"), F.min("region_name").alias("_name")
    )
    # one row per point and run, from one reading of the payloads
    points = _written(points, "points")
    runs = points.agg(F.collect_set(F.coalesce("_day", F.lit(-1)))).scalar()
    wanted = expected.select(key, "point_no").distinct().withColumn("_runs", runs)
    wanted = wanted.select(key, "point_no", F.explode("_runs").alias("_run")).select(key, "point_no", F.nullif("_run", F.lit(-1)).alias("_day"))
    same = (points[key].eqNullSafe(wanted[key])) & (points["_day"].eqNullSafe(wanted["_day"])) & (points["point_no"].eqNullSafe(wanted["point_no"]))
    both = points.withColumn("_here", F.lit(1)).join(wanted.withColumn("_want", F.lit(1)), same, "full").select(
        F.coalesce(points[key], wanted[key]).alias(key), F.coalesce(points["_day"], wanted["_day"]).alias("_day"), "_n", "_good", "_name", "_want"
    )
    stats = both.groupBy(key, "_day").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("received_points"),
        F.coalesce(F.sum("_want"), F.lit(0)).cast("long").alias("expected_points"),
        F.coalesce(F.min("_good"), F.lit(1)).alias("_all_ok"),
        F.max(((F.coalesce("_n", F.lit(0)) != 1) | F.col("_want").isNull()).cast("int")).alias("_odd"),
        F.min("_name").alias("_seen_name"),
    )
    error = (
        F.when(
            F.col("received_points") != F.col("expected_points"),
            F.format_string("expected %d responses, got %d", F.col("expected_points"), F.col("received_points")),
        )
        .when(F.col("_odd") == 1, F.lit("points missing, repeated or unknown"))
        .when(F.col("_all_ok") == 0, F.lit("array length does not match the time axis"))
    )
    return p.drop("_ok"), stats.withColumn("error", error).drop("_all_ok", "_odd")


def _named(rejects: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """``region_name`` of rejects by id; a silent region's comes from the grid, if it has one."""
    if "region_name" not in expected.columns:
        return rejects.withColumn("region_name", F.col("_seen_name"))
    names = expected.select(F.col(key).alias("_key"), "region_name").distinct()
    return rejects.join(names, rejects[key] == names["_key"], "left").withColumn("region_name", F.coalesce("_seen_name", "region_name"))


def split_complete(
    payloads: DataFrame, section: str, variables, expected: DataFrame, key: str, per_day: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(accepted payloads, rejects: one row per key and run), each run judged by itself."""
    p, stats = run_stats(payloads, section, variables, expected, key, per_day)
    # decided once, and read by the accepted payloads and by the rejects
    stats = _written(stats, "runs")
    accepted = stats.filter("error is null").select(F.col(key).alias("_key"), F.col("_day").alias("_run"))
    accepted = p.join(accepted, p[key].eqNullSafe(F.col("_key")) & p["_day"].eqNullSafe(F.col("_run")), "left_semi").drop("_day")
    rejects = stats.filter("error is not null")
    if "region_id" in payloads.columns and key != "region_name":
        rejects = _named(rejects, expected, key)
    columns = list(dict.fromkeys([key, "region_name", "_day"]))
    return accepted, rejects.select(*columns, "expected_points", "received_points", "error")


@dataclass(frozen=True)
class Feed:
    """A feed of a refresh: its payloads, and how they are taken apart."""

    name: str
    payloads: DataFrame
    section: str
    variables: tuple
    as_date: bool = False


def split_regions(feeds: Sequence[Feed], expected: DataFrame, key: str = "region_id") -> tuple[dict[str, DataFrame], DataFrame]:
    """(accepted payloads by feed, rejects: one row per region) of one refresh: a region is
    accepted only if all its runs of all feeds are complete, and rejected with all it sent
    otherwise. The error is that of the first feed in order, and its first run. The verdict
    is a table of one row per region; every feed is split by it."""
    judged, parts = [], {}
    for i, feed in enumerate(feeds):
        parts[feed.name], stats = run_stats(feed.payloads, feed.section, feed.variables, expected, key, per_day=not feed.as_date)
        at = F.when(F.col("error").isNotNull(), F.struct(F.lit(i).alias("feed"), "_day", "expected_points", "received_points", F.concat(F.lit(f"{feed.name}: "), "error").alias("error")))
        judged.append(stats.select(key, "_seen_name", at.alias("failed")))
    verdicts = judged[0]
    for more in judged[1:]:
        verdicts = verdicts.unionByName(more)
    verdicts = verdicts.groupBy(key).agg(F.min("failed").alias("failed"), F.min("_seen_name").alias("_seen_name"))
    # decided once, and read by every feed and by the log
    verdicts = _written(verdicts, "verdicts")
    good = verdicts.filter("failed is null").select(F.col(key).alias("_key"))
    accepted = {n: p.join(good, p[key].eqNullSafe(F.col("_key")), "left_semi").drop("_day") for n, p in parts.items()}
    rejects = verdicts.filter("failed is not null").select(key, "_seen_name", "failed.*")
    rejects = rejects if key == "region_name" else _named(rejects, expected, key)
    columns = list(dict.fromkeys([key, "region_name"]))
    return accepted, rejects.select(*columns, "_day", "expected_points", "received_points", "error")


# --- guards and dead letters -----------------------------------------------------------
def require_grid(grid: DataFrame) -> None:
    """Refuse to ingest against an empty grid (nothing could ever be accepted)."""
    if grid.isEmpty():
        raise RuntimeError("the grid is empty: build grid points before ingesting payloads")


DEAD_LETTER_COLUMNS = ("id_failure", "region_id", "region_name", "error", "run_ts")


def dead_letters(rejects: DataFrame, run_ts: Column, existing: DataFrame | None = None) -> DataFrame:
    """Rejected regions as failure-log rows: ids continue after the log's max id, in
    (region, day) order; one schema for every source (id, region, error, run time)."""
    from gridops.operators.ids import append_ids

    rid = F.col("region_id") if "region_id" in rejects.columns else F.lit(None).cast("long")
    rows = rejects.select(rid.alias("region_id"), "region_name", "error", F.col("_day"), run_ts.alias("run_ts"))
    out = append_ids(rows, ["region_name", "_day", "error"], "id_failure", existing=existing)
    return out.select(*DEAD_LETTER_COLUMNS)
