"""Declared schemas of the raw tables, checked where tables are given from outside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.sources.payloads import AIR_VARIABLES, DAILY_VARIABLES, HOURLY_VARIABLES

_PLACE = [("region_name", T.StringType()), ("point_no", T.LongType()), ("latitude", T.DoubleType()), ("longitude", T.DoubleType())]


def _schema(*fields, variables=()) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in [*fields, *[(c, T.DoubleType()) for _, c in variables]]])


RAW_SCHEMAS = {
    "regions": _schema(
        ("region_id", T.LongType()), ("region_name", T.StringType()), ("latitude", T.DoubleType()),
        ("longitude", T.DoubleType()), ("area_km2", T.DoubleType()),
    ),
    "raw_hourly": _schema(("id_hourly", T.LongType()), ("ts", T.TimestampNTZType()), ("region_id", T.LongType()), *_PLACE, variables=HOURLY_VARIABLES),
    "raw_daily": _schema(("id_daily", T.LongType()), ("date", T.DateType()), ("region_id", T.LongType()), *_PLACE, variables=DAILY_VARIABLES),
    "raw_air_quality": _schema(("ts", T.TimestampNTZType()), *_PLACE, ("load_seq", T.LongType()), variables=AIR_VARIABLES),
}

#: The tables that ingestion appends to, created if absent (``sources.loads``), and the
#: running id of each.
LANDED = {
    "raw_hourly": RAW_SCHEMAS["raw_hourly"],
    "raw_daily": RAW_SCHEMAS["raw_daily"],
    "raw_air": _schema(("id_air", T.LongType()), ("ts", T.TimestampNTZType()), *_PLACE, variables=AIR_VARIABLES),
    "extraction_failures": _schema(
        ("id_failure", T.LongType()), ("region_id", T.LongType()), ("region_name", T.StringType()),
        ("error", T.StringType()), ("run_ts", T.TimestampNTZType()),
    ),
    "broken_payloads": _schema(
        ("region_id", T.LongType()), ("payload", T.StringType()), ("error", T.StringType()), ("run_ts", T.TimestampNTZType()),
    ),
}
LANDED_IDS = {"raw_hourly": "id_hourly", "raw_daily": "id_daily", "raw_air": "id_air", "extraction_failures": "id_failure"}


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared columns and types of raw table ``name``; other columns are
    left out. A missing column, or one of a type that does not widen to the declared one,
    is an error here and not a surprise later."""
    out = []
    for field in RAW_SCHEMAS[name].fields:
        if field.name not in df.columns:
            raise ValueError(f"{name} lacks the column {field.name}")
        have = df.schema[field.name].dataType
        if have != field.dataType and not _widens(have, field.dataType):
            raise ValueError(f"{name}.{field.name} is {have.simpleString()}, declared {field.dataType.simpleString()}")
        out.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*out)


def _widens(have: T.DataType, want: T.DataType) -> bool:
    if isinstance(want, T.TimestampNTZType):
        return isinstance(have, T.TimestampType)
    if isinstance(want, T.DoubleType):
        return isinstance(have, T.NumericType)
    return isinstance(want, T.LongType) and isinstance(have, T.IntegralType)
