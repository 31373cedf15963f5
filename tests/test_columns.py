from datetime import date

import pytest
from pyspark.sql import functions as F

from gridops.functions.columns import (
    MIXED, NOT_SUNNY, SUNNY, clamp, period_of_day, round_half_away, sunshine_state, surrogate_key,
)
from gridops.operators.dims import date_attributes, dim_hour


def test_surrogate_key_matches_published_literal(spark):
    df = spark.range(1).select(surrogate_key(F.lit(1).cast("long"), F.lit(1).cast("long")).alias("k"))
    assert df.first().k == "ea66c06c1e1c05fa9f1aa39d98dc5bc1"


def test_surrogate_key_null_token(spark):
    df = spark.range(1).select(surrogate_key(F.lit(None).cast("long"), F.lit(2)).alias("k"), F.md5(F.lit("_dbt_utils_surrogate_key_null_-2")).alias("e"))
    r = df.first()
    assert r.k == r.e


@pytest.mark.parametrize("x,n,expected", [(0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.23456, 4, 1.2346), (0.05, 1, 0.1)])
def test_round_half_away(spark, x, n, expected):
    assert spark.range(1).select(round_half_away(F.lit(x), n).alias("r")).first().r == expected


def test_sunshine_labels(spark):
    df = spark.createDataFrame([(300.0,), (299.9,), (150.0,), (149.9,), (None,)], "g double")
    got = [r.s for r in df.select(sunshine_state("g", 300, 150).alias("s")).collect()]
    assert got == [SUNNY, MIXED, MIXED, NOT_SUNNY, MIXED]


def test_clamp_skips_nulls(spark):
    df = spark.createDataFrame([(None,), (150.0,), (-3.0,)], "x double")
    assert [r.c for r in df.select(clamp("x").alias("c")).collect()] == [0.0, 100.0, 0.0]


def test_period_of_day(spark):
    hours = [5, 6, 11, 12, 17, 18, 21, 22]
    df = spark.createDataFrame([(h,) for h in hours], "h long")
    got = [r.p for r in df.select(period_of_day("h").alias("p")).collect()]
    assert got == ["Nuit", "Matin", "Matin", "Après-midi", "Après-midi", "Soir", "Soir", "Nuit"]


def test_dim_hour_has_24_rows(spark):
    d = dim_hour(spark)
    assert d.count() == 24
    assert d.filter("hour_id = hour").count() == 24


def test_date_attributes(spark):
    df = spark.createDataFrame([(date(2026, 8, 22),), (date(2026, 8, 23),)], "date date").select(*date_attributes())
    r = {x.date: x for x in df.collect()}
    sat, sun = r[date(2026, 8, 22)], r[date(2026, 8, 23)]
    assert (sat.day_of_week, sat.day_name, sat.month_name) == (6, "Saturday", "August")
    assert (sun.day_of_week, sun.day_name) == (0, "Sunday")
    assert (sat.year, sat.month, sat.day) == (2026, 8, 22)
