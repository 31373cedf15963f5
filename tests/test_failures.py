"""Failing rows behind the summaries, and the split into clean rows and quarantine."""

import collections

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gridops.operators import failures, quality as q
from gridops.plans import suite
from gridops.plans.graph import ModelGraph

T = "id long, s string, x double, b boolean"
ROWS = [(1, "a", 5.0, True), (2, "a", -1.0, None), (2, None, 101.0, False), (None, "z", None, True), (None, "z", None, True)]
CHECKS = [
    q.Check("not_null", "t", ("id",)),
    q.in_range("t", "x", min=0, max=100),
    q.value_set("t", "s", ["a"]),
    q.accepted("t", "s", ["a"]),
    q.unique("t", "id"),
    q.unique_combo("t", "id", "s"),
    q.relationship("t", "id", "p", "id"),
]


def test_rows_of_every_kind(spark):
    tables = {"t": spark.createDataFrame(ROWS, T), "p": spark.createDataFrame([(1,)], "id long")}
    got = collections.Counter(tuple(r) for r in failures.failing_rows(tables, CHECKS, {"t": ("id", "s")}).select("check_name", "row_key", "value").collect())
    assert got == collections.Counter([
        ("not_null:t.id", "-|z", None), ("not_null:t.id", "-|z", None),
        ("range:t.x", "2|a", "-1.000000"), ("range:t.x", "2|-", "101.000000"),
        ("value_set:t.s", "2|-", None), ("value_set:t.s", "-|z", "z"), ("value_set:t.s", "-|z", "z"),
        ("accepted:t.s", None, "z"),
        ("unique:t.id", "2", "2"),
        ("unique_combo:t.id+s", "-|z", "2"),
        ("relationship:t.id", "2|a", "2"), ("relationship:t.id", "2|-", "2"),
    ])
    summary = {r.check_name: r.failures for r in q.run_checks(tables, CHECKS).collect()}
    numbers = collections.Counter()
    for (name, _, _), n in got.items():
        numbers[name] += n
    assert {k: v for k, v in summary.items() if v} == dict(numbers)


def test_rows_number_the_suites_summaries(spark):
    g = ModelGraph(spark, SF_SMALL, materialize=True)
    tables = suite.tables(g)
    summary = {r.check_name: r.failures for r in q.run_checks(tables, suite.CHECKS).collect() if r.failures}
    rows = failures.failing_rows(tables, suite.CHECKS, suite.KEYS).groupBy("check_name").count().collect()
    assert summary == {r.check_name: r["count"] for r in rows} and summary


def test_one_scan_for_the_row_local_checks_of_a_table(spark, tmp_path):
    spark.createDataFrame(ROWS, T).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = failures.failing_rows({"t": t}, [c for c in CHECKS if c.kind in q.ROW_LOCAL], {"t": ("id",)})._jdf.queryExecution().executedPlan().toString()
    # AQE prints the initial plan as well
    assert plan.count("FileScan") <= 2 and plan.split("Initial Plan")[0].count("FileScan") == 1


def test_quarantine_holds_every_row_once(spark):
    local = [c for c in CHECKS if c.kind in q.ROW_LOCAL]
    df = spark.createDataFrame(ROWS, T)
    clean, bad = failures.quarantine(df, local)
    assert [tuple(r) for r in clean.collect()] == [ROWS[0]]
    got = collections.Counter((r.id, r.s, tuple(r.failed)) for r in bad.collect())
    assert got == collections.Counter([
        (2, "a", ("range:t.x",)), (2, None, ("range:t.x", "value_set:t.s")),
        (None, "z", ("not_null:t.id", "value_set:t.s", "accepted:t.s")), (None, "z", ("not_null:t.id", "value_set:t.s", "accepted:t.s")),
    ])
    clean, bad = failures.quarantine(df.filter("id = 1"), local)
    assert clean.count() == 1 and bad.count() == 0
    clean, bad = failures.quarantine(df.limit(0), local)
    assert clean.columns == df.columns and clean.count() == bad.count() == 0


def test_checks_of_many_rows_are_no_row_checks(spark):
    import pytest

    with pytest.raises(ValueError, match="not decided by one row"):
        failures.violations([q.unique("t", "id")])
    with pytest.raises(ValueError, match="columns named"):
        failures.quarantine(spark.createDataFrame(ROWS, T).withColumn("Failed", F.lit(1)), CHECKS[:1])
