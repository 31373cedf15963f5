"""The rows behind the data-quality summaries, and the split of a table into clean rows
and quarantine.

A failure is what ``operators.quality`` counts as one, so the rows of a check number its
summary:

* row-local kinds (not_null, range, value_set): a row per failing row, with its key and the
  value. All checks of a table are one array column computed in one scan (``violations``).
* ``accepted``: a row per distinct value outside the list.
* ``unique`` and ``unique_combo``: a row per repeated value or combination, with its copies.
* ``relationship``: a row per child row whose parent is missing.

Keys are texts: the key columns joined by ``|``, nulls as ``-``. Range values are texts with
six decimals (null if they have no such form), other values plain texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.operators import quality as q
from gridops.session import scratch_path

COLUMNS = ("check_name", "table_name", "row_key", "value")


def key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in columns])


def value_text(c: q.Check) -> Column:
    x = F.col(c.column)
    return x.try_cast("decimal(30,6)").cast("string") if c.kind == "range" else x.cast("string")


def violations(checks: Sequence[q.Check]) -> Column:
    """The row-local checks that a row fails: an array of (check_name, value, per_value)."""
    failed = []
    for c in checks:
        if c.kind not in q.ROW_LOCAL:
            raise ValueError(f"{c.name} is not decided by one row")
        bad = ~F.col(c.column).isin(*c.values) if c.kind == "accepted" else q.fails(c)
        # per_value: failures of this kind are values, not rows
        one = F.struct(F.lit(c.name).alias("check_name"), value_text(c).alias("value"), F.lit(c.kind == "accepted").alias("per_value"))
        failed.append(F.when(bad, one))
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def _row_local(df: DataFrame, table: str, checks: Sequence[q.Check], key: Sequence[str]) -> DataFrame:
    rows = df.select(key_text(key).alias("row_key"), F.explode(violations(checks)).alias("v"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select(
        "v.check_name",
        F.when(~F.col("v.per_value"), F.col("row_key")).alias("row_key"),
        F.col("v.value").alias("value"),
        F.when(~F.col("v.per_value"), F.col("row")).alias("row"),
    )
    # one row per value for value failures; row failures have their own number and all stay
    return rows.distinct().select("check_name", F.lit(table).alias("table_name"), "row_key", "value")


def _repeated(df: DataFrame, table: str, checks: Sequence[q.Check]) -> DataFrame:
    groups, hits = q.key_groups(df, checks)
    found = [
        F.when(hit, F.struct(F.lit(c.name).alias("check_name"), key_text(c.columns).alias("row_key"), F.col("_n").cast("string").alias("value")))
        for c, hit in zip(checks, hits, strict=True)
    ]
    rows = groups.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v"))
    return rows.select("v.check_name", F.lit(table).alias("table_name"), "v.row_key", "v.value")


def _orphans(tables: Mapping[str, DataFrame], c: q.Check, key: Sequence[str]) -> DataFrame:
    parent = tables[c.to_table].select(F.col(c.to_column).alias("_parent")).distinct()
    child = tables[c.table].filter(F.col(c.column).isNotNull())
    # keys meet their parents, not rows; what has none is a table, mostly small enough for
    # Spark to broadcast, so that the rows are scanned for it and not shuffled
    orphans = child.select(F.col(c.column).alias("_key")).distinct()
    orphans = orphans.join(parent, F.col("_key") == F.col("_parent"), "left_anti")
    path = scratch_path(child.sparkSession, "orphans")
    orphans.write.parquet(path)
    orphans = child.sparkSession.read.schema(orphans.schema).parquet(path)
    child = child.select(F.col(c.column).alias("_child"), key_text(key).alias("row_key"))
    lost = child.join(orphans, F.col("_child") == F.col("_key"), "left_semi")
    return lost.select(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), "row_key", F.col("_child").cast("string").alias("value"))


def failing_rows(tables: Mapping[str, DataFrame], checks: Sequence[q.Check], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """check_name, table_name, row_key, value: the failures of all ``checks``. ``keys`` names
    each table's key columns."""
    parts = []
    for t, cs in q.by_table([c for c in checks if c.kind in q.ROW_LOCAL]).items():
        parts.append(_row_local(tables[t], t, cs, keys[t]))
    for t, cs in q.by_table([c for c in checks if c.kind in ("unique", "unique_combo")]).items():
        parts.append(_repeated(tables[t], t, cs))
    parts += [_orphans(tables, c, keys[c.table]) for c in checks if c.kind == "relationship"]
    return q.union_all(parts)


def quarantine(df: DataFrame, checks: Sequence[q.Check], path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, failing rows with ``failed``, the names of the checks they fail), from one
    scan: the table is written once, in two folders, and each is read from its own. Together
    they hold every row once."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "quarantine")
    names = F.transform(violations(checks), lambda v: v["check_name"])
    clash = {"failed", "_quarantined"} & {x.lower() for x in df.columns}
    if clash:
        raise ValueError(f"the table has columns named {sorted(clash)}")
    marked = df.withColumn("failed", names).withColumn("_quarantined", F.size("failed") > 0)
    # both folders must be there to be read, also when one has no rows
    for side in ("true", "false"):
        marked.limit(0).drop("_quarantined").write.mode("append").parquet(f"{path}/_quarantined={side}")
    marked.write.mode("append").partitionBy("_quarantined").parquet(path)
    schema = marked.drop("_quarantined").schema
    clean = spark.read.schema(schema).parquet(f"{path}/_quarantined=false").drop("failed")
    return clean, spark.read.schema(schema).parquet(f"{path}/_quarantined=true")
