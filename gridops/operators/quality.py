"""Data-quality checks over any set of tables.

Kinds and what counts as one failure (the usual semantics of such tests):

* ``not_null``      rows where the column is null
* ``range``         rows outside [min, max] (``strict``: open bounds); null passes
* ``value_set``     rows whose value is not in the set; null fails
* ``accepted``      distinct non-null values outside the accepted list
* ``unique``        distinct non-null values occurring more than once
* ``unique_combo``  column combinations occurring more than once
* ``relationship``  non-null child rows without a parent key

Row-local kinds (not_null, range, value_set, accepted) of one table are folded
into a single aggregate, so the table is scanned once for all of them; the key
checks (unique, unique_combo) of one table share one grouping-sets aggregate,
i.e. one shuffle. The result is always one summary row per check, zero when the
table is clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_LOCAL = ("not_null", "range", "value_set", "accepted")
KINDS = ROW_LOCAL + ("unique", "unique_combo", "relationship")


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    columns: tuple[str, ...]
    min: float | None = None
    max: float | None = None
    strict: bool = False
    values: tuple = ()
    to_table: str | None = None
    to_column: str | None = None
    label: str = ""

    @property
    def name(self) -> str:
        base = f"{self.kind}:{self.table}.{'+'.join(self.columns)}"
        return f"{base}:{self.label}" if self.label else base

    @property
    def column(self) -> str:
        return self.columns[0]


def not_null(table: str, *cols: str) -> list[Check]:
    return [Check("not_null", table, (c,)) for c in cols]


def in_range(table: str, col: str, min=None, max=None, strict=False) -> Check:
    return Check("range", table, (col,), min=min, max=max, strict=strict)


def value_set(table: str, col: str, values: Iterable, label: str = "") -> Check:
    return Check("value_set", table, (col,), values=tuple(values), label=label)


def accepted(table: str, col: str, values: Iterable, label: str = "") -> Check:
    return Check("accepted", table, (col,), values=tuple(values), label=label)


def unique(table: str, col: str) -> Check:
    return Check("unique", table, (col,))


def unique_combo(table: str, *cols: str) -> Check:
    return Check("unique_combo", table, tuple(cols))


def relationship(table: str, col: str, to_table: str, to_column: str) -> Check:
    return Check("relationship", table, (col,), to_table=to_table, to_column=to_column)


def fails(c: Check) -> Column:
    """Whether a row fails a not_null, range or value_set check (null: it does not)."""
    x = F.col(c.column)
    if c.kind == "not_null":
        return x.isNull()
    if c.kind == "range":
        ok = F.lit(True)
        if c.min is not None:
            ok = ok & ((x > F.lit(c.min)) if c.strict else (x >= F.lit(c.min)))
        if c.max is not None:
            ok = ok & ((x < F.lit(c.max)) if c.strict else (x <= F.lit(c.max)))
        return ~ok  # null -> null -> not counted
    if c.kind == "value_set":
        return x.isNull() | ~x.isin(*c.values)
    raise ValueError(c.kind)


def _summary(c: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(c.name).alias("check_name"),
        F.lit(c.kind).alias("check_kind"),
        F.lit(c.table).alias("table_name"),
        F.lit("+".join(c.columns)).alias("column_name"),
        F.coalesce(failures.cast("long"), F.lit(0).cast("long")).alias("failures"),
    )


def _row_local(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-local checks of one table in one aggregate over one scan."""
    aggs = []
    for i, c in enumerate(checks):
        if c.kind == "accepted":
            x = F.col(c.column)
            aggs.append(F.countDistinct(F.when(~x.isin(*c.values), x)).alias(f"_c{i}"))
        else:
            aggs.append(F.sum(F.when(fails(c), 1).otherwise(0)).alias(f"_c{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[_summary(c, F.col(f"_c{i}")) for i, c in enumerate(checks)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def key_groups(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, list[Column]]:
    """The groups of all unique / unique_combo checks of one table from ONE grouping-sets
    aggregate (one shuffle per table, not one per check), with ``_n`` rows each, and for each
    check whether a group is one of its failures. ``grouping_id`` tells the sets apart."""
    cols = sorted({c for ch in checks for c in ch.columns})
    sets = list(dict.fromkeys(tuple(ch.columns) for ch in checks))

    def gid(columns) -> int:
        return sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in columns)

    n = F.count(F.lit(1)).alias("_n")
    if len(sets) == 1:  # a plain grouping: rows are shuffled without the number of their set
        groups = df.groupBy(*cols).agg(n).withColumn("_gid", F.lit(0))
    else:
        groups = df.groupingSets([list(s) for s in sets], *cols).agg(n, F.grouping_id().alias("_gid"))
    hits = []
    for ch in checks:
        hit = (F.col("_gid") == gid(ch.columns)) & (F.col("_n") > 1)
        hits.append(hit & F.col(ch.column).isNotNull() if ch.kind == "unique" else hit)
    return groups, hits


def _key_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The summaries of all unique / unique_combo checks of one table."""
    groups, hits = key_groups(df, checks)
    one = groups.agg(*[F.sum(F.when(hit, 1).otherwise(0)).alias(f"_c{i}") for i, hit in enumerate(hits)])
    rows = F.array(*[_summary(c, F.col(f"_c{i}")) for i, c in enumerate(checks)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union as a balanced tree (each union re-analyses its inputs; a chain is quadratic)."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _grouped(tables: Mapping[str, DataFrame], c: Check) -> DataFrame:
    df = tables[c.table]
    if c.kind == "unique":
        bad = df.filter(F.col(c.column).isNotNull()).groupBy(c.column).count().filter(F.col("count") > 1)
    elif c.kind == "unique_combo":
        bad = df.groupBy(*c.columns).count().filter(F.col("count") > 1)
    elif c.kind == "relationship":
        parent = tables[c.to_table].select(F.col(c.to_column).alias("_parent")).distinct()
        # one row per key and task is shuffled, however many rows hold the key
        child = df.filter(F.col(c.column).isNotNull()).groupBy(F.col(c.column).alias("_child")).agg(F.count(F.lit(1)).alias("_rows"))
        orphans = child.join(parent, child["_child"] == parent["_parent"], "left_anti")
        return orphans.agg(F.sum("_rows").alias("_n")).select(_summary(c, F.col("_n")).alias("r")).select("r.*")
    else:
        raise ValueError(c.kind)
    return bad.agg(F.count(F.lit(1)).alias("_n")).select(_summary(c, F.col("_n")).alias("r")).select("r.*")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], fold: bool = True) -> DataFrame:
    """One summary row per check: check_name, check_kind, table_name, column_name, failures.

    ``fold=False`` runs one aggregate per check instead (kept for measurement).
    """
    parts: list[DataFrame] = []
    local = [c for c in checks if c.kind in ROW_LOCAL]
    keyed = [c for c in checks if c.kind in ("unique", "unique_combo")]
    if fold:
        for t, cs in by_table(local).items():
            parts.append(_row_local(tables[t], cs))
        for t, cs in by_table(keyed).items():
            parts.append(_key_checks(tables[t], cs))
    else:
        parts += [_row_local(tables[c.table], [c]) for c in local]
        parts += [_grouped(tables, c) for c in keyed]
    parts += [_grouped(tables, c) for c in checks if c.kind == "relationship"]
    return union_all(parts)


def by_table(checks: Sequence[Check]) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for c in checks:
        out.setdefault(c.table, []).append(c)
    return out
