"""Column-expression helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal upstream for identical results -------------------------
# Null placeholder of the md5 surrogate-key convention (fields cast to text, joined by '-').
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
# Sunshine labels: sunny, not sunny, mixed.
SUNNY = "Ensoleillé"
NOT_SUNNY = "Non Ensoleillé"
MIXED = "Éclaircies / Mixte"
SUNSHINE_LABELS = (SUNNY, NOT_SUNNY, MIXED)
# Period-of-day labels and their inclusive hour ranges; every other hour is night.
MORNING, AFTERNOON, EVENING, NIGHT = "Matin", "Après-midi", "Soir", "Nuit"
PERIODS = ((6, 11, MORNING), (12, 17, AFTERNOON), (18, 21, EVENING))
# --------------------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the fields cast to text, '-'-joined, nulls replaced by a fixed token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def round_half_away(c: str | Column, n: int) -> Column:
    """Round half away from zero at n decimals, bit-identical to DuckDB's round(x*10^n)/10^n.

    Spark's round(x, n) rounds the shortest decimal repr and can differ from DuckDB
    in the last place (0.285 -> 0.29 vs 0.28); scaling first avoids that.
    """
    scale = float(10**n)
    return F.round(_c(c) * F.lit(scale), 0) / F.lit(scale)


def clamp(c: str | Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    """least(hi, greatest(lo, c)); like SQL, greatest/least skip nulls, so null -> lo."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), _c(c)))


def sunshine_state(c: str | Column, sunny: float, cloudy: float) -> Column:
    """>= sunny -> sunny; < cloudy -> not sunny; everything else, null included -> mixed."""
    x = _c(c)
    return F.when(x >= F.lit(sunny), SUNNY).when(x < F.lit(cloudy), NOT_SUNNY).otherwise(MIXED)


def period_of_day(hour: str | Column) -> Column:
    h = _c(hour)
    expr = None
    for lo, hi, label in PERIODS:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(NIGHT)


def idiv(c: str | Column, n: int) -> Column:
    """Integer division of a non-negative integral column (SQL `div`)."""
    return F.floor(_c(c) / F.lit(n)).cast("long")
