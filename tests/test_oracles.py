"""Every registered query against its DuckDB oracle on the smallest driver tables:
same columns, same row count, same multiset of rows (exact values)."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from conftest import SF_SMALL
from gridops.plans.oracles import oracle_sql
from gridops.plans.registry import QUERIES

TABLES = ["supplier", "lineitem", "orders", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def _canon(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    out = []
    for row in df.itertuples(index=False):
        vals = []
        for v in row:
            if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NaT:
                vals.append(None)
            elif isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).tz_localize(None).isoformat())
            elif hasattr(v, "item"):
                vals.append(v.item())
            else:
                vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "kpi_potential_score" in df.columns


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    s = QUERIES[key](spark, SF_SMALL).toPandas()
    o = duck.execute(oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert _canon(s) == _canon(o)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
