"""Queries of the training-data operators against their DuckDB SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from gridops.llm.oracles import ORACLES
from gridops.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    # whole numbers beside nulls come as floats from one side
    plain = lambda v: None if pd.isna(v) else v if isinstance(v, str) or v != int(v) else int(v)
    rows = [sorted(str(tuple(map(plain, r))) for r in x[columns].itertuples(index=False, name=None)) for x in (got, want)]
    assert rows[0] == rows[1] and rows[0]
