"""Every registered query runs on the smoke tables and equals its DuckDB oracle (order-insensitive)."""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF_SMOKE
from offerlake.plans.registry import ORACLE, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for rec in df.itertuples(index=False):
        out = []
        for v in rec:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and pd.isna(v)):
                out.append(None)
            elif isinstance(v, (int, float, np.integer, np.floating)) and not isinstance(v, bool):
                out.append(round(float(v), 6) if abs(v) < 1 << 53 else int(v))  # a null count turns a column of whole numbers into floats
            elif isinstance(v, (dt.date, dt.datetime)):
                out.append(pd.Timestamp(v).isoformat())
            else:
                out.append(str(v))
        rows.append(tuple(out))
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["clave_canonica", "categoria", "tiendas_comparadas"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMOKE)
    got = sdf.toPandas()
    exp = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _norm(got) == _norm(exp)


def test_report_makes_keys_once(spark):
    from offerlake.plans.registry import QUERIES
    plan = QUERIES["quality_report_long"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert plan.count(" AS _ktxt#") == 1
