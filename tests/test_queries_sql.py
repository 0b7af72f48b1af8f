"""Every registered query of the audit operators against its SQL in DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

from tapelens.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if type(x).__name__ in ("bool", "bool_"):
        return str(bool(x))
    if hasattr(x, "isoformat"):
        return str(pd.Timestamp(x))
    return repr(float(x)) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)


def rows(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_equals_sql(spark, db, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), db.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_fingerprints_of_the_tables(spark):
    got = registry.queries()["profile_schema_fingerprints"](spark, SF).collect()
    assert {r.table_name for r in got} == set(TABLES) and all(r.n_files == 1 for r in got)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
