"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "conversations",
          "documents", "embeddings", "labels", "pages"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = df.collect()
    oracle = E.oracle_sql()[name]
    res = con.execute(oracle)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, res.fetchall())
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle}").fetchall()}
    for c, t in df.dtypes:
        assert duck_types[c] == SPARK_TO_DUCK.get(t, t.upper()), (c, t, duck_types[c])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "seller_id", "orders", "items", "gmv", "on_time_rate", "avg_review"]
