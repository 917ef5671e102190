"""Every registered query against its DuckDB SQL on the smallest tables."""
import datetime
import math

import duckdb
import pytest

import __spark_entry__ as E
from minutebook.plans.registry import ORACLE, QUERIES
from minutebook.sources.tables import TABLES

from .conftest import SF_SMALL


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("\x1f".join(norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
                 "DoubleType()": "DOUBLE", "DateType()": "DATE", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLE[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = rows(rel.columns, rel.fetchall())
    assert {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields} == types
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_returns_rows(spark):
    assert E.entry(spark).count() > 0
