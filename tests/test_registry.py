"""Every registered query against its DuckDB twin on the smallest driver tables, plus the entry smoke."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from dailywire.sources.readers import DRIVER_TABLES
from tests.conftest import SF_SMALL


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 0
    assert "datetime" in df.columns and "total_number_of_articles" in df.columns


def test_every_query_has_a_unique_name_and_most_have_sql():
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 80
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 60


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    assert sorted(df.columns) == sorted(dcols)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(dcols, dtypes))
    assert _rows(df.columns, srows) == _rows(dcols, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
