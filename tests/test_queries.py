"""Every registered query runs; the SQL-checkable ones equal DuckDB at sf0.001."""
import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from payrisk.plans.registry import QUERIES as REGISTRY
from payrisk.sources.tables import TABLES

MODELS = {"train_gbt", "gbt_test_scores", "eval_delayed_gbt", "train_boosted", "boosted_test_scores"}  # see test_boosting.py, test_train_model.py
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 5):.5f}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "txn_count_1m" in df.columns


def test_every_query_has_docstring_and_most_have_sql():
    qs, sql = queries(), oracle_sql()
    assert set(sql) <= set(qs)
    assert set(REGISTRY) - set(sql) == MODELS
    for name, fn in qs.items():
        assert fn.__doc__, name


@pytest.mark.parametrize("name", sorted(set(oracle_sql())))
def test_query_matches_duckdb(spark, con, name):
    df = queries()[name](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)
