"""Every registered query against its SQL twin."""

import contextlib
import io

import duckdb
import pytest
from pyspark.sql import DataFrameWriter

from __spark_entry__ import entry, oracle_sql, queries
from check import compare_rows
from peerbench.catalogue import ORACLES, QUERIES
from peerbench.catalogue.views import TABLES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def written(monkeypatch):
    """Plans of the intermediate tables a query writes."""
    plans = []
    write = DataFrameWriter.parquet

    def parquet(self, *args, **options):
        plans.append(plan(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql_without_python_or_cross_joins(spark, con, sf, name, written):
    df = QUERIES[name](spark, sf)
    for text in [*written, plan(df)]:
        for word in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, word
    if name in ORACLES:
        out = compare_rows(df, con, name)
        assert out.startswith("ok"), out


def test_entry_has_rows(spark):
    df = entry(spark)
    kinds = {r["row_kind"] for r in df.select("row_kind").distinct().collect()}
    assert kinds == {"entity", "sub_industry_mean", "focus_mean", "sector_mean"}


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
