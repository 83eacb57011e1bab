"""Every query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from driftlens import defaults
from driftlens.plans import catalog, schedule_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, list):
        return tuple(map(cell, x))
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return "null"
    return str(round(float(x), 9) + 0.0) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(cell(v) for v in r) for r in df.itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want) and len(got)


def test_vocabulary_is_the_references():
    """The reference keeps 50,000 terms, and so does the SQL."""
    assert defaults.MAX_FEATURES == 50_000 and f"LIMIT {defaults.MAX_FEATURES}\n" in catalog.ORACLE_SQL["tfidf_scores"]


def test_all_suppliers_take_part(spark, monkeypatch):
    """Suppliers from 20 up reach the links."""
    real, seen = schedule_queries.table, []
    suppliers = spark.sql("SELECT 27L AS s_suppkey, 'Supplier 27' AS s_name")
    monkeypatch.setattr(schedule_queries, "table", lambda s, d, name: suppliers if name == "supplier" else real(s, d, name))
    monkeypatch.setattr(schedule_queries.N, "link_project_rows", lambda incidents, chunks: seen.append(chunks) or chunks.selectExpr("'' AS incident_id", "chunk_id", "'' AS link_method", "0D AS confidence"))
    assert [r["chunk_id"] for r in schedule_queries.project_row_links(spark, SF).collect()] == ["supplier-27"] and len(seen) == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
