"""Every registered query that has SQL gives the rows that DuckDB gives; the others run and keep their schema."""

import math
import os

import __spark_entry__ as entry
import duckdb
import pytest
from seqloom import catalog

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: These take many rounds; test_operators has them on small graphs.
SLOW = {"unitigs", "greedy_contigs", "kmeans_clusters"}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SLOW))
def test_query(spark, sql, name):
    df = catalog.QUERIES[name](spark, DIR)
    rows, order = df.collect(), sorted(df.columns)
    if name not in catalog.ORACLE_SQL:
        assert len(set(df.columns)) == len(df.columns)
        return
    r = sql.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in r.description]
    assert sorted(columns) == order
    want = sorted((tuple(plain(x[columns.index(c)]) for c in order) for x in r.fetchall()), key=repr)
    assert sorted((tuple(plain(x[c]) for c in order) for x in rows), key=repr) == want


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
