"""Driver contract: entry point, registry, and a DuckDB cross-check of a
few queries on the smallest data folder."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from nutrilake.plans import catalog
from nutrilake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 0
    assert entry.entry(spark).columns == ["measure", "key", "value"]


def test_registry_consistent():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(sdf.columns)
    srows = sorted(repr(tuple(r[c] for c in order)) for r in sdf.collect())
    idx = [dcols.index(c) for c in order]
    drows = sorted(repr(tuple(r[i] for i in idx)) for r in drows)
    assert srows == drows


def test_query_names_are_descriptive():
    import re
    from nutrilake.plans import catalog
    for name in catalog.queries():
        assert "pipeline" not in name and not re.match(r"op\d+_", name)
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
