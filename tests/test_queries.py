"""Every query that has SQL against DuckDB on the same tables."""
import glob
import math
import os

import duckdb
import pytest

from loomgene.plans import annotation, flows, functional, genes, names, rendering, sequences  # noqa: F401
from loomgene.plans.registry import QUERIES, SQL


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


def compare(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    rel = con.sql(SQL[name])
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    key = lambda r: [(x is None, str(x)) for x in r]
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=key)
    assert len(got) == len(want), (len(got), len(want))
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not wrong, wrong[:3]
    return len(got)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    assert compare(spark, sf, name) > 0


def test_queries_without_sql_run(spark, sf):
    for name in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[name](spark, sf).count() > 0
