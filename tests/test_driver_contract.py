"""The driver contract: entry() smoke, and every query against its SQL oracle."""

import math

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert "effective_suppliers" in df.columns


def test_every_query_has_sql():
    import __spark_entry__ as e
    from civic_spark.plans import driver_queries
    rows_only = set(driver_queries.queries()) - set(e.oracle_sql())
    assert not rows_only


def _names():
    from civic_spark.plans import driver_queries
    return sorted(driver_queries.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(e.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)
