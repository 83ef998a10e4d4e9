"""Every registered query with SQL gives the same rows in DuckDB on the smallest tables."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from quaystone.plans import contract_queries

SF = "/root/testdata/sf0.001"


def plain(x):
    if x is None or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float, Decimal)):
        return round(float(x), 7)
    return x.isoformat() if isinstance(x, (date, datetime)) else str(x)


def same_as_sql(spark, module, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = module.QUERIES[name](spark, SF)
    cur = con.execute(module.ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(plain(x) for x in r) for r in cur.fetchall())
    got = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", list(contract_queries.ORACLE))
def test_contract_sql(spark, name):
    same_as_sql(spark, contract_queries, name)


def test_published_view_takes_no_job_per_file(spark):
    """Ten times the files take the same jobs, not one more for each file, and the rows are all there."""
    sizes, jobs = ("/root/testdata/sf0.001", "/root/testdata/sf0.01"), []
    last = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1)
    for sf in sizes:
        at = last()
        got = Counter(tuple(map(plain, r)) for r in contract_queries.published_view(spark, sf).collect())
        jobs.append(last() - at)
        con = duckdb.connect()
        for t in ("published_trip", "artifact_manifest"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        assert got == Counter(tuple(map(plain, r)) for r in con.execute(contract_queries.ORACLE["published_view"]).fetchall())
    assert 0 < jobs[0] and jobs[1] - jobs[0] < 10, jobs


def test_entry_lists_everything(spark):
    import __spark_entry__ as e

    assert set(contract_queries.QUERIES) == set(contract_queries.ORACLE)
    assert set(e.oracle_sql()) <= set(e.queries()) and e.entry(spark).count() > 0
