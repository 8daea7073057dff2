"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from evidra.plans import corpus_queries, dialogue_queries, event_queries, report_queries  # noqa: F401
from evidra.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        cols = [d[0] for d in cur.description]
        assert sorted(cols) == sorted(df.columns)
        rows = [dict(zip(cols, r)) for r in cur.fetchall()]
        assert got == sorted(repr([plain(r[c]) for c in sorted(cols)]) for r in rows)
