import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from oxbow.plans.registry import ORACLE_SQL, QUERIES
from oxbow.sources.tables import TABLES
from tests.conftest import SF_SMALL

SLOW = {"stream_replay", "stream_replay_files", "stream_replay_messages", "stream_replay_paced"}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns[-2:] == ["Production_Cost", "Profit"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(entry_mod.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF_SMALL)
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in order)) for r in df.collect())
    idx = [ocols.index(c) for c in order]
    want = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["replay_schedule_slow", "ts_text_roundtrip", "replay_good_rows",
                                  "time_batches", "message_envelope"])
def test_results_do_not_depend_on_session_zone(spark, name):
    """Timestamps are zone-free: a session zone with a DST gap inside the
    replay window must not move any value."""
    q = entry_mod.queries()[name]
    cols = sorted(q(spark, SF_SMALL).columns)
    utc = sorted(map(repr, q(spark, SF_SMALL).select(*cols).collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = sorted(map(repr, q(spark, SF_SMALL).select(*cols).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ny == utc
