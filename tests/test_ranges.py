import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oxbow.operators import ranges
from oxbow.plans.registry import QUERIES
from oxbow.sources.tables import table
from tests.conftest import SF_SMALL, plan_text


def test_sequence_example(spark):
    seq = spark.createDataFrame(list(enumerate("CAGCCTA")), "pos long, symbol string")
    seq = ranges.symbol_positions(seq)
    qs = spark.createDataFrame([(0, 2, 4), (1, 5, 5), (2, 0, 6)], "query_id int, p long, q long")
    got = {r.query_id: r.min_value for r in ranges.range_min(seq, qs).collect()}
    assert [got[i] for i in range(3)] == [2, 4, 1]


def test_unknown_symbol_fails(spark):
    df = spark.createDataFrame([("A",), ("X",)], "s string")
    with pytest.raises(Exception):
        df.select(ranges.symbol_factor("s")).collect()


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(st.integers(0, 300), st.integers(-100, 100), max_size=80),
       st.lists(st.tuples(st.integers(-5, 320), st.integers(0, 300)), min_size=1, max_size=30))
def test_matches_brute_force(spark, positions, spans):
    pos = spark.createDataFrame(list(positions.items()) or [(0, 0)], "pos long, value long")
    if not positions:
        pos = pos.where(F.lit(False))
    queries = [(i, p, p + n) if i % 5 else (i, p + n, p) for i, (p, n) in enumerate(spans)]
    qs = spark.createDataFrame(queries, "query_id int, p long, q long")
    got = {r.query_id: r.min_value for r in ranges.range_min(pos, qs).collect()}
    for i, p, q in queries:
        inside = [v for k, v in positions.items() if p <= k <= q]
        assert got[i] == (min(inside) if inside else None), (i, p, q)


def test_long_ranges_and_negative_positions(spark):
    rng = random.Random(1)
    values = {p: rng.randint(-1000, 1000) for p in rng.sample(range(-3000, 70000), 9000)}
    pos = spark.createDataFrame(list(values.items()), "pos long, value long")
    spans = [(i, a, a + rng.choice([0, 1, 15, 16, 17, 255, 4096, 60000])) for i, a in
             enumerate(rng.sample(range(-4000, 71000), 60))]
    got = {r.query_id: r.min_value for r in
           ranges.range_min(pos, spark.createDataFrame(spans, "query_id long, p long, q long")).collect()}
    for i, p, q in spans:
        assert got[i] == min((v for k, v in values.items() if p <= k <= q), default=None)


def test_scattered_positions_are_shuffled_about_twice(spark):
    n, levels = 200_000, 4
    pos = spark.range(n).select((F.col("id") * 7919 % n).alias("pos"), F.col("id").alias("value")).repartition(16)
    rows = ranges.block_minima(pos, levels)
    one = rows.where("level = 1").count()
    shuffled = n                       # level 1 aggregates the scattered positions
    for level in range(2, levels + 1):
        shuffled += rows.where(F.col("level") == level - 1).count()
    assert one <= n / 15 and shuffled + rows.count() <= 2.3 * n


def test_no_null_keys_in_the_join(spark):
    qs = spark.createDataFrame([(1, 5, 2), (2, None, 3), (3, 0, 40)], "query_id long, p long, q long")
    pieces = ranges.query_pieces(qs, ranges.max_level(qs))
    assert pieces.where("level IS NULL OR block IS NULL").count() == 0
    pos = spark.range(20).select(F.col("id").alias("pos"), F.col("id").alias("value"))
    got = {r.query_id: r.min_value for r in ranges.range_min(pos, qs).collect()}
    assert got == {1: None, 2: None, 3: 0}


def test_plan_has_no_cartesian(spark):
    pos = spark.range(1000).select(F.col("id").alias("pos"), (F.col("id") % 7).alias("value"))
    qs = spark.range(50).select(F.col("id").alias("query_id"), (F.col("id") * 3).alias("p"),
                                (F.col("id") * 3 + 100).alias("q"))
    plan = plan_text(ranges.range_min(pos, qs))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _joined_without_broadcast(spark, name):
    """Rows of a registered query, whose run copied no join side to the driver."""
    df = QUERIES[name](spark, SF_SMALL)
    rows = {r.query_id: r.min_value for r in df.collect()}
    plan = plan_text(df)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
    return rows


def test_range_min_broadcasts_no_pieces(spark):
    events = {r.event_id: r.value for r in table(spark, SF_SMALL, "events").collect()}
    expected = {}
    for r in table(spark, SF_SMALL, "part").collect():
        p = r.p_partkey * 4
        expected[r.p_partkey] = min((events[k] for k in range(p, p + r.p_size + 1) if k in events), default=None)
    assert _joined_without_broadcast(spark, "range_min") == expected


def test_range_min_long_broadcasts_no_pieces(spark):
    events = {r.event_id: r.value for r in table(spark, SF_SMALL, "events").collect()}
    expected = {}
    for r in table(spark, SF_SMALL, "customer").collect():
        p = r.c_custkey * 3
        last = p + math.floor(abs(r.c_acctbal))
        expected[r.c_custkey] = min((events[k] for k in range(p, last + 1) if k in events), default=None)
    assert _joined_without_broadcast(spark, "range_min_long") == expected


def test_range_min_symbols_broadcasts_no_pieces(spark):
    factors = {r.event_id: 1 + r.user_id % 4 for r in table(spark, SF_SMALL, "events").collect()}
    expected = {}
    for r in table(spark, SF_SMALL, "part").collect():
        p = r.p_partkey * 4
        expected[r.p_partkey] = min((factors[k] for k in range(p, p + r.p_size * 3 + 1) if k in factors), default=None)
    assert _joined_without_broadcast(spark, "range_min_symbols") == expected


def test_range_min_long_has_two_pieces_a_level(spark):
    qs = table(spark, SF_SMALL, "customer").select(
        F.col("c_custkey").alias("query_id"), (F.col("c_custkey") * 3).alias("p"),
        (F.col("c_custkey") * 3 + F.floor(F.abs("c_acctbal")).cast("long")).alias("q"))
    levels = ranges.max_level(qs)
    pieces = ranges.query_pieces(qs, levels)
    most = pieces.groupBy("query_id", "level").count().agg(F.max("count").alias("n")).first()["n"]
    assert levels == 3 and most == 2
    assert pieces.where(F.col("first").between(0, F.col("last")) & (F.col("last") < ranges.RADIX)).count() == pieces.count()


def test_range_min_symbols_shuffles_its_positions_once(spark):
    df = QUERIES["range_min_symbols"](spark, SF_SMALL)
    df.collect()
    final = plan_text(df).split("== Initial Plan ==")[0]
    # One scan of the events, two of part: its ranges, and a row for each query.
    assert final.count("ReusedExchange") == 1 and final.count("Scan parquet") == 3, final
