"""Order by long texts: fixed-size keys for the range partitioner, whole comparison."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oxbow.operators.replay import sort_json_lines
from oxbow.plans import ordering
from tests.conftest import plan_text


def expected(rows):
    """rows: (short, text) -> sorted as Spark does: nulls first, UTF-8 byte order."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


@pytest.mark.parametrize("heavy", [1, 7, 60, 10**6])
def test_prefix_classes(spark, monkeypatch, heavy):
    monkeypatch.setattr(ordering, "PREFIX", 4)
    rng = random.Random(heavy)
    common = "z" * 100_000
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, "", "ab", "abcd", "abcde", "abcdefgh" + str(rng.randint(0, 40)),
                                                   "é\U0001f600ab" + str(rng.randint(0, 9)), "q" * rng.randint(0, 30),
                                                   "same text everywhere"])) for _ in range(400)]
    rows += [(3, common + str(rng.randint(0, 50))) for _ in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, s int, t string").repartition(5)
    got = ordering.with_ordinal_by_text(df, ["s"], "t", "no", heavy=heavy).collect()
    assert sorted(r["no"] for r in got) == list(range(1, len(rows) + 1))
    assert [(r["s"], r["t"]) for r in sorted(got, key=lambda r: r["no"])] == expected(rows)
    assert {r["id"] for r in got} == set(range(len(rows)))


def test_sampled_key_has_a_fixed_size(spark, monkeypatch):
    """What the range partitioner sees is a prefix, at every level."""
    seen = []
    original = ordering._numbered

    def spy(ordered, name, drop):
        seen.append(plan_text(ordered, "simple"))
        return original(ordered, name, drop)
    monkeypatch.setattr(ordering, "_numbered", spy)
    lines = spark.createDataFrame([(f'{{"ts": "{"t" * 100_000}{i % 3}", "n": {i}}}',) for i in range(90)], "value string")
    got = sort_json_lines(lines.repartition(3), "ts")
    assert len(seen) == 1
    monkeypatch.setattr(ordering, "ROWS_PER_PARTITION", 1000)
    seen.clear()
    again = sort_json_lines(lines.repartition(3), "ts")
    want = sorted((f"{i % 3}", f'{{"ts": "{"t" * 100_000}{i % 3}", "n": {i}}}') for i in range(90))
    for df in (got, again):
        assert [r["value"] for r in df.orderBy("_line_no").collect()] == [line for _, line in want]
    assert len(seen) > 1
    for plan in seen:
        ranges = re.findall(r"rangepartitioning\((.*?)\), REPARTITION", plan)
        assert ranges and not any("_ord_text" in r for r in ranges)


def test_json_lines_with_odd_fields(spark):
    lines = ['{"k": "a"}', '{"k": "a\\u0000b"}', '{"k": "a\\u0000"}', '{"k": ""}', '{"x": 1}', "no json", "", '{"k": null}',
             '{"k": "a", "z": 1}', '{"k": 7}', '{"k": "\\uffff"}', '{"k": "a"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    got = [r["value"] for r in sort_json_lines(df, "k").orderBy("_line_no").collect()]
    keys = {x: r for x, r in df.select("value", F.get_json_object("value", "$.k")).collect()}
    assert got == sorted(lines, key=lambda x: (keys[x] is not None, (keys[x] or "").encode(), x.encode()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("a\0\1b", max_size=4), st.text("a\0\1b", max_size=4)), max_size=8))
def test_text_key_orders_pairs(pairs):
    key = lambda p: (p[0].replace("\0", "\0\1") + "\0\0" + p[1]).encode()
    assert sorted(pairs, key=key) == sorted(pairs, key=lambda p: (p[0].encode(), p[1].encode()))
