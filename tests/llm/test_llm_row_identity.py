"""Rows keep their identity through the pipeline's stages; repeated rows spread."""

import time
from collections import Counter

from pyspark.sql import functions as F

from oxbow.llm import common, exact_dedup, mixing, simhash, toxicity
from tests.llm.conftest import CLASHES, prose, tuples

LABELS = "doc_id long, quality int, toxic int"


def test_same_id_and_text_in_two_sources(spark):
    rows = [(1, prose(1, 80), "x"), (1, prose(1, 80), "y"), (2, prose(2, 80), "x"), (3, prose(3, 80), "y"),
            (None, prose(4, 60), "x"), (None, prose(4, 60), "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(2)
    df = df.select("*", *[F.concat(F.lit(c), "source").alias(c) for c in CLASHES])
    mix = mixing.mixed(df, weights=(1,), most=3)
    taken = Counter((r.doc_id, r.text, r.source) for r in mix.collect())
    want = Counter()
    for r in mixing.mixture(df.withColumn("keep_source", F.col("source")), (1,), 3, carry=("keep_source",)).collect():
        want[r.doc_id, r.size, r.keep_source] += r.copies
    assert Counter({(d, len(t.split()), s): n for (d, t, s), n in taken.items()}) == +want
    for out in (mix, exact_dedup.drop_copies(df), simhash.drop_near_copies(df)):
        assert out.columns == df.columns
        assert set(tuples(out)) <= set(tuples(df))  # no column of another row, none overwritten
    assert exact_dedup.drop_copies(df).count() == simhash.drop_near_copies(df).count() == 4


def test_toxicity_keeps_columns_of_any_name(spark):
    rows = [(i, prose(i, 20) + (" vileword" if i % 4 == 0 else "")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("z").alias(c) for c in CLASHES])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], LABELS)
    out = toxicity.drop_toxic(df, labels)
    assert out.columns == df.columns and 0 < out.count() < 300 and set(tuples(out)) <= set(tuples(df))


def test_many_repeated_rows_in_the_mix(spark):
    """A flight's work is quadratic in its block: 200,000 equal rows must not share one."""
    one = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"),
                                      F.lit("hot").alias("source"))
    other = spark.createDataFrame([(i, "w " * (1 + i % 50), "cold") for i in range(2000)],
                                  "doc_id long, text string, source string")
    df = common.materialize(one.unionByName(other))
    began = time.time()
    got = mixing.mixture(df, weights=(5, 2, 1)).select("size", "source_size", "target", "taken").collect()
    assert time.time() - began < 120
    assert len(got) == 202_000
    by = {}
    for r in got:
        total = by.setdefault(r.source_size, [r.target, 0, 0])
        total[1] += r.taken
        total[2] = max(total[2], r.size)
        # whole part, or one copy more: what the share asks for
        assert r.taken // max(r.size, 1) in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
    assert len(by) == 2 and all(abs(taken - target) <= most for target, taken, most in by.values())
    again = mixing.mixture(df.repartition(7), weights=(5, 2, 1)).select("size", "source_size", "target", "taken").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
