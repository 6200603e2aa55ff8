"""Versioned loads, the kept profit view, one-pass quarantine."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from oxbow.operators import costing, profit_view, replay
from oxbow.plans import mapping
from oxbow.sinks import versions
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_readers_during_loads_see_whole_versions(spark, workdir):
    path = f"{workdir}/t"
    load = lambda k: versions.atomic_load(spark.range(1000).select("id", F.lit(k).alias("k")), None, path)
    load(0)
    seen, done, errors = [], threading.Event(), []

    def reader():
        try:
            while not done.is_set():
                got = versions.read(spark, path).groupBy("k").count().collect()
                seen.append([tuple(r) for r in got])
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    t = threading.Thread(target=reader)
    t.start()
    for k in range(1, 6):
        load(k)
    done.set()
    t.join()
    assert not errors
    assert all(len(s) == 1 and s[0][1] == 1000 for s in seen)       # one version, whole
    order = [s[0][0] for s in seen]
    assert order == sorted(order)


def test_failed_and_unfinished_loads(spark, workdir):
    path = f"{workdir}/t"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.atomic_load(spark.range(5), None, path)
    with pytest.raises(Exception, match="broken row"):
        versions.atomic_load(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id")),
                             None, path)
    with open(f"{path}/_manifests/000000000002.json", "w") as f:    # a writer that was lost
        f.write('{"folder": "v-gone", "ta')
    assert versions.read(spark, path).count() == 5 and versions.current(spark, path)[0] == 1
    versions.atomic_load(spark.range(7), None, path)
    assert versions.current(spark, path)[0] == 3 and versions.read(spark, path).count() == 7
    old = versions.atomic_load(spark.range(8), None, path)
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 4
    assert versions.vacuum(spark, path, keep=1) == 2                # the failed load's folder may be a running one
    assert old.count() == 8 and versions.read(spark, path).count() == 8
    assert versions.vacuum(spark, path, keep=1, leftover_hours=0) == 1
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 1


def test_two_loads_at_a_time(spark, workdir):
    path, numbers = f"{workdir}/t", []
    threads = [threading.Thread(target=lambda k=k: numbers.append(versions.publish(spark, path, {"data": spark.range(k)})))
               for k in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == [1, 2, 3, 4]
    assert versions.read(spark, path).count() in (1, 2, 3, 4)


def test_kept_view_equals_the_whole_computation(spark, workdir):
    base, options = mapping.option_base(spark, SF_SMALL, with_nulls=True), mapping.option_costs(spark, SF_SMALL)
    first = options.where("row_order <= 60")
    profit_view.create(base, first, workdir)
    sofar = first
    for low, high in ((60, 61), (61, 150), (150, 10**9)):
        delta = options.where(f"row_order > {low} AND row_order <= {high}")
        sofar = sofar.unionByName(delta)
        got = profit_view.add_options(spark, workdir, delta)
        money = lambda df: df.select(*df.columns[:5], *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in df.columns[5:]])
        assert rows(money(got)) == rows(money(costing.option_profit(base, sofar)))
    assert versions.current(spark, workdir)[0] == 4


def test_only_touched_rows_are_computed_again(spark, workdir):
    base, options = mapping.option_base(spark, SF_SMALL), mapping.option_costs(spark, SF_SMALL)
    kept = profit_view.create(base, options, workdir)
    delta = options.where("row_order = 7")
    marked = profit_view.touched(kept, costing.option_cost_totals(delta))
    n = marked.where("_touched").count()
    assert n == marked.where((F.col("Options_Code") == delta.first()["Option_Code"])).count()
    assert n < kept.count()
    assert rows(profit_view.add_options(spark, workdir, delta.limit(0))) == rows(kept)


def test_quarantine_reads_its_input_once(spark, workdir):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    data = [(1, "2024-01-01 00:00:00 UTC"), (2, ""), (3, None), (4, "at noon"), (5, "2024-01-01 00:00:00.5 UTC")]
    df = spark.createDataFrame(data, "id long, t string").repartition(2)
    good, bad, counts = replay.quarantine(df.mapInArrow(counted, df.schema), "t", f"{workdir}/q")
    want_good, want_bad = replay.split_bad_rows(df, "t")
    assert rows(good) == rows(want_good) and rows(bad) == rows(want_bad)
    assert good.columns == want_good.columns and bad.columns == want_bad.columns
    assert counts == {"good": 2, "bad": 3} and reads.value == 5
    none = replay.quarantine(df.limit(0), "t", f"{workdir}/n")
    assert none[0].count() == none[1].count() == 0 and none[2] == {"good": 0, "bad": 0}
