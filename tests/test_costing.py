import os
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oxbow.operators import costing, quality
from oxbow.plans import mapping
from oxbow.sources import files, schema
from tests.conftest import SF_CHECK, plan_text

D = Decimal

# Expected rows for the sample inputs: (vehicle, arm, cost, profit).
GOLDEN = [
    (1, "exact", D("200"), D("300")),
    (2, "exact", D("600"), D("300")),
    (3, "avg", D("500"), D("-100")),
    (4, "default", D("36"), D("44")),
    (5, "zero", D("0"), D("0")),
    (6, "zero", D("0"), D("0")),
    (7, "default", D("4.5"), D("5.5")),
    (8, "avg", D("91"), D("29")),
    (9, "exact", D("181"), D("152")),
    (10, "avg", D("100.333333333"), D("99.666666667")),
]


def load(spark, paths):
    base = files.read_csv(spark, paths[0], schema.BASE_CSV_FIELDS)
    options = files.read_csv(spark, paths[1], schema.OPTIONS_CSV_FIELDS)
    return base, options


def test_sample_loads_by_position(spark, sample_csvs):
    base, options = load(spark, sample_csvs)
    assert base.count() == 10 and options.count() == 12
    assert base.columns == [f["name"] for f in schema.BASE_CSV_FIELDS]
    assert dict(base.dtypes)["Sales_Price"] == "decimal(28,9)"
    row8 = base.where("Vehicle_ID = 8").first()
    assert row8.Model_Text is None and row8.Sales_Price == D("120")


def test_golden_profit_rows(spark, sample_csvs):
    base, options = load(spark, sample_csvs)
    out = costing.option_profit(base, options, with_arm=True)
    assert dict(out.dtypes)["Production_Cost"] == "decimal(28,9)"
    got = {r.Vehicle_ID: r for r in out.collect()}
    assert len(got) == len(GOLDEN)
    for vid, arm, cost, profit in GOLDEN:
        r = got[vid]
        assert r.cost_arm == arm, vid
        assert r.Production_Cost == cost, vid
        assert r.Profit == profit, vid


def test_quantity_and_null_price(spark, sample_csvs):
    base, options = load(spark, sample_csvs)
    extra = spark.createDataFrame([(15, 1, "ROOF", "Roof", "K10 basic", None)], base.schema)
    out = {r.Vehicle_ID: r for r in costing.option_profit(base.unionByName(extra), options).collect()}
    assert out[15].Production_Cost == D("200") and out[15].Profit is None
    unit = {r.Vehicle_ID: r for r in costing.option_profit(base, options, per_unit=True).collect()}
    assert unit[2].Production_Cost == D("200") and unit[3].Production_Cost == D("250")


@pytest.mark.parametrize("kind", ["decimal(28,9)", "double"])
def test_fractional_quantity_is_not_rounded(spark, sample_csvs, kind):
    base, options = load(spark, sample_csvs)
    half = base.where("Vehicle_ID = 1").withColumn("Option_Quantities", F.lit("1.5").cast(kind))
    row = costing.option_profit(half, options).first()
    assert row.Production_Cost == D("300") and row.Profit == D("200")


def test_new_costs_are_seen_and_nothing_stays_cached(spark, workdir, sample_csvs):
    base, _ = load(spark, sample_csvs)
    path = os.path.join(workdir, "options")

    def costs(cost):
        spark.createDataFrame([("K10", "ROOF", "x", D(cost))], "Model string, Option_Code string, "
                              "Option_Desc string, Material_Cost decimal(28,9)") \
            .write.mode("overwrite").parquet(path)
        options = spark.read.parquet(path).withColumn("row_order", F.lit(1))
        one = costing.option_profit(base, options).where("Vehicle_ID = 1").first()
        two = costing.cost_lookup(base, options, order="row_order").where("Vehicle_ID = 1").first()
        quality.free_with_cost(base, options).collect()
        return one.Production_Cost, two.Production_Cost
    assert costs("10") == (D("10"), D("10"))
    assert costs("99") == (D("99"), D("99"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_wide_sides_are_not_broadcast(spark, sample_csvs):
    from oxbow.plans.joins import is_small
    _, options = load(spark, sample_csvs)
    assert is_small(options) and not is_small(options, 11)
    spark.conf.set("oxbow.broadcast.maxBytes", "200")
    try:
        assert not is_small(options)
    finally:
        spark.conf.unset("oxbow.broadcast.maxBytes")


def test_every_part_is_an_option_row(spark):
    part = spark.read.parquet(f"{SF_CHECK}/part.parquet")
    assert mapping.option_costs(spark, SF_CHECK).count() == part.count()


def test_arm_counts_on_driver_tables(spark):
    out = costing.option_profit(mapping.option_base(spark, SF_CHECK),
                                mapping.option_costs(spark, SF_CHECK), with_arm=True)
    counts = {r.cost_arm: r["count"] for r in out.groupBy("cost_arm").count().collect()}
    assert counts == {"zero": 2941, "exact": 24084, "avg": 26629, "default": 6346}


def test_bounded_broadcast_falls_back(spark, sample_csvs):
    base, options = load(spark, sample_csvs)
    small = costing.option_profit(base, options, broadcast_rows=1_000)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        none = costing.option_profit(base, options, broadcast_rows=0)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, none.collect()))
        plan = plan_text(none)
        assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "BroadcastHashJoin" in plan_text(small)


def test_multi_cost_pairs(spark, sample_csvs):
    _, options = load(spark, sample_csvs)
    got = {r.ModelOptionKey: r.n_costs for r in quality.multi_cost_pairs(options).collect()}
    assert got == {"K10_ROOF": 2, "K20_PAINT": 2, "Z1_BELT": 2}


def test_lookup_last_and_strict(spark, sample_csvs):
    base, options = load(spark, sample_csvs)
    opts = options.withColumn("row_order", F.monotonically_increasing_id())
    out = {r.Vehicle_ID: r.Production_Cost
           for r in costing.cost_lookup(base, opts, order="row_order", fallback=True).collect()}
    assert out[1] == D("250")         # last of 150, 250 in file order
    assert out[3] == D("350")         # code ROOF, last row
    assert out[4] is None             # no such code
    with pytest.raises(Exception):
        costing.cost_lookup(base, opts, order="row_order", strict=True).collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["x", "y"]),
                          st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=25))
def test_one_pass_averages_equal_direct(spark, rows):
    df = spark.createDataFrame(rows, "Model string, Option_Code string, Material_Cost int") \
        .withColumn("Material_Cost", F.col("Material_Cost").cast("double"))
    totals = costing.option_cost_totals(df)
    got = {r.Option_Code: r.Average_Cost for r in costing.avg_cost_by_code(totals).collect()}
    want = {r.Option_Code: r.a for r in df.groupBy("Option_Code").agg(F.avg("Material_Cost").alias("a")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert (got[k] is None and want[k] is None) or abs(got[k] - want[k]) < 1e-9
