"""Hot keys: one key holding a third of all rows must not change results,
on the broadcast path or on the shuffle path (broadcast disabled)."""

from pyspark.sql import functions as F

from oxbow.operators import costing, reports
from oxbow.plans import mapping
from tests.conftest import SF_SMALL, plan_text

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_option_profit_hot_key_both_paths(spark):
    base = mapping.option_base(spark, SF_SMALL)
    hot = (F.col("Vehicle_ID") % 3) == 0
    base = (base.withColumn("Options_Code", F.when(hot, F.lit("Brand#2")).otherwise(F.col("Options_Code")))
                .withColumn("Model_Text", F.when(hot, F.lit("small ring")).otherwise(F.col("Model_Text"))))
    options = mapping.option_costs(spark, SF_SMALL)
    fast = sorted(map(tuple, costing.option_profit(base, options).collect()))

    def slow():
        df = costing.option_profit(base, options, broadcast_rows=0)
        assert "SortMergeJoin" in plan_text(df)
        return sorted(map(tuple, df.collect()))

    assert _with_conf(spark, NO_BROADCAST, slow) == fast


def test_group_report_hot_customer(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot = (F.col("o_orderkey") % 3) == 0
    cases = orders.select(F.col("o_orderkey").alias("id"),
                          F.when(hot, F.lit("hot")).otherwise(F.col("o_orderpriority")).alias("group_name"),
                          F.when(F.col("o_orderstatus") == "F", "OK").otherwise("X").alias("status"))
    groups = spark.createDataFrame([("hot", 2), ("1-URGENT", 3)], "name string, test_value int")

    got = _with_conf(spark, NO_BROADCAST, lambda: reports.group_pass_report(cases, groups).collect())
    rows = cases.collect()
    value = {"hot": 2, "1-URGENT": 3}
    for r in got:
        mine = [c for c in rows if c.group_name == r.group_name]
        passed = sum(c.status == "OK" for c in mine) or None
        total = passed * value[r.group_name] if passed and r.group_name in value else None
        assert tuple(r) == (r.group_name, len(mine), passed, value.get(r.group_name), total)
    assert any(r.group_name == "hot" and r.all_test_cases > 100 for r in got)
