"""Data-quality reports on the costing inputs (DQ1-DQ3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oxbow.functions.keys import model_option_key, pair_key
from oxbow.operators.costing import BASE_COLUMNS
from oxbow.plans.joins import bounded_broadcast


def null_price(base: DataFrame) -> DataFrame:
    """DQ1: options sold with no sales price."""
    return base.where(F.col("Sales_Price").isNull()).select(*BASE_COLUMNS)


def multi_cost_pairs(options: DataFrame) -> DataFrame:
    """DQ2: (model, option) pairs with more than one distinct material cost.

    Distinct costs, not rows: a pair listed twice at one cost is consistent.
    Spark plans this as a pre-aggregation on (key, cost) before the count per
    key, so a hot key is reduced map-side.
    """
    return (options.groupBy(pair_key("Model", "Option_Code").alias("ModelOptionKey"))
            .agg(F.countDistinct("Material_Cost").alias("n_costs"), F.count("*").alias("n_rows"))
            .where(F.col("n_costs") > 1))


def free_with_cost(base: DataFrame, options: DataFrame, broadcast_rows: int | None = None) -> DataFrame:
    """DQ3: options sold at price 0 whose (model, option) pair does have a cost.

    A semi join against the distinct priced keys; the key set is broadcast
    only behind a check of its size.
    """
    keys = (options.where(F.col("Material_Cost").isNotNull())
            .select(pair_key("Model", "Option_Code").alias("_k")).distinct())
    keys = bounded_broadcast(keys, broadcast_rows)
    free = base.where(F.col("Sales_Price") == 0) \
               .withColumn("_key", model_option_key("Model_Text", "Options_Code"))
    return free.join(keys, free["_key"] == keys["_k"], "left_semi").select(*BASE_COLUMNS)
