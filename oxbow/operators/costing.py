"""Option costing and profit (JOB1, JOB2; AG1, AG2, AG6, JN1, JN2, JN5, JN6, SC1-SC4, SC10).

Inputs follow the declared schemas of the two CSVs:

* base:    Vehicle_ID, Option_Quantities, Options_Code, Option_Desc, Model_Text, Sales_Price
* options: Model, Option_Code, Option_Desc, Material_Cost

Money may be double or decimal. For decimals the typing rule is fixed so the
product of quantity and cost keeps nine fraction digits: money DECIMAL(28,9),
whole quantities DECIMAL(10,0), fractional ones DECIMAL(18,9), averages
DECIMAL(27,9), each cost arm cast back to DECIMAL(28,9) before ``coalesce``.

Plan shape: the options table is aggregated once, at (pair key, option code)
grain, into sums and counts; both averages are re-aggregations of that small
result. The two averaged sides are broadcast only behind a check of the totals'
size (``plans.joins.is_small``); the base side is never shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.functions.keys import model_option_key, pair_key, zero_cost_flag
from oxbow.plans.joins import is_small, maybe_broadcast

BASE_COLUMNS = ["Vehicle_ID", "Option_Quantities", "Options_Code", "Option_Desc",
                "Model_Text", "Sales_Price"]
OUTPUT_COLUMNS = BASE_COLUMNS + ["Production_Cost", "Profit"]

MONEY = T.DecimalType(28, 9)
AVERAGE = T.DecimalType(27, 9)
QUANTITY = T.DecimalType(10, 0)
FRACTIONAL_QUANTITY = T.DecimalType(18, 9)

# Fixed value: the share of the sales price used as the default production cost.
DEFAULT_COST_SHARE = "0.45"


def _is_decimal(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.DecimalType)


def option_cost_totals(options: DataFrame, model: str = "Model", code: str = "Option_Code",
                       cost: str = "Material_Cost") -> DataFrame:
    """One pass over the options: (ModelOptionKey, Option_Code, cost_sum, cost_n).

    ``cost_n`` counts non-null costs, so ``cost_sum / cost_n`` is SQL ``AVG``.
    Grouping keeps the code next to the key because two (model, code) pairs
    can concatenate to the same key.
    """
    return (options
            .groupBy(pair_key(model, code).alias("ModelOptionKey"), F.col(code).alias("Option_Code"))
            .agg(F.sum(cost).alias("cost_sum"), F.count(cost).alias("cost_n")))


def _mean(total: Column, n: Column, decimal: bool) -> Column:
    if decimal:
        q = total.cast(T.DecimalType(38, 9)) / n.cast(T.DecimalType(19, 0))
        return F.when(n > 0, q.cast(AVERAGE))
    return F.when(n > 0, total / n)


def avg_cost_by_key(totals: DataFrame, decimal: bool = False, counts: str | None = None) -> DataFrame:
    """AG1: mean material cost per ``<model>_<code>`` key (a NULL key is its own
    group); ``counts`` names a column for the number of costs behind it."""
    n = [F.sum("cost_n").alias(counts)] if counts else []
    return (totals.groupBy("ModelOptionKey")
            .agg(_mean(F.sum("cost_sum"), F.sum("cost_n"), decimal).alias("Material_Cost"), *n))


def avg_cost_by_code(totals: DataFrame, decimal: bool = False) -> DataFrame:
    """AG2: mean material cost per option code, over option rows (not over key means)."""
    return (totals.groupBy("Option_Code")
            .agg(_mean(F.sum("cost_sum"), F.sum("cost_n"), decimal).alias("Average_Cost")))


def option_profit(base: DataFrame, options: DataFrame, *, per_unit: bool = False,
                  broadcast_rows: int | None = None, with_arm: bool = False) -> DataFrame:
    """JOB1: production cost and profit per sold option.

    cost = first non-null of: 0 for price <= 0; quantity x mean cost of the
    exact (model, code) key; quantity x mean cost of the code; 0.45 x price.
    ``per_unit=True`` drops the quantity factor (SC4). Profit is 0 on the zero
    arm, else price - cost (NULL when the price is NULL).
    """
    decimal = _is_decimal(base, "Sales_Price") or _is_decimal(options, "Material_Cost")
    return profit_from_totals(base, option_cost_totals(options), per_unit=per_unit, broadcast_rows=broadcast_rows,
                              with_arm=with_arm, decimal=decimal)


def profit_from_totals(base: DataFrame, totals: DataFrame, *, per_unit: bool = False, broadcast_rows: int | None = None,
                       with_arm: bool = False, decimal: bool | None = None) -> DataFrame:
    """``option_profit`` from the (key, code) sums and counts of the costs."""
    if decimal is None:
        decimal = _is_decimal(base, "Sales_Price") or _is_decimal(totals, "cost_sum")
    # Both averaged sides are re-aggregations of the totals, so one check of
    # the totals bounds both of them.
    small = is_small(totals, broadcast_rows)
    by_key = maybe_broadcast(avg_cost_by_key(totals, decimal), small)
    by_code = maybe_broadcast(avg_cost_by_code(totals, decimal), small)

    b = base.select(*BASE_COLUMNS,
                    model_option_key("Model_Text", "Options_Code").alias("_key"),
                    zero_cost_flag("Sales_Price").alias("_zero"))
    j = (b.join(by_key, b["_key"] == by_key["ModelOptionKey"], "left")
          .join(by_code, b["Options_Code"] == by_code["Option_Code"], "left"))

    price = F.col("Sales_Price")
    exact, mean_code = F.col("Material_Cost"), F.col("Average_Cost")
    if decimal:
        price = price.cast(MONEY)
        whole = isinstance(base.schema["Option_Quantities"].dataType, T.IntegralType)
        qty = F.col("Option_Quantities").cast(QUANTITY if whole else FRACTIONAL_QUANTITY)
        share = F.lit(DEFAULT_COST_SHARE).cast(T.DecimalType(3, 2))
        arms = [F.col("_zero").cast(MONEY),
                (exact if per_unit else qty * exact).cast(MONEY),
                (mean_code if per_unit else qty * mean_code).cast(MONEY),
                (price * share).cast(MONEY)]
    else:
        qty = F.col("Option_Quantities")
        share = F.lit(float(DEFAULT_COST_SHARE))
        arms = [F.col("_zero").cast("double"),
                exact if per_unit else qty * exact,
                mean_code if per_unit else qty * mean_code,
                price * share]
    cost = F.coalesce(*arms)
    profit = F.when(F.col("_zero") == 0, F.lit(0).cast(MONEY if decimal else "double")) \
              .otherwise(price - cost)
    cols = [F.col(c) for c in BASE_COLUMNS[:-1]] + [price.alias("Sales_Price"),
                                                    cost.alias("Production_Cost"),
                                                    profit.alias("Profit")]
    if with_arm:
        arm = (F.when(F.col("_zero").isNotNull(), "zero")
               .when(arms[1].isNotNull(), "exact")
               .when(arms[2].isNotNull(), "avg")
               .when(arms[3].isNotNull(), "default"))
        cols.append(arm.alias("cost_arm"))
    return j.select(*cols)


def last_cost_by(options: DataFrame, key: Column, order: Column | str,
                 cost: str = "Material_Cost", key_name: str = "lookup_key") -> DataFrame:
    """AG6: one cost per key when building a lookup map; the row with the
    greatest ``order`` wins (the order is explicit, never arrival order)."""
    order_c = F.col(order) if isinstance(order, str) else order
    return (options.where(key.isNotNull())
            .groupBy(key.alias(key_name))
            .agg(F.max_by(F.col(cost), order_c).alias("lookup_cost")))


def last_cost_pairs(options: DataFrame, order: str, cost: str = "Material_Cost") -> DataFrame:
    """One pass at (pair key, option code) grain: the last cost and its order.
    The last cost per key and per code are both re-aggregations of this."""
    return (options.groupBy(pair_key("Model", "Option_Code").alias("pair_key"),
                            F.col("Option_Code").alias("code"))
            .agg(F.max_by(F.col(cost), F.col(order)).alias("last_cost"),
                 F.max(F.col(order)).alias("last_order")))


def _last_of(pairs: DataFrame, key: str) -> DataFrame:
    return (pairs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("lookup_key"))
            .agg(F.max_by("last_cost", "last_order").alias("lookup_cost")))


def _lookup(base: DataFrame, table: DataFrame, base_key: Column, name: str,
            small: bool) -> DataFrame:
    side = maybe_broadcast(
        table.select(F.col("lookup_key").alias(f"{name}_key"),
                     F.col("lookup_cost").alias(f"{name}_cost"),
                     F.lit(True).alias(f"{name}_hit")),
        small)
    return base.join(side, base_key == side[f"{name}_key"], "left")


def cost_lookup(base: DataFrame, options: DataFrame, *, order: str, fallback: bool = False,
                strict: bool = False, whitespace_key: bool = True,
                broadcast_rows: int | None = None) -> DataFrame:
    """JOB2: side-input style lookups.

    Exact map: ``<first word>_<code>`` -> cost (JN5); with ``fallback=True`` a
    second map option code -> cost fills misses (JN6). Duplicate keys keep the
    row with the greatest ``order``. A miss is NULL, or an error with
    ``strict=True``. Output follows the declared profit schema; the lookup job
    computes no profit, so ``Profit`` is NULL.

    Both maps come from one aggregation of the options at (key, code) grain;
    one check of its size decides whether the maps are broadcast.
    """
    b = base.select(*BASE_COLUMNS,
                    model_option_key("Model_Text", "Options_Code", whitespace=whitespace_key)
                    .alias("_key"))
    pairs = last_cost_pairs(options, order)
    small = is_small(pairs, broadcast_rows)
    j = _lookup(b, _last_of(pairs, "pair_key"), F.col("_key"), "exact", small)
    cost = F.col("exact_cost")
    hit = F.col("exact_hit").isNotNull()
    if fallback:
        j = _lookup(j, _last_of(pairs, "code"), F.col("Options_Code"), "code", small)
        cost = F.coalesce(cost, F.col("code_cost"))
        hit = hit | F.col("code_hit").isNotNull()
    if strict:
        cost = F.when(hit, cost).otherwise(
            F.raise_error(F.concat(F.lit("no material cost for key "),
                                   F.coalesce(F.col("_key"), F.lit("NULL")))))
    money = base.schema["Sales_Price"].dataType
    return j.select(*BASE_COLUMNS, cost.alias("Production_Cost"),
                    F.lit(None).cast(money).alias("Profit"))
