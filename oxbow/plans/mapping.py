"""How the driver's TPC-H-like tables stand in for the jobs' own inputs.

* base (options sold)   = lineitem JOIN part on the part key
* options (costs)       = part, one option row per part; the code of small PROMO
                          parts is the brand, any other code is sold by no line
* test cases / groups   = orders JOIN customer JOIN nation / nation
* sequence / queries    = events (position = event_id) / part (ranges)

Each mapping is a projection the optimizer sees through: only the columns a
query uses are read from parquet, and the filters reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oxbow.functions.keys import first_token_sql
from oxbow.sources.tables import table

# Fixed values of the mapping (shared with the oracle SQL).
OPTION_TYPE = "PROMO"
OPTION_MAX_SIZE = 15
OPTION_EXCLUDED_BRANDS = ("Brand#1", "Brand#5")
NULL_GROUP_NATION = "NATION_7"      # its cases get a NULL group name
NO_PASS_NATION_KEY = 11             # its cases never pass
ABSENT_GROUP_NATION_KEY = 3         # its group has another name in the dimension
ABSENT_GROUP_NAME = "no such group"


def option_base(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """Options sold: one row per line item.

    Sales price is 0 when the line has no discount, else the extended price.
    ``with_nulls`` makes the price NULL for lines without discount and 0 for
    lines without tax, to exercise the NULL-price rules.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    if with_nulls:
        price = (F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
                 .when(F.col("l_tax") == 0, F.lit(0.0))
                 .otherwise(F.col("l_extendedprice")))
    else:
        price = F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    j = li.join(part, li["l_partkey"] == part["p_partkey"])
    return j.select(F.col("l_orderkey").alias("Vehicle_ID"),
                    F.col("l_quantity").alias("Option_Quantities"),
                    F.col("p_brand").alias("Options_Code"),
                    F.col("p_type").alias("Option_Desc"),
                    F.col("p_name").alias("Model_Text"),
                    price.alias("Sales_Price"))


def option_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Material costs, one row per part: Model = first word of the part name.
    The code is the brand for some parts and a code of its own for the others,
    so that lines meet all four cost arms."""
    part = table(spark, sf_dir, "part")
    sold = ((F.col("p_type") == OPTION_TYPE) & (F.col("p_size") <= OPTION_MAX_SIZE)
            & ~F.col("p_brand").isin(*OPTION_EXCLUDED_BRANDS))
    code = F.when(sold, F.col("p_brand")).otherwise(F.concat_ws("/", "p_brand", "p_type"))
    return part.select(first_token_sql("p_name").alias("Model"), code.alias("Option_Code"),
                       F.col("p_type").alias("Option_Desc"), F.col("p_retailprice").alias("Material_Cost"),
                       F.col("p_partkey").alias("row_order"))


def test_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dimension row per nation; one of them under a name that no case has."""
    nation = table(spark, sf_dir, "nation")
    name = F.when(F.col("n_nationkey") != ABSENT_GROUP_NATION_KEY, F.col("n_name")).otherwise(ABSENT_GROUP_NAME)
    return nation.select(name.alias("name"), (F.col("n_regionkey") + 1).alias("test_value"))


def group_name() -> F.Column:
    return F.when(F.col("n_name") != NULL_GROUP_NATION, F.col("n_name"))
