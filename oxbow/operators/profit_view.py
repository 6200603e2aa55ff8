"""A kept profit table that follows new material costs (SNK2, JOB1).

The view's rows and the sums and counts behind its averages are one version of a
versioned table (``sinks.versions``). New option rows are aggregated, added to the
sums, and only the rows whose key or code they touch are computed again; the others
are taken over. Readers see both tables of one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oxbow.functions.keys import model_option_key
from oxbow.operators.costing import BASE_COLUMNS, option_cost_totals, profit_from_totals
from oxbow.plans.joins import bounded_broadcast
from oxbow.sinks import versions

PROFIT, TOTALS = "profit", "totals"


def create(base: DataFrame, options: DataFrame, path: str) -> DataFrame:
    """Compute the view from all rows and keep it at ``path``."""
    spark = base.sparkSession
    totals = option_cost_totals(options)
    versions.publish(spark, path, {PROFIT: profit_from_totals(base, totals), TOTALS: totals})
    return read(spark, path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, PROFIT)


def touched(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` with ``_touched``: whether the option rows behind ``totals`` change
    an average that the row may use. Hot codes stay where they are: the touched keys
    and codes are broadcast behind a check of their size."""
    keys = bounded_broadcast(totals.where("ModelOptionKey IS NOT NULL").groupBy(F.col("ModelOptionKey").alias("_tk")).count()
                             .select("_tk"))
    codes = bounded_broadcast(totals.where("Option_Code IS NOT NULL").groupBy(F.col("Option_Code").alias("_tc")).count()
                              .select("_tc"))
    keyed = rows.withColumn("_key", model_option_key("Model_Text", "Options_Code"))
    found = (keyed.join(keys, F.col("_key") == F.col("_tk"), "left")
             .join(codes, F.col("Options_Code") == F.col("_tc"), "left"))
    return found.withColumn("_touched", F.col("_tk").isNotNull() | F.col("_tc").isNotNull()).drop("_key", "_tk", "_tc")


def add_options(spark: SparkSession, path: str, options: DataFrame) -> DataFrame:
    """Add option rows to the kept view; returns it as it is then."""
    number, _ = versions.current(spark, path)
    old, sums = versions.read(spark, path, PROFIT), versions.read(spark, path, TOTALS)
    delta = option_cost_totals(options).select(sums.columns)
    delta = delta.select(*[F.col(f.name).cast(f.dataType) for f in sums.schema])
    totals = (sums.unionByName(delta).groupBy("ModelOptionKey", "Option_Code")
              .agg(F.sum("cost_sum").alias("cost_sum"), F.sum("cost_n").alias("cost_n")))
    totals = totals.select(*[F.col(f.name).cast(f.dataType) for f in sums.schema])
    marked = touched(old, delta)
    again = profit_from_totals(marked.where("_touched").select(*BASE_COLUMNS), totals)
    rows = marked.where("NOT _touched").select(old.columns).unionByName(again.select(old.columns))
    if versions.current(spark, path)[0] != number:
        raise RuntimeError(f"{path} was changed by another writer")
    versions.publish(spark, path, {PROFIT: rows, TOTALS: totals})
    return read(spark, path)
