"""Test-group pass report (JOB5; AG3, AG4, JN3, JN4, SC10, SO1, FLT1).

Report per group name: all cases (non-null ids), passed cases (non-null ids
with status 'OK'; NULL when the group has no 'OK' row at all, 0 when its 'OK'
rows all have NULL ids), the group's test value from the dimension, and
value x passed. The NULL group never matches the dimension or the passed
side; duplicate dimension names fan out; dimension rows without cases are
absent.

The counts are additive, so they can be taken at any finer grain first
(``pass_counts``) -- e.g. per customer before a join that brings the group
name -- and summed per group afterwards (``group_pass_totals``). That is the
one-pass form of the two aggregates + left join; it reads the cases once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oxbow.plans.joins import bounded_broadcast
from oxbow.plans.ordering import with_rank

REPORT_COLUMNS = ["group_name", "all_test_cases", "passed_test_cases", "test_value", "total_value"]


def pass_counts(cases: DataFrame, keys: list[str], id_col: str = "id", status_col: str = "status",
                ok: str = "OK") -> DataFrame:
    """Partial counts per ``keys``: all_ids, ok_rows, ok_ids (all additive)."""
    is_ok = F.col(status_col) == ok
    return cases.groupBy(*keys).agg(
        F.count(id_col).alias("all_ids"),
        F.count(F.when(is_ok, F.lit(1))).alias("ok_rows"),
        F.count(F.when(is_ok, F.col(id_col))).alias("ok_ids"))


def group_pass_totals(counts: DataFrame, groups: DataFrame, group_col: str = "group_name",
                      name_col: str = "name", value_col: str = "test_value",
                      broadcast_rows: int | None = None) -> DataFrame:
    """Sum partial counts per group and attach the dimension value."""
    g = counts.groupBy(F.col(group_col).alias("group_name")).agg(
        F.sum("all_ids").alias("all_test_cases"),
        F.sum("ok_rows").alias("_ok_rows"),
        F.sum("ok_ids").alias("_ok_ids"))
    passed = F.when((F.col("_ok_rows") > 0) & F.col("group_name").isNotNull(), F.col("_ok_ids"))
    g = g.select("group_name", "all_test_cases", passed.alias("passed_test_cases"))
    dim = bounded_broadcast(groups.select(F.col(name_col).alias("_dim_name"),
                                          F.col(value_col).alias("test_value")), broadcast_rows)
    j = g.join(dim, g["group_name"] == dim["_dim_name"], "left")
    return j.select("group_name", "all_test_cases", "passed_test_cases", "test_value",
                    (F.col("test_value") * F.col("passed_test_cases")).alias("total_value"))


def group_pass_report(cases: DataFrame, groups: DataFrame, **kw) -> DataFrame:
    """JOB5 on raw cases (id, group_name, status) and groups (name, test_value)."""
    return group_pass_totals(pass_counts(cases, ["group_name"]), groups, **kw)


def report_order():
    """ORDER BY total_value, group_name with NULLs first, ties broken by the rest."""
    return [F.col("total_value").asc_nulls_first(), F.col("group_name").asc_nulls_first(),
            F.col("all_test_cases").asc_nulls_first(), F.col("passed_test_cases").asc_nulls_first(),
            F.col("test_value").asc_nulls_first()]


def ordered_report(report: DataFrame) -> DataFrame:
    """SO1: the report with its rank ``rn`` in report order."""
    return with_rank(report, report_order(), "rn")
