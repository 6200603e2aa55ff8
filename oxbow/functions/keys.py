"""Column builders for the option-costing keys and flags (SC1, SC5-SC9, FLT3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_token_sql(text: Column | str) -> Column:
    """First element of a split on one space (SQL ``SPLIT(t, ' ')[OFFSET(0)]``).

    A leading space yields an empty first token; NULL stays NULL.
    """
    return F.split(_col(text), " ", -1).getItem(0)


def first_token_ws(text: Column | str) -> Column:
    """First word after a split on any whitespace run (Python ``str.split()[0]``).

    Leading whitespace is skipped. Empty or blank text yields an empty token
    instead of an error; NULL stays NULL.
    """
    return F.regexp_extract(_col(text), r"(?U)^\s*(\S*)", 1)


def model_option_key(model_text: Column | str, code: Column | str,
                     whitespace: bool = False) -> Column:
    """``<first word of model text>_<code>``; NULL if either part is NULL."""
    first = first_token_ws(model_text) if whitespace else first_token_sql(model_text)
    return F.concat(first, F.lit("_"), _col(code))


def pair_key(model: Column | str, code: Column | str) -> Column:
    """``<model>_<code>`` for the options side; NULL-propagating ``concat``."""
    return F.concat(_col(model), F.lit("_"), _col(code))


def zero_cost_flag(price: Column | str) -> Column:
    """0 when the price is zero or negative, NULL otherwise (NULL price too)."""
    return F.when(_col(price) <= 0, F.lit(0))
