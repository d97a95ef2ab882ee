"""Scalar helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used inside a lambda is evaluated for every array element, and
    adjacent projections are merged, so naming it as a column does not help; bound
    as a lambda variable it is computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def safe_div(num: Column, den: Column) -> Column:
    """``num / den``; NULL when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clip_lower(value: Column, lower: float = 0.0) -> Column:
    """Lower bound that keeps NULL (``greatest`` would turn NULL into the bound)."""
    return F.when(value < lower, F.lit(lower)).otherwise(value)


def clean_integer(value: Column, null_token: str = "-") -> Column:
    """Text number with thousands marks -> bigint.

    The null token and missing values become 0; text that is still not an integer
    after stripping quotes and commas becomes NULL.
    """
    text = value.cast("string")
    stripped = F.regexp_replace(text, '[",]', "")
    return (
        F.when(text.isNull() | (text == null_token), F.lit(0).cast("bigint"))
        .otherwise(stripped.try_cast("bigint"))
    )


def drop_last_word(name: Column) -> Column:
    """Area name without its last whitespace-separated token."""
    return F.regexp_replace(name, r"\s+\S+$", "")


def safe_name(name: str) -> str:
    """Column name with every non-word character replaced by an underscore."""
    return re.sub(r"\W", "_", name)
