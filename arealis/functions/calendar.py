"""Calendar columns for month-keyed data."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

# Fixed value: months with extended school or public holidays.
HOLIDAY_MONTHS = (4, 7, 8, 10, 12)


def month_start(text: Column) -> Column:
    """``YYYY-MM`` text -> first day of the month; malformed text fails the job.

    A cast is several times faster than parsing with a pattern.
    """
    return F.concat(text, F.lit("-01")).cast("date")


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return year * 12 + month - 1


def month_sin(month: Column) -> Column:
    return F.sin((month - 1) * F.lit(math.pi / 6))


def month_cos(month: Column) -> Column:
    return F.cos((month - 1) * F.lit(math.pi / 6))


def holiday_month(month: Column) -> Column:
    """True in the extended-holiday months."""
    return month.isin(*HOLIDAY_MONTHS)


def month_key(year: Column, month: Column) -> Column:
    """``2025-03`` style key; text order equals time order."""
    return F.format_string("%d-%02d", year.cast("int"), month.cast("int"))


def year_month(text: Column) -> Column:
    """Parse ``YYYY-MM`` into a struct(year, month); NULL unless the month is 1-12."""
    year = F.regexp_extract(text, r"^(\d{4})-(\d{1,2})$", 1).try_cast("int")
    month = F.regexp_extract(text, r"^(\d{4})-(\d{1,2})$", 2).try_cast("int")
    return F.when(month.between(1, 12), F.struct(year.alias("year"), month.alias("month")))


def parse_year_month(value: str) -> tuple[int, int]:
    """Driver-side check of a job argument."""
    match = re.fullmatch(r"(\d{4})-(\d{1,2})", value.strip())
    if not match or not 1 <= int(match.group(2)) <= 12:
        raise ValueError("date must be YYYY-MM with month 1-12")
    return int(match.group(1)), int(match.group(2))


def month_sequence(start: str, end: str) -> Column:
    """Array of month starts from ``start`` to ``end`` inclusive."""
    first, last = parse_year_month(start), parse_year_month(end)
    if last < first:
        raise ValueError("the last month must not precede the first month")
    return F.sequence(
        F.make_date(F.lit(first[0]), F.lit(first[1]), F.lit(1)),
        F.make_date(F.lit(last[0]), F.lit(last[1]), F.lit(1)),
        F.expr("interval 1 month"),
    )
