"""Scalar column functions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schema import INDEX_CODES


def is_index(code: Column) -> Column:
    """True for the market indices, false for exchange codes."""
    return code.isin(*INDEX_CODES)


def is_business_day(day: Column) -> Column:
    return F.weekday(day) < 5


def business_day(day: Column) -> Column:
    """Roll a weekend day back into the Friday before it."""
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def next_business_day(day: Column) -> Column:
    """The weekday after ``day``."""
    wd = F.weekday(day)
    return F.date_add(day, F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1))


def clean(value: Column) -> Column:
    """Missing values are NULL in every table, never NaN."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def truncated(value: Column) -> Column:
    """Integer part, toward zero."""
    return value.cast("long")


def change_ratio(change: Column, close: Column) -> Column:
    """Percentage shown in summaries and captions: (1 + change) / close * 100, two digits.

    The ``1 +`` and the current close as divisor are the defined behaviour.
    """
    return F.round(F.try_divide(F.lit(1.0) + change, close) * 100.0, 2)


def signed_text(value: Column) -> Column:
    """Whole number with an explicit plus sign unless negative."""
    return F.when(value >= 0, F.concat(F.lit("+"), value.cast("string"))).otherwise(
        value.cast("string")
    )


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def trend_arrow(label: Column) -> Column:
    return F.when(label == 0, F.lit("↓")).when(label.isNotNull(), F.lit("↑"))


def display_name(name: Column, fullname: Column) -> Column:
    """The full name when there is one, else the short name."""
    return F.coalesce(F.when(fullname != "", fullname), name)


def title_case(text: Column) -> Column:
    return F.initcap(text)


def output_class(days: Column) -> Column:
    """Chart family by the length of the kept window: long above 300 bars, short up to 60."""
    return F.when(days > 300, "long").when(days <= 60, "short").otherwise("chart")


def local_date(text: Column) -> Column:
    """Parse dates written like 2015年3月20日."""
    return F.to_date(text, "yyyy年M月d日")
