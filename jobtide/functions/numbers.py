"""Rounding, shares, dates and canonical values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
PLAIN_NUMBER = "decimal(38,10)"


def share(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, in DOUBLE, null where the whole is zero."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), 1)


def half_even_int(value: Column) -> Column:
    """Round a double to int the way medians are published: ties to the even neighbour."""
    return F.bround(value, 0).cast("int")


def half_up_int(value: Column) -> Column:
    return F.round(value, 0).cast("int")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def epoch_date(seconds: Column) -> Column:
    """Calendar date (UTC) of a number of seconds given as text."""
    days = F.floor(seconds.cast("bigint") / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier)


def is_fresh(run_date: Column, newest: Column, days: int) -> Column:
    return days_between(newest, run_date) < days


def plausible(amount: Column, low: int, high: int) -> Column:
    return amount.between(low, high)


def canonical(value: Column, data_type: str) -> Column:
    """One text form per value, so that results of different engines can be compared.

    Numbers lose trailing zeros. A double that ten decimals cannot hold keeps its own text form.
    """
    if data_type.startswith("decimal") or data_type in ("double", "float"):
        exact = value.try_cast(PLAIN_NUMBER)
        held = exact.cast("double") == value.cast("double")
        plain = F.regexp_replace(exact.cast("string"), r"\.?0+$", "")
        return F.when(held, F.when(exact == 0, "0").otherwise(plain)).otherwise(value.cast("string"))
    return value.cast("string")
