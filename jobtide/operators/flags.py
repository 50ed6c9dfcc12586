"""Classification as Boolean columns: rows are marked, never dropped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.functions.text import finds_ignoring_case
from jobtide.params import ScopeRules


def in_scope(title: Column, rules: ScopeRules) -> Column:
    """Three-valued: a null title is neither in nor out of scope."""
    wanted = finds_ignoring_case(title, rules.include)
    excluded = finds_ignoring_case(title, rules.exclude)
    employer_only = finds_ignoring_case(title, rules.noise) & ~finds_ignoring_case(title, rules.head)
    return wanted & ~excluded & ~employer_only


def in_country(country: Column, home: str) -> Column:
    """Null where no country is established; unknown is not the same as elsewhere."""
    return country == F.lit(home)


def as_group(flag: Column) -> Column:
    """A flag as a grouping value: null falls in with false."""
    return F.when(flag, 1).otherwise(0)
