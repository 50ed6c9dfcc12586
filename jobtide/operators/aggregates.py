"""Aggregations that the built-in set does not offer in the needed form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.operators.ranking import join_null_safe, top_per_key
from jobtide.session import settle

# A sketch of a group misplaces a value by at most one row in so many.
SKETCH_ACCURACY = 20_000


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def any_true(condition: Column) -> Column:
    """Whether any row of the group meets the condition; null counts as no."""
    return F.max(F.when(condition, True).otherwise(False))


def sole_value(value: Column) -> Column:
    """The group's value if it has exactly one distinct value, else null."""
    return F.when(F.min(value) == F.max(value), F.max(value))


def exact_medians(df: DataFrame, keys: list[str], values: dict[str, Column], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact interpolated medians per group (percentile_cont(0.5)), one row per group.

    `values` maps result names to the measured columns; null values do not count. A first pass
    sketches every group, in partial sketches of bounded size, and brackets its middle by values a
    little below and above it, whatever their scale. A second pass counts what lies below the
    bracket and, by value, what lies inside: a few in `accuracy` of the group's rows, which are all
    that is ever put in order. A bracket that should miss the middle stops the query.
    """
    measures = [F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in values.items()]
    long = df.select(*keys, F.inline(F.array(*measures)).alias("__name", "__value")).filter(F.col("__value").isNotNull())
    group = [*keys, "__name"]
    # Three times the sketch's error away from the middle, rounded outwards in whole rows.
    margin = 3.0 / accuracy
    sketch = F.percentile_approx("__value", [max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)], accuracy)
    brackets = settle(long.groupBy(*group).agg(sketch.alias("__bracket"), F.count("*").alias("__total")))
    near = join_null_safe(long, brackets, group).filter(F.col("__value") <= F.col("__bracket")[1])
    inside = F.when(F.col("__value") >= F.col("__bracket")[0], F.col("__value"))
    counted = near.groupBy(*group, inside.alias("__value")).agg(F.count("*").alias("__n"), F.max("__total").alias("__total"))
    # What lies below the bracket is one row without a value, the first of its group.
    upto = Window.partitionBy(*group).orderBy(F.col("__value").asc_nulls_first())
    placed = counted.withColumn("__last", F.sum("__n").over(upto) - 1).withColumn("__first", F.col("__last") - F.col("__n") + 1)
    low, high = F.floor((F.col("__total") - 1) / 2), F.floor(F.col("__total") / 2)

    def middle_of(name: str) -> Column:
        def at(position: Column) -> Column:
            here = position.between(F.col("__first"), F.col("__last")) & (F.col("__name") == name)
            return F.max(F.when(here, F.col("__value")))

        missed = F.count_if(F.col("__name") == name).cast("boolean") & (at(low).isNull() | at(high).isNull())
        stop = F.raise_error(F.lit(f"the bracket of {name} misses its middle")).cast("double")
        return F.when(missed, stop).otherwise(at(low) + (at(high) - at(low)) * 0.5)

    return placed.groupBy(*keys).agg(*[middle_of(name).alias(name) for name in values])


def merge_groups(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Side by side what several results say about the same groups, each having one row per group.

    An aggregation instead of a join: null keys meet, and no part has to come first.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    others = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in others])


def joined_distinct(df: DataFrame, keys: list[str], value: str, separator: str, chars: int, name: str) -> DataFrame:
    """Sorted distinct values of each group joined by a separator and cut to `chars` characters.

    Every value after the first takes up at least its separator, so only the first
    ceil(chars / len(separator)) + 1 can reach the result; that bounds what a group collects.
    """
    reach = -(-chars // len(separator)) + 1
    distinct = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    leading = top_per_key(distinct, keys, [F.col(value).asc()], reach)
    joined = F.array_join(F.array_sort(F.collect_list(value)), separator)
    return leading.groupBy(*keys).agg(F.left(joined, F.lit(chars)).alias(name))


def by_group_and_all(
    df: DataFrame, key: str, counts: dict[str, Column], size: str, min_rows: int, label: str, all_label: str = "ALL"
) -> DataFrame:
    """Counts per group with at least `min_rows` rows, and one row over everything.

    `counts` maps column names to additive aggregates. The overall row is the sum of the groups
    and is present even when there are no rows at all.
    """
    groups = df.groupBy(F.col(key).alias(label)).agg(*[c.alias(n) for n, c in counts.items()])
    totals = [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in counts]
    overall = groups.agg(*totals).select(F.lit(all_label).alias(label), *counts)
    return groups.filter(F.col(size) >= min_rows).unionByName(overall)


def stack_columns(row: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    """Turn columns into rows of (column name, value)."""
    return row.unpivot([], columns, name, value)


def scale_to_leader(df: DataFrame, value: str, name: str, within: list[str] | None = None, digits: int = 1) -> DataFrame:
    """Each value as a percentage of the largest in its group, or of all: then one aggregate, and no row moves."""
    leader = F.max(value).over(Window.partitionBy(*within)) if within else df.agg(F.max(value)).scalar()
    scaled = F.col(value).cast("double") / F.when(leader == 0, 1).otherwise(leader).cast("double") * 100
    return df.withColumn(name, F.round(scaled, digits))
