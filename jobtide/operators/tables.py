"""Comparing tables, checking references, and calendar questions about runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.numbers import canonical


def not_present(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.join(present.select(key).distinct(), key, "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference has no parent; null references pass."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def reconcile(left: DataFrame, left_value: str, right: DataFrame, right_value: str) -> DataFrame:
    """Values that only one side has."""
    joined = left.join(right, left[left_value] == right[right_value], "full")
    return joined.filter(left[left_value].isNull() | right[right_value].isNull())


def latest_per_day(runs: DataFrame, day: str, created: str, since: str, until: str, position: str, usable: Column | None = None) -> DataFrame:
    """Newest usable row for each day in the window; the row listed first wins a tie."""
    inside = runs.filter(F.col(day).between(F.lit(since).cast("date"), F.lit(until).cast("date")))
    if usable is not None:
        inside = inside.filter(usable)
    # Aggregation keeps one candidate per day and task, whatever the size of a day.
    newest = F.max_by(F.struct(*inside.columns), F.struct(F.col(created), -F.col(position)))
    return inside.groupBy(F.col(day).alias("__day")).agg(newest.alias("__row")).select("__row.*")


def calendar(spark, since: str, days: int, name: str) -> DataFrame:
    first = F.lit(since).cast("date")
    return spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias(name))


def missing_dates(runs: DataFrame, day: str, since: str, days: int) -> DataFrame:
    return not_present(calendar(runs.sparkSession, since, days, day), runs, day)


def seeded_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """The same `n` distinct keys for the same seed, in an order the seed shuffles."""
    shuffled = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.select(key).distinct().orderBy(shuffled, F.col(key)).limit(n)


def column_differences(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns that are missing on a side or stand in another place."""
    if left.columns == right.columns:
        return []
    uneven = set(left.columns) ^ set(right.columns)
    moved = [a for a, b in zip(left.columns, right.columns) if a != b]
    return sorted(uneven.union(moved))


def _canonical_row(df: DataFrame) -> list[Column]:
    return [canonical(F.col(name), kind).alias(name) for name, kind in df.dtypes]


def diff_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the side that has more and by how many."""
    if column_differences(left, right):
        raise ValueError(f"columns differ: {column_differences(left, right)}")
    columns = left.columns
    tagged = left.select(*_canonical_row(left), F.lit(1).alias("__copies")).unionByName(
        right.select(*_canonical_row(right), F.lit(-1).alias("__copies"))
    )
    surplus = tagged.groupBy(*columns).agg(F.sum("__copies").alias("__surplus"))
    side = F.when(F.col("__surplus") > 0, "left_only").otherwise("right_only")
    return surplus.filter(F.col("__surplus") != 0).select(
        side.alias("side"), *columns, F.abs("__surplus").cast("bigint").alias("copies")
    )


def canonical_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Rows as pipe-joined text with NULL spelled out and line breaks flattened, sorted."""
    cells = [
        F.replace(F.coalesce(canonical(F.col(c), t), F.lit("NULL")), F.lit("\n"), F.lit(" "))
        for c, t in df.dtypes
    ]
    order = [f"__{i}" for i in range(len(cells))]
    line = F.concat_ws("|", *cells).alias(name)
    return df.select(line, *[c.alias(o) for c, o in zip(cells, order)]).orderBy(*order).select(name)
