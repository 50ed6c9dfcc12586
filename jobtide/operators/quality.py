"""Data-quality checks. Each returns violations; an empty result is a pass."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.operators.tables import reconcile
from jobtide.session import local_frame


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    check: str = "not_null"

    def breaks(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class NonNegative:
    table: str
    column: str
    check: str = "non_negative"

    def breaks(self) -> Column:
        return F.col(self.column) < 0


@dataclass(frozen=True)
class AcceptedValues:
    table: str
    column: str
    values: tuple
    check: str = "accepted_values"

    def breaks(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]
    check: str = field(default="unique")

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    parent: str
    parent_column: str
    check: str = "relationships"


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values held by more than one row. A single-column key ignores nulls."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count("*").alias("rows_for_key")).filter("rows_for_key > 1")


def _as_text(df: DataFrame, column: str, kind: T.DataType | None = None) -> Column:
    """A value as text, the same for values that are equal."""
    kind = kind or df.schema[column].dataType
    value = F.col(column).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0).cast(kind)  # there are two zeros, which are equal
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    return F.to_json(value) if isinstance(kind, (T.ArrayType, T.StructType)) else value.cast("string")


def _shared_type(left: DataFrame, column: str, right: DataFrame, other: str) -> T.DataType:
    """The type in which Spark compares two columns."""
    kinds = [left.schema[column].dataType, right.schema[other].dataType]
    if kinds[0] == kinds[1]:
        return kinds[0]
    nulls = [F.lit(None).cast(kind) for kind in kinds]
    return left.sparkSession.range(1).select(F.coalesce(*nulls).alias("both")).schema["both"].dataType


def run_checks(tables: dict[str, DataFrame], checks: list) -> DataFrame:
    """One row per check with its number of violations.

    Every table is scanned once for all rules that concern it. A row gives an entry for each row rule it breaks and
    one with its key for each unique or reference rule; one count by (rule, key), which starts in each task, then
    answers all rules together. A key held by any share of the rows is one entry per task.
    """
    entries: dict[str, list[Column]] = {}

    def add(table: str, rule: int, when: Column, key: list[Column], parent: bool = False) -> None:
        texts = F.array(*key).cast("array<string>")
        entry = F.struct(F.lit(rule).alias("rule"), texts.alias("key"), F.lit(parent).alias("parent"))
        entries.setdefault(table, []).append(F.when(when, entry))

    for rule, check in enumerate(checks):
        df = tables[check.table]
        if isinstance(check, Unique):
            keyed = F.col(check.columns[0]).isNotNull() if len(check.columns) == 1 else F.lit(True)
            add(check.table, rule, keyed, [_as_text(df, c) for c in check.columns])
        elif isinstance(check, Relationship):
            parent = tables[check.parent]
            kind = _shared_type(df, check.column, parent, check.parent_column)
            add(check.table, rule, F.col(check.column).isNotNull(), [_as_text(df, check.column, kind)])
            known = F.col(check.parent_column).isNotNull()
            add(check.parent, rule, known, [_as_text(parent, check.parent_column, kind)], parent=True)
        else:
            add(check.table, rule, check.breaks(), [])
    found = [tables[t].select(F.inline(F.array_compact(F.array(*found)))) for t, found in entries.items()]
    by_key = reduce(DataFrame.unionByName, found).groupBy("rule", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.bool_or("parent").alias("has_parent")
    )
    by_rule = by_key.groupBy("rule").agg(
        F.count_if(F.col("rows") > 1).alias("repeated"),
        F.sum(F.when(F.col("has_parent"), 0).otherwise(F.col("rows"))).alias("lost"),
    )
    named = [(rule, c.check, c.table, c.column, isinstance(c, Unique)) for rule, c in enumerate(checks)]
    rules = local_frame(
        tables[checks[0].table].sparkSession, named, "rule int, check string, table_name string, column_name string, is_unique boolean"
    )
    violations = F.when(F.col("is_unique"), F.col("repeated")).otherwise(F.col("lost"))
    return rules.join(by_rule, "rule", "left").select(
        "check", "table_name", "column_name", F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")
    )


def growing_stages(funnel: DataFrame) -> DataFrame:
    """Stages larger than the one before. The funnel has eight rows, so one window task is fine."""
    order = Window.orderBy("stage_order")
    return (
        funnel.select(
            "stage_order",
            F.lag("stage").over(order).alias("previous_stage"),
            F.lag("records").over(order).alias("previous_records"),
            "stage",
            "records",
        )
        .filter(F.col("previous_records").isNotNull() & (F.col("records") > F.col("previous_records")))
    )


def tail_mismatch(funnel: DataFrame, frequency: DataFrame) -> DataFrame:
    """The last stage has to equal the denominator of every published rate."""
    tail = funnel.filter(F.col("stage") == "with_description").select(F.col("records").alias("funnel_tail"))
    published = frequency.select(F.col("postings_with_text").alias("published_denominator")).distinct()
    return reconcile(tail, "funnel_tail", published, "published_denominator")
