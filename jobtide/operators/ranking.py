"""Ranking inside groups.

Four forms, by what the caller needs:

* `first_per_key` / `top_per_key` keep a bounded number of rows per key. Spark limits each group
  before the shuffle (WindowGroupLimit), so one huge key costs no more than a small one.
* `last_written_wins` keeps the last row per key of rows that are written, without moving their payloads.
* `number_small_groups` numbers every row of groups that are small by construction.
* `number_rows` numbers every row of groups of any size, in one plan for all sizes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.session import settle

# A group's sketch: about as many sampled rows as make its ranges even, of which every CUT-th is a splitter.
SKETCH_ROWS = 1024
CUT = 8


@dataclass(frozen=True)
class By:
    """One term of an order: an expression, its direction, and where its nulls go."""

    value: Column
    down: bool = False
    nulls_last: bool = False

    @property
    def sorted(self) -> Column:
        if self.down:
            return self.value.desc_nulls_last() if self.nulls_last else self.value.desc_nulls_first()
        return self.value.asc_nulls_last() if self.nulls_last else self.value.asc_nulls_first()


def _place(name: str, kind: T.DataType, term: By) -> tuple[Column, bool]:
    """A value that rises with the order of column `name`, and whether equal values mean equal terms."""
    at, exact = F.col(name), True
    if term.down:
        if isinstance(kind, T.BooleanType):
            at = ~at
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            at = F.bitwise_not(at)
        elif isinstance(kind, T.DateType):
            at = F.bitwise_not(F.unix_date(at))
        elif isinstance(kind, T.TimestampType):
            at = F.bitwise_not(F.unix_micros(at))
        elif isinstance(kind, T.DecimalType):
            at = -at
        else:
            # No value falls as these rise; all of the column's rows count as equal, and what follows it cannot part them.
            at, exact = F.lit(0), False
    null = at.isNotNull() if not term.nulls_last else at.isNull()
    return F.struct(null.alias("null"), at.alias("at")), exact


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Equi-join on keys where null equals null. `small` says the right side has a known bound."""
    theirs = {k: f"__their_{k}" for k in keys}
    right = right.withColumnsRenamed(theirs)
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(t)) for k, t in theirs.items()])
    return left.join(F.broadcast(right) if small else right, match, how).drop(*theirs.values())


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    position = rank or "__position"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= k)
    return kept if rank else kept.drop(position)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def last_wins(df: DataFrame, keys: list[str], read_order: list[str]) -> DataFrame:
    """Collapse rows sharing the keys, keeping the one read last."""
    return first_per_key(df, keys, [F.col(c).desc() for c in read_order])


def last_written_wins(rows: DataFrame, keys: list[str], read_order: list[str]) -> DataFrame:
    """`last_wins` for wide rows that lie in a table: who lost is settled on keys and places alone.

    `read_order` identifies a row and holds no nulls; null keys count as equal. The last place of a key is an
    aggregate that starts in each task, so a key of any share of the rows costs no more than others. The places
    of the rows that lost are written as a table, whose size tells the planner whether they fit beside each
    task; as long as rows are seldom read twice they do, and the wide rows are filtered where they lie, neither
    sorted nor shuffled. Beyond that the rows are joined by their place, which no two rows share.
    """
    narrow = rows.select(*dict.fromkeys([*keys, *read_order]))
    last = narrow.groupBy(*keys).agg(F.max(F.struct(*read_order)).alias("__last")).select("__last.*")
    lost = settle(narrow.select(*read_order).join(last, read_order, "left_anti"))
    return rows.join(lost, read_order, "left_anti").select(*rows.columns)


def number_small_groups(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, number.cast("bigint"))


def number_rows(df: DataFrame, keys: list[str], order: list[By], name: str, hot_rows: int) -> DataFrame:
    """row_number() over groups of any size; `order` has to be total within a group.

    The input is written once, with group and order beside it. A sample of the written rows, one in
    about hot_rows / SKETCH_ROWS, is the sketch: groups it shows to be large get splitters from its
    quantiles. Each row then lies in one of its group's ranges, ranges are counted, and a row's
    number is the count of the ranges before its own plus its number inside it. Groups without
    splitters are one range. Splitters and counts are small tables written beside the rows: at most
    SKETCH_ROWS / CUT ranges for each hot_rows / 2 rows read. Nothing is collected, and how the
    tables are joined is left to their sizes.
    """
    terms = {f"__by{i}": term for i, term in enumerate(order)}
    rows = df.withColumns({n: t.value for n, t in terms.items()})
    places = []
    for column, term in terms.items():
        at, exact = _place(column, rows.schema[column].dataType, term)
        places.append(at.alias(column))
        if not exact:
            break
    # Structs, so that null keys equal one another in joins.
    rows = settle(rows.withColumns({"__group": F.struct(*(keys or [F.lit(0)])), "__place": F.struct(*places)}))
    splitters = settle(_splitters(rows, list(terms), hot_rows))
    by = [By(F.col(n), t.down, t.nulls_last).sorted for n, t in terms.items()]
    if splitters.isEmpty():
        # No group is large: each is one range with nothing before it.
        whole = F.row_number().over(Window.partitionBy("__group").orderBy(*by))
        return rows.select(*df.columns, whole.cast("bigint").alias(name))
    cut = rows.join(splitters, F.col("__group") == F.col("__cut_group"), "left").withColumn(
        "__range", F.size(F.filter(F.coalesce("__cuts", F.array()), lambda c: c <= F.col("__place")))
    )
    sizes = cut.filter(F.col("__cuts").isNotNull()).groupBy("__group", "__range").agg(F.count("*").alias("__rows"))
    earlier = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(
        sizes.select(
            F.col("__group").alias("__in_group"), F.col("__range").alias("__in_range"),
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
        )
    )
    inside = Window.partitionBy("__group", "__range").orderBy(*by)
    numbered = cut.withColumn("__number", F.row_number().over(inside).cast("bigint")).join(
        before, (F.col("__group") == F.col("__in_group")) & (F.col("__range") == F.col("__in_range")), "left"
    )
    return numbered.select(*df.columns, (F.col("__number") + F.coalesce("__before", F.lit(0))).alias(name))


def _splitters(rows: DataFrame, terms: list[str], hot_rows: int) -> DataFrame:
    """__cut_group, __cuts (rising places) of the groups that a sample shows to hold more than half of hot_rows."""
    one_in = max(1, hot_rows // SKETCH_ROWS)
    sampled = rows.filter(F.pmod(F.xxhash64("__group", *terms), F.lit(one_in)) == 0)
    shown = sampled.groupBy("__group").agg(F.count("*").alias("__shown")).filter(F.col("__shown") * one_in > hot_rows // 2)
    held = shown.select(F.col("__group").alias("__cut_group"), "__shown")
    of_large = sampled.select("__group", "__place", F.xxhash64(*terms).alias("__digest")).join(
        held, F.col("__group") == F.col("__cut_group"), "left_semi"
    )
    # A bounded sketch per group, limited before the shuffle.
    kept = top_per_key(of_large, ["__group"], [F.col("__digest")], SKETCH_ROWS)
    quantiles = kept.groupBy("__group").agg(F.array_sort(F.collect_list("__place")).alias("__sketch"))
    picked = F.filter("__sketch", lambda x, i: i % CUT == CUT - 1)
    return quantiles.select(F.col("__group").alias("__cut_group"), F.array_distinct(picked).alias("__cuts"))
