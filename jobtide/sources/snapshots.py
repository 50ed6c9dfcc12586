"""Dated CSV snapshots of the published tables: <root>/<date>/<mart>.csv."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide import fixed_values as fixed
from jobtide.functions.numbers import blank_to_null
from jobtide.session import local_frame
from jobtide.sources.one_file import write_csv_file
from jobtide.sources.tables import exists, names_in
from jobtide.sources.versions import Version, VersionedTables

SNAPSHOT_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")
SNAPSHOT_DATE = r"/(\d{4}-\d{2}-\d{2})/"

MART_SCHEMAS = {
    "mart_skill_frequency": (
        "skill_key string, display_name string, category string, postings bigint, "
        "postings_with_text bigint, pct_of_postings double"
    ),
    "mart_language_requirement": (
        "population string, postings bigint, requires_german bigint, mentions_english bigint, "
        "english_without_german bigint, pct_requires_german double, pct_english_without_german double"
    ),
    "mart_city_stats": (
        "city string, region string, postings bigint, home_office_postings bigint, "
        "postings_with_salary bigint, median_salary_from int"
    ),
    "mart_salary_by_skill": (
        "skill_key string, display_name string, category string, postings_with_salary bigint, "
        "median_salary_from int, median_salary_to int, min_salary_from int, max_salary_to int"
    ),
    "mart_pipeline_funnel": (
        "stage_order int, stage string, grain string, records bigint, pct_of_previous double, "
        "pct_of_first double, dropped bigint, grain_changes_here boolean"
    ),
}


# Cells read of a line: a file may have columns that are not, or no longer, of the mart.
SPARE_CELLS = 16


def export_snapshot(marts: dict[str, DataFrame], root: str, day: str) -> None:
    """Write each mart for the day as one CSV file, replacing an earlier export of the same day."""
    for name in fixed.MART_NAMES:
        write_csv_file(marts[name], f"{root}/{day}/{name}.csv")


def _days_with(spark: SparkSession, root: str, name: str) -> list[str]:
    """Days that have a file for the mart, with or without rows in it."""
    days = [d for d in names_in(spark, root) if SNAPSHOT_DAY.fullmatch(d)]
    return [d for d in days if exists(spark, f"{root}/{d}/{name}.csv")]


def complete_days(spark: SparkSession, root: str) -> list[str]:
    """Days on which every required mart is present; the optional one may be absent."""
    required = [n for n in fixed.MART_NAMES if n not in fixed.OPTIONAL_MARTS]
    return sorted(set.intersection(*[set(_days_with(spark, root, name)) for name in required]))


def read_mart(spark: SparkSession, root: str, name: str, days: list[str]) -> DataFrame:
    """One mart of some days, with the date taken from the path.

    Cells go by the names in their own file's header, in whatever order it has them; a column a file
    lacks is null, and so is an empty cell, never zero. Anything else that is no number of the
    column's type stops the read.
    """
    schema = T.DataType.fromDDL(MART_SCHEMAS[name])
    paths = [f"{root}/{day}/{name}.csv" for day in days if exists(spark, f"{root}/{day}/{name}.csv")]
    if not paths:
        return spark.createDataFrame([], f"snapshot_date date, {MART_SCHEMAS[name]}")
    cells = [f"_c{i}" for i in range(len(schema.names) + SPARE_CELLS)]
    lines = spark.read.schema(", ".join(f"{c} string" for c in cells)).csv(paths).select(
        F.col("_metadata.file_path").alias("file"), F.array(*cells).alias("cells")
    )
    # A line whose cells are column names for the most part, and two of them at least, is a header.
    names = F.array(*[F.lit(n) for n in schema.names])
    named = F.size(F.array_intersect(names, F.col("cells")))
    is_header = (named >= 2) & (2 * named > F.size(F.array_compact("cells")))
    headers = lines.filter(is_header).groupBy(F.col("file").alias("of_file")).agg(F.first("cells").alias("header"))
    rows = lines.filter(~is_header).join(headers, F.col("file") == F.col("of_file"))

    def column(field: T.StructField):
        cell = F.get("cells", (F.array_position("header", field.name) - 1).cast("int"))
        return blank_to_null(cell).cast(field.dataType).alias(field.name)

    day = F.regexp_extract("file", SNAPSHOT_DATE, 1).cast("date").alias("snapshot_date")
    return rows.select(day, *[column(f) for f in schema.fields])


def read_history(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All marts of all complete days, read from the files."""
    days = complete_days(spark, root)
    return {name: read_mart(spark, root, name, days) for name in fixed.MART_NAMES}


HISTORY_DAYS = "history_days"


def extend_history(spark: SparkSession, root: str, warehouse: str, days: list[str] | None = None) -> Version:
    """Add complete days to the stored history and publish it as one version.

    Only days it does not have yet are read, or those named, which are then read anew. The history of
    a mart is kept by days: a day more is a folder more.
    """
    draft = VersionedTables(spark, warehouse).draft()
    known = draft.before.runs(HISTORY_DAYS)
    there = complete_days(spark, root)
    wanted = [d for d in there if (d in days if days is not None else d not in known)]
    if not wanted:
        return draft.before
    for name in fixed.MART_NAMES:
        draft.write_runs(f"history_{name}", read_mart(spark, root, name, wanted), "snapshot_date", wanted)
    rows = local_frame(spark, [(d,) for d in wanted], "day string").select(F.col("day").cast("date").alias("snapshot_date"))
    draft.write_runs(HISTORY_DAYS, rows, "snapshot_date", wanted)
    return draft.publish()


def stored_history(version: Version) -> dict[str, DataFrame]:
    return {name: version.read(f"history_{name}") for name in fixed.MART_NAMES}
