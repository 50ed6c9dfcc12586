"""Figures for the report and the dashboard, and the dated history behind the trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.numbers import days_between, share
from jobtide.functions.text import stage_label
from jobtide.operators.aggregates import merge_groups, scale_to_leader
from jobtide.params import Params


def overall(language: DataFrame) -> DataFrame:
    """The row every percentage is a share of."""
    return language.filter(F.col("population") == "ALL")


def neither(total: Column, first: Column, second: Column) -> Column:
    """What is left of a total after two slices."""
    return total - first - second


def profile(postings: DataFrame) -> DataFrame:
    """Size and run span of the published postings."""
    return postings.agg(
        F.count("*").alias("total_postings"),
        F.count_distinct("run_date").alias("run_count"),
        F.min("run_date").alias("first_run"),
        F.max("run_date").alias("last_run"),
    )


def leaders(frequency: DataFrame, keys: list[str] = fixed.CLOUD_SKILLS) -> DataFrame:
    """The named tools, most frequent first."""
    named = frequency.filter(F.col("skill_key").isin(*keys))
    return named.orderBy(F.col("postings").desc(), "skill_key")


def lead_ratio(frequency: DataFrame, keys: list[str] = fixed.CLOUD_SKILLS) -> DataFrame:
    """How many times as often the leading named tool appears as the second (0 if that has none)."""
    ranked = frequency.filter(F.col("skill_key").isin(*keys)).withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("postings").desc(), "skill_key"))
    )

    def at(place: int, column: str) -> Column:
        return F.max(F.when(F.col("place") == place, F.col(column)))

    pair = ranked.agg(
        at(1, "display_name").alias("leader"),
        at(2, "display_name").alias("second"),
        at(1, "pct_of_postings").alias("leader_pct"),
        at(2, "pct_of_postings").alias("second_pct"),
    )
    ratio = F.when(F.col("second_pct") == 0, 0.0).otherwise(F.round(F.col("leader_pct") / F.col("second_pct"), 1))
    return pair.withColumn("ratio", ratio)


def headline(
    language: DataFrame, frequency: DataFrame, postings: DataFrame, keys: list[str] = fixed.CLOUD_SKILLS
) -> DataFrame:
    """One row of headline figures, put together from three single rows."""
    figures = overall(language).select(
        F.col("postings").alias("with_text"),
        "pct_requires_german",
        "pct_english_without_german",
        share(
            neither(F.col("postings"), F.col("requires_german"), F.col("english_without_german")), F.col("postings")
        ).alias("pct_neither"),
    )
    return merge_groups([], figures, profile(postings), lead_ratio(frequency, keys))


def kpis(language: DataFrame, frequency: DataFrame, cities: DataFrame) -> DataFrame:
    """The four tiles: (tile, value)."""
    tiles = overall(language).select(
        F.col("postings").cast("double").alias("Currently advertised"),
        F.col("pct_requires_german").alias("Require German"),
        frequency.agg(F.count("*")).scalar().cast("double").alias("Tools tracked"),
        cities.agg(F.count("*")).scalar().cast("double").alias("Cities hiring"),
    )
    return tiles.unpivot([], tiles.columns, "tile", "value")


def categories(frequency: DataFrame) -> DataFrame:
    return frequency.select("category").distinct().orderBy("category")


def ranked_skills(frequency: DataFrame, top: int = Params.top_skills) -> DataFrame:
    """Tools by share with bar widths scaled to the leader overall and within the category.

    A stable order: ties in share keep the order of the table (postings, then key).
    """
    scaled = scale_to_leader(frequency, "pct_of_postings", "width")
    scaled = scale_to_leader(scaled, "pct_of_postings", "width_in_category", ["category"])
    order = [F.col("pct_of_postings").desc(), F.col("postings").desc(), F.col("skill_key").asc()]
    position = F.row_number().over(Window.orderBy(*order))
    return scaled.select(
        position.cast("bigint").alias("position"),
        "skill_key", "display_name", "category", "pct_of_postings", "width", "width_in_category",
        (position <= top).alias("shown"),
    ).orderBy("position")


def language_split(language: DataFrame) -> DataFrame:
    """Three slices of all postings; null figures leave the rest null."""
    rest = F.round(
        neither(F.lit(100.0), F.col("pct_requires_german"), F.col("pct_english_without_german")), 1
    )
    row = overall(language).select(
        F.col("pct_requires_german").alias("Requires German"),
        F.col("pct_english_without_german").alias("English, no German required"),
        rest.alias("Neither stated"),
    )
    return row.unpivot([], row.columns, "slice", "pct")


def funnel_bars(funnel: DataFrame) -> DataFrame:
    """Stages with their label, bar width as a share of the first stage, and unit breaks."""
    everything = Window.orderBy("stage_order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first("records").over(everything)
    width = F.col("records").cast("double") / F.when(first == 0, 1).otherwise(first).cast("double") * 100
    return funnel.select(
        "stage_order",
        stage_label(F.col("stage")).alias("label"),
        "records",
        F.round(width, 2).alias("width"),
        "pct_of_first",
        F.col("grain_changes_here").alias("unit_break"),
    ).orderBy("stage_order")


def top_cities(cities: DataFrame, top: int = Params.top_cities) -> DataFrame:
    order = [F.col("postings").desc(), F.col("city").asc(), F.col("region").asc_nulls_last()]
    return cities.withColumn("region", F.lower("region")).orderBy(*order).limit(top)


def salary_ranking(salaries: DataFrame) -> DataFrame:
    """Tools by median salary; a missing median counts as zero, ties keep the table's order."""
    order = [F.coalesce("median_salary_from", F.lit(0)).desc(), F.col("skill_key").asc()]
    return salaries.select(
        "skill_key", "display_name", "category", "median_salary_from", "median_salary_to", "postings_with_salary"
    ).orderBy(*order)


def age_in_days(snapshot: Column, today: str) -> Column:
    return days_between(F.lit(today).cast("date"), snapshot)


def age_label(days: Column) -> Column:
    return (
        F.when(days <= 0, "today").when(days == 1, "yesterday").otherwise(F.concat(days.cast("string"), F.lit(" days ago")))
    )


def history(frequency: DataFrame, language: DataFrame) -> DataFrame:
    """One row per day: denominator, German share, and a map from tool to share.

    Both inputs carry `snapshot_date`; a day's map has one entry per tool of the dictionary.
    """
    shares = frequency.groupBy("snapshot_date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("skill_key", "pct_of_postings")))).alias("skills")
    )
    return (
        overall(language)
        .select("snapshot_date", "postings", "pct_requires_german")
        .join(shares, "snapshot_date", "left")
        .orderBy("snapshot_date")
    )


def tracked(history_rows: DataFrame) -> DataFrame:
    return history_rows.agg(
        F.min("snapshot_date").alias("first_date"),
        F.max("snapshot_date").alias("latest_date"),
        F.count("*").alias("days_tracked"),
    )


def trend(frequency: DataFrame) -> DataFrame:
    """Each tool's share per day with the change since the day before it was last seen."""
    previous = F.lag("pct_of_postings").over(Window.partitionBy("skill_key").orderBy("snapshot_date"))
    return frequency.select(
        "snapshot_date",
        "skill_key",
        "pct_of_postings",
        previous.alias("previous_pct"),
        F.round(F.col("pct_of_postings") - previous, 1).alias("change"),
    )
