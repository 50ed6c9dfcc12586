"""Published tables: tool frequency and salary, cities, language requirement, pipeline funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.numbers import half_even_int, half_up_int, plausible, share
from jobtide.functions.text import has_text
from jobtide.operators.aggregates import by_group_and_all, count_where, exact_medians, merge_groups
from jobtide.operators.dictionary import dictionary_match
from jobtide.params import Params

SKILL = ["skill_key", "display_name", "category"]


def with_text(postings: DataFrame, params: Params = Params(), text: str = "description") -> DataFrame:
    return postings.filter(has_text(F.col(text), params.description_min_chars))


def mentions(
    postings: DataFrame, skills: DataFrame, params: Params = Params(), grouped: bool = True
) -> DataFrame:
    """One row per posting and tool its description names.

    `grouped=False` lets word bounds apply to a pattern's first and last alternative only.
    """
    texts = with_text(postings, params).select("posting_id", "source", "description")
    found = dictionary_match(texts, "description", skills, "skill_key", "pattern", grouped)
    return found.select("posting_id", "source", *SKILL)


def skill_frequency(postings: DataFrame, mentioned: DataFrame, params: Params = Params()) -> DataFrame:
    """Postings naming each tool and their share of all postings with a description."""
    total = with_text(postings, params).agg(F.count("*")).scalar()
    counted = mentioned.groupBy(*SKILL).agg(F.count_distinct("posting_id").alias("postings"))
    return (
        counted.withColumn("postings_with_text", total)
        .withColumn("pct_of_postings", share(F.col("postings"), F.col("postings_with_text")))
        .orderBy(F.col("postings").desc(), "skill_key")
    )


def salary_by_skill(postings: DataFrame, mentioned: DataFrame, params: Params = Params()) -> DataFrame:
    """Medians and extremes of plausible annual salaries per tool with enough of them."""
    salaried = postings.filter(plausible(F.col("salary_from"), params.salary_low, params.salary_high))
    paid = salaried.select("posting_id", "salary_from", "salary_to").join(mentioned, "posting_id")
    sizes = paid.groupBy(*SKILL).agg(
        F.count("*").alias("postings_with_salary"),
        half_up_int(F.min("salary_from")).alias("min_salary_from"),
        half_up_int(F.max("salary_to")).alias("max_salary_to"),
    )
    mids = exact_medians(paid, SKILL, {"mid_from": F.col("salary_from"), "mid_to": F.col("salary_to")})
    both = merge_groups(SKILL, sizes, mids).filter(F.col("postings_with_salary") >= params.min_salaried)
    return both.select(
        *SKILL,
        "postings_with_salary",
        half_even_int(F.col("mid_from")).alias("median_salary_from"),
        half_even_int(F.col("mid_to")).alias("median_salary_to"),
        "min_salary_from",
        "max_salary_to",
    ).orderBy(F.col("median_salary_from").desc_nulls_last(), "skill_key")


def city_stats(postings: DataFrame, params: Params = Params()) -> DataFrame:
    place = ["city", "region"]
    named = postings.withColumn("city", F.coalesce("city", F.lit("Unknown")))
    sizes = named.groupBy(*place).agg(
        F.count("*").alias("postings"),
        count_where(F.col("allows_home_office")).alias("home_office_postings"),
        count_where(F.col("salary_from").isNotNull()).alias("postings_with_salary"),
    )
    paid = named.filter(plausible(F.col("salary_from"), params.salary_low, params.salary_high))
    both = merge_groups(place, sizes, exact_medians(paid, place, {"mid": F.col("salary_from")}))
    return (
        both.filter(F.col("postings") >= params.min_city_postings)
        .withColumn("median_salary_from", half_even_int(F.col("mid")))
        .drop("mid")
        .orderBy(F.col("postings").desc(), "city", F.col("region").asc_nulls_last())
    )


def language_requirement(postings: DataFrame, params: Params = Params()) -> DataFrame:
    """Counts and shares per source with enough postings, and always over all of them."""
    german, english = F.col("requires_german"), F.col("mentions_english")
    counts = {
        "postings": F.count("*"),
        "requires_german": count_where(german),
        "mentions_english": count_where(english),
        "english_without_german": count_where(english & ~german),
    }
    rows = by_group_and_all(
        with_text(postings, params), "source", counts, "postings", params.min_source_postings, "population"
    )
    return rows.withColumns(
        {
            "pct_requires_german": share(german, F.col("postings")),
            "pct_english_without_german": share(F.col("english_without_german"), F.col("postings")),
        }
    ).orderBy(F.col("postings").desc(), "population")


def _stage_counts(scored: DataFrame, runs: DataFrame) -> DataFrame:
    """All stage counts in one row, from a single pass over the scored rows.

    Counts are taken per run first, so that runs the manifest does not know fall back to their own.
    """
    reached = F.col("title_in_scope") & F.col("country_known")
    final = F.col("still_advertised") & (F.col("dedup_rank") == 1)
    conditions: list[Column] = [
        F.lit(True),
        F.col("title_in_scope"),
        reached,
        reached & (F.col("run_rank") == 1),
        F.col("still_advertised"),
        final,
        final & F.col("has_description"),
    ]
    stages = [name for _, name, _ in fixed.FUNNEL_STAGES]
    per_run = scored.groupBy("source", "run_date").agg(
        *[count_where(c).alias(n) for n, c in zip(stages[1:], conditions)]
    )
    manifest = runs.select(F.col("source_name").alias("source"), "run_date", F.col("rows_read"))
    known = per_run.join(manifest, ["source", "run_date"], "left")
    read = F.sum(F.coalesce("rows_read", "distinct_postings")).cast("bigint").alias("rows_read")
    others = [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in stages[1:]]
    return known.agg(read, *others)


def pipeline_funnel(scored: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows left after each stage. The unit changes from posting-run to posting on the way."""
    stages = [
        F.struct(
            F.lit(order).alias("stage_order"), F.lit(stage).alias("stage"), F.lit(grain).alias("grain"),
            F.col(stage).alias("records"),
        )
        for order, stage, grain in fixed.FUNNEL_STAGES
    ]
    rows = _stage_counts(scored, runs).select(F.inline(F.array(*stages)))
    # Eight rows, so one window task is fine.
    order = Window.orderBy("stage_order")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, grain_before = F.lag("records").over(order), F.lag("grain").over(order)
    return rows.select(
        "stage_order",
        "stage",
        "grain",
        "records",
        share(F.col("records"), before).alias("pct_of_previous"),
        share(F.col("records"), F.first("records").over(everything)).alias("pct_of_first"),
        (before - F.col("records")).alias("dropped"),
        F.coalesce(grain_before != F.col("grain"), F.lit(False)).alias("grain_changes_here"),
    ).orderBy("stage_order")
