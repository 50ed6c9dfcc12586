"""Audits read by people: what deduplication merges, what scope drops, what short patterns catch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.text import finds_ignoring_case, in_context
from jobtide.operators.aggregates import count_where, joined_distinct
from jobtide.operators.dictionary import dictionary_match
from jobtide.operators.ranking import join_null_safe, top_per_key
from jobtide.params import any_of
from jobtide.plans.postings import dedup_keys, newest_details

VACANCY = ["employer_key", "title_key"]
NO_CITY = "?"


def audit_scope(scored: DataFrame) -> DataFrame:
    """Rows at the latest-snapshot stage, narrowed to what the audits look at."""
    reached = F.col("title_in_scope") & F.col("country_known") & (F.col("run_rank") == 1)
    return (
        scored.filter(reached)
        .select("posting_id", "source", "run_date", "title", "employer", "city", "country")
        .withColumns(dedup_keys())
    )


def _distinct_cities() -> Column:
    return F.count_distinct(F.lower(F.coalesce("city", F.lit(""))))


def merge_types(scope: DataFrame) -> DataFrame:
    """Vacancy groups by what merging them joins, with the rows it removes."""
    groups = scope.groupBy(*VACANCY).agg(
        F.count("*").alias("members"),
        F.count_distinct("source").alias("sources"),
        F.count_distinct(F.coalesce("city", F.lit(NO_CITY))).alias("cities"),
    )
    kind = (
        F.when(F.col("members") == 1, "unique (not merged)")
        .when(F.col("sources") > 1, "merged ACROSS sources")
        .when(F.col("cities") > 1, "merged within one source, DIFFERENT cities")
        .otherwise("merged within one source, same city")
    )
    return (
        groups.groupBy(kind.alias("merge_type"))
        .agg(
            F.count("*").alias("groups"),
            F.sum("members").alias("rows_involved"),
            (F.sum("members") - F.count("*")).alias("rows_dropped"),
        )
        .orderBy(F.col("rows_dropped").desc(), "merge_type")
    )


def split_whatif(scope: DataFrame) -> DataFrame:
    """What would stop being merged if the city were part of the key."""
    groups = scope.groupBy(*VACANCY).agg(
        F.count("*").alias("members"),
        F.count_distinct("source").alias("sources"),
        _distinct_cities().alias("cities"),
    )
    kind = F.when(F.col("sources") > 1, "across sources - risks double counting").otherwise(
        "within one source - likely real vacancies"
    )
    return (
        groups.filter((F.col("members") > 1) & (F.col("cities") > 1))
        .groupBy(kind.alias("split_type"))
        .agg(
            F.count("*").alias("groups_that_would_split"),
            (F.sum("cities") - F.count("*")).alias("postings_recovered"),
        )
        .orderBy(F.col("postings_recovered").desc(), "split_type")
    )


def _spelled_groups(scope: DataFrame) -> DataFrame:
    """Groups by employer and title as spelled, with row, source and city counts."""
    return scope.groupBy("employer", "title").agg(
        F.count("*").alias("rows"),
        F.count_distinct("source").alias("sources"),
        _distinct_cities().alias("cities"),
    )


def _listed(scope: DataFrame, top: DataFrame, value: Column, separator: str, chars: int, name: str) -> DataFrame:
    """Attach the joined values to a handful of groups; only their rows are looked at."""
    keys = ["employer", "title"]
    members = join_null_safe(scope.withColumn("__value", value), top.select(*keys), keys, "left_semi", small=True)
    texts = joined_distinct(members, keys, "__value", separator, chars, name)
    return join_null_safe(top, texts, keys, "left")


def _shortened(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        F.left("employer", F.lit(30)).alias("employer"), F.left("title", F.lit(34)).alias("title"), *columns
    )


def cross_source_spans(scope: DataFrame, k: int = 20) -> DataFrame:
    """The largest groups that appear on both sources and in several cities."""
    spans = _spelled_groups(scope).filter((F.col("sources") > 1) & (F.col("cities") > 1))
    top = spans.orderBy(F.col("rows").desc(), "employer", "title").limit(k)
    place = F.concat("source", F.lit(":"), F.coalesce("city", F.lit(NO_CITY)))
    listed = _listed(scope, top, place, " | ", 58, "source_and_city")
    return _shortened(listed.orderBy(F.col("rows").desc(), "employer", "title"), "rows", "source_and_city")


def within_source_spans(scope: DataFrame, k: int = 20) -> DataFrame:
    """One employer advertising one title in several places on one source."""
    spans = _spelled_groups(scope).filter((F.col("rows") > 1) & (F.col("sources") == 1) & (F.col("cities") > 1))
    order = [F.col("cities").desc(), F.col("rows").desc(), F.col("employer"), F.col("title")]
    top = spans.orderBy(*order).limit(k)
    listed = _listed(scope, top, F.coalesce("city", F.lit(NO_CITY)), ", ", 48, "city_list")
    return _shortened(listed.orderBy(*order), "rows", "cities", "city_list")


def text_verdict(scope: DataFrame, details: DataFrame) -> DataFrame:
    """Whether groups spanning cities carry one text or several. Only text digests are shuffled."""
    digests = newest_details(details.select("posting_id", "run_date", F.md5("description").alias("digest")))
    groups = (
        scope.join(digests.select("posting_id", "digest"), "posting_id", "left")
        .groupBy(*VACANCY)
        .agg(
            F.count("*").alias("members"),
            _distinct_cities().alias("cities"),
            F.count("digest").alias("with_text"),
            F.count_distinct("digest").alias("texts"),
        )
    )
    verdict = (
        F.when(F.col("with_text") < F.col("members"), "some rows carry no text - undecidable")
        .when(F.col("texts") == 1, "IDENTICAL text - one vacancy, many sites")
        .otherwise("different text - genuinely separate vacancies")
    )
    return (
        groups.filter((F.col("members") > 1) & (F.col("cities") > 1))
        .groupBy(verdict.alias("verdict"))
        .agg(
            F.count("*").alias("groups"),
            (F.sum("cities") - F.count("*")).alias("postings_recovered_if_split"),
        )
        .orderBy(F.col("postings_recovered_if_split").desc(), "verdict")
    )


def dropped_by_source(scored: DataFrame, rescue: str = any_of(fixed.RESCUE_TERMS)) -> DataFrame:
    """Per source what the title rule keeps and drops, and what another vocabulary would rescue."""
    kept = F.col("title_in_scope")
    return (
        scored.filter(F.col("run_rank") == 1)
        .groupBy("source")
        .agg(
            F.count("*").alias("total"),
            count_where(kept).alias("kept"),
            count_where(~kept).alias("dropped"),
            count_where(~kept & finds_ignoring_case(F.col("title"), rescue)).alias("dropped_but_german_data_word"),
        )
    )


def dropped_titles(scored: DataFrame, source: str = fixed.FEDERAL, k: int = 30) -> DataFrame:
    dropped = scored.filter((F.col("source") == source) & ~F.col("title_in_scope"))
    return dropped.select(F.left("title", F.lit(62)).alias("dropped_title")).distinct().orderBy("dropped_title").limit(k)


def surviving_locations(postings: DataFrame, source: str = fixed.BOARD, k: int = 40) -> DataFrame:
    located = postings.filter(F.col("source") == source).groupBy(F.left("city", F.lit(40)).alias("location"))
    counted = located.agg(F.count("*").alias("postings"))
    return counted.orderBy(F.col("postings").desc(), F.col("location").asc_nulls_last()).limit(k)


def pattern_risk(postings: DataFrame, skills: DataFrame, k: int = 15) -> DataFrame:
    """Matches per pattern, shortest patterns first: that is where false positives live."""
    texts = postings.filter(F.col("description").isNotNull()).select("posting_id", "description")
    found = dictionary_match(texts, "description", skills, "skill_key", "pattern")
    return (
        found.groupBy("skill_key", "pattern", F.length("pattern").alias("pattern_len"))
        .agg(F.count_distinct("posting_id").alias("postings"))
        .orderBy("pattern_len", F.col("postings").desc(), "skill_key")
        .limit(k)
    )


def keyword_in_context(
    postings: DataFrame, skills: DataFrame, keys: list[str] = fixed.RISKY_SKILLS, per_key: int = 4
) -> DataFrame:
    """A few matches per tool with the text around them.

    Matches are sampled by id first; texts are fetched for the sample only, which holds at most
    keys * per_key rows.
    """
    chosen = skills.filter(F.col("skill_key").isin(*keys)).select("skill_key", "pattern")
    risky = [(r[0], r[1]) for r in chosen.collect()]
    texts = postings.filter(F.col("description").isNotNull()).select("posting_id", "source", "description")
    matched = dictionary_match(texts, "description", chosen, "skill_key", "pattern").drop("pattern")
    order = [F.col("posting_id").asc(), F.col("source").asc()]
    sampled = top_per_key(matched, ["skill_key"], order, per_key, rank="rn")
    found = texts.join(F.broadcast(sampled), ["posting_id", "source"])
    context = F.lit(None).cast("string")
    for key, pattern in risky:
        context = F.when(F.col("skill_key") == key, in_context(F.col("description"), pattern)).otherwise(context)
    return found.select("skill_key", "rn", context.alias("context")).orderBy("skill_key", "rn").select("skill_key", "context")
