"""Scored postings: every row read, with stage flags and ranks; and the published subset.

The long texts stay out. Rows are flagged and ranked on narrow columns and carry the address of
their description; what is read from a text is read once per distinct text, and the text itself is
joined only to rows that are handed out with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.numbers import MONEY, days_between, is_fresh
from jobtide.functions.text import finds_ignoring_case, has_text
from jobtide.operators.flags import as_group, in_country, in_scope
from jobtide.operators.ranking import By, first_per_key, number_rows, number_small_groups
from jobtide.params import LanguageRules, Params, ScopeRules, SourceTags
from jobtide.session import settle
from jobtide.sources.texts import TextStore, addressed, with_texts

SCORED_COLUMNS = [
    "posting_id", "source", "run_date", "title", "employer", "city", "region", "country",
    "salary_from", "salary_to", "is_full_time", "published_at", "description",
    "allows_home_office", "is_temp_agency", "requires_german", "mentions_english",
    "description_length", "title_in_scope", "country_known", "run_rank", "days_since_latest_run",
    "still_advertised", "dedup_rank", "has_description",
]
PUBLISHED_COLUMNS = SCORED_COLUMNS[:18]
NARROW_COLUMNS = [c for c in SCORED_COLUMNS if c != "description"] + ["text_key"]


def newest_details(details: DataFrame) -> DataFrame:
    """The newest detail ever fetched per posting, whichever run it came from."""
    return first_per_key(details, ["posting_id"], [F.col("run_date").desc()])


def narrow_rows(listings: DataFrame, located: DataFrame, tags: SourceTags, rules: ScopeRules) -> DataFrame:
    """Both sources under one column list, with scope and country flags and without texts."""
    federal = listings.select(
        "posting_id", F.lit(tags.federal).alias("source"), "run_date", "title", "employer", "city",
        "region", "country", "salary_from", "salary_to", "is_full_time", "published_at",
    )
    boarded = located.select(
        "posting_id", F.lit(tags.board).alias("source"), "run_date", "title", "employer",
        F.col("resolved_city").alias("city"),
        F.col("resolved_region").alias("region"),
        F.col("resolved_country").alias("country"),
        F.lit(None).cast(MONEY).alias("salary_from"),
        F.lit(None).cast(MONEY).alias("salary_to"),
        F.lit(None).cast("boolean").alias("is_full_time"),
        "published_at",
    )
    return federal.unionByName(boarded).withColumns(
        {
            "title_in_scope": in_scope(F.col("title"), rules),
            "country_known": in_country(F.col("country"), rules.home_country),
        }
    )


def newest_run(rows: DataFrame) -> Column:
    """The newest run in the data, not today's date, as a one-value subquery."""
    return rows.agg(F.max("run_date")).scalar()


def dedup_keys() -> dict[str, Column]:
    return {
        "employer_key": F.lower(F.coalesce("employer", F.lit(""))),
        "title_key": F.lower("title"),
    }


def dedup_order(tags: SourceTags) -> list[By]:
    """Federal rows first, then the most recently published; the rest only breaks ties."""
    return [
        By(F.when(F.col("source") == tags.federal, 0).otherwise(1)),
        By(F.col("published_at"), down=True, nulls_last=True),
        By(F.col("posting_id")),
        By(F.col("source")),
        By(F.col("run_date"), down=True, nulls_last=True),
    ]


def _read_from(text: Column, language: LanguageRules) -> dict[str, Column]:
    return {
        "requires_german": finds_ignoring_case(text, language.requires),
        "mentions_english": finds_ignoring_case(text, language.mentions),
    }


def _with_texts(
    rows: DataFrame, details: DataFrame, board: DataFrame, language: LanguageRules, tags: SourceTags, params: Params
) -> DataFrame:
    """Federal rows take the posting's newest detail, board rows the text of their own run.

    The sources are joined apart: the newest details already lie by posting id, so their texts are
    shuffled once. What is read from a text is worked out before the join, once per text and not
    once per run that lists it.
    """
    text = F.col("description")
    described = newest_details(details).select(
        "posting_id", "description", "allows_home_office", "is_temp_agency"
    ).withColumns(_read_from(text, language))
    offered = board.select(
        "posting_id", "run_date", "description", "allows_home_office",
        F.lit(None).cast("boolean").alias("is_temp_agency"),
    ).withColumns(_read_from(text, language))
    federal = rows.filter(F.col("source") == tags.federal).join(described, "posting_id", "left")
    boarded = rows.filter(F.col("source") == tags.board).join(offered, ["posting_id", "run_date"], "left")
    return federal.unionByName(boarded).withColumns(
        {
            "description_length": F.length(F.coalesce(text, F.lit(""))),
            "has_description": has_text(text, params.description_min_chars),
        }
    )


def text_facts(texts: DataFrame, language: LanguageRules, params: Params) -> DataFrame:
    """What the rows need to know of each distinct text; `texts` is a text store as read."""
    text = F.col("text")
    return texts.select(
        F.col("text_key").alias("fact_key"),
        *[value.alias(name) for name, value in _read_from(text, language).items()],
        F.length(text).alias("description_length"),
        has_text(text, params.description_min_chars).alias("has_description"),
    )


def _address_texts(rows: DataFrame, details: DataFrame, board: DataFrame, tags: SourceTags) -> DataFrame:
    """Federal rows take the posting's newest detail, board rows the text of their own run."""
    described = newest_details(details).select("posting_id", "text_key", "allows_home_office", "is_temp_agency")
    offered = board.select(
        "posting_id", "run_date", "text_key", "allows_home_office", F.lit(None).cast("boolean").alias("is_temp_agency")
    )
    federal = rows.filter(F.col("source") == tags.federal).join(described, "posting_id", "left")
    return federal.unionByName(
        rows.filter(F.col("source") == tags.board).join(offered, ["posting_id", "run_date"], "left")
    )


def scored_rows(
    listings: DataFrame,
    details: DataFrame,
    board: DataFrame,
    located: DataFrame,
    texts: DataFrame,
    rules: ScopeRules = ScopeRules(),
    language: LanguageRules = LanguageRules(),
    tags: SourceTags = SourceTags(),
    params: Params = Params(),
) -> DataFrame:
    """All rows read with flags and ranks, and with `text_key` for the description.

    `located` is the board with its verdicts. `details` and `board` carry text_key in place of the
    description, and `texts`, a text store as read, holds every text they name. Ranks partition on
    the flag before them, so rows that failed a stage are ranked apart and a rank means nothing
    without its flag.
    """
    rows = narrow_rows(listings, located, tags, rules)
    passed = as_group(F.col("title_in_scope") & F.col("country_known"))
    # A posting has one row per retained run, so these groups stay small.
    ranked = number_small_groups(
        rows.withColumn("passed", passed), ["source", "posting_id", "passed"], [F.col("run_date").desc()], "run_rank"
    )
    # Read twice below, and narrow: no texts.
    ranked = settle(ranked.drop("passed"))
    dated = ranked.withColumn("days_since_latest_run", days_between(newest_run(ranked), F.col("run_date")))
    advertised = (
        F.col("title_in_scope")
        & F.col("country_known")
        & (F.col("run_rank") == 1)
        & (F.col("days_since_latest_run") < params.freshness_days)
    )
    staged = dated.withColumn("still_advertised", advertised)
    keyed = staged.withColumns({**dedup_keys(), "advertised": as_group(F.col("still_advertised"))})
    numbered = number_rows(
        keyed, ["employer_key", "title_key", "advertised"], dedup_order(tags), "dedup_rank", params.hot_rows
    )
    facts = text_facts(texts, language, params)
    known = _address_texts(numbered, details, board, tags).join(facts, F.col("text_key") == F.col("fact_key"), "left")
    return known.withColumns(
        {
            "description_length": F.coalesce("description_length", F.lit(0)),
            "has_description": F.coalesce("has_description", F.lit(False)),
        }
    ).select(*NARROW_COLUMNS)


def scored_postings(
    listings: DataFrame,
    details: DataFrame,
    board: DataFrame,
    located: DataFrame,
    rules: ScopeRules = ScopeRules(),
    language: LanguageRules = LanguageRules(),
    tags: SourceTags = SourceTags(),
    params: Params = Params(),
) -> DataFrame:
    """The scored rows with their descriptions, for those who have no text store: one is written aside."""
    store = TextStore.scratch(listings.sparkSession)
    store.add(details.select("description").unionByName(board.select("description")))
    texts = store.read()
    narrow = scored_rows(listings, addressed(details), addressed(board), located, texts, rules, language, tags, params)
    return with_texts(narrow, texts).select(*SCORED_COLUMNS)


def published_rows(scored: DataFrame, texts: DataFrame) -> DataFrame:
    """The published rows with their descriptions, from narrow scored rows and a text store as read.

    The vacancies are few next to the texts, which are thinned out by their addresses before the join.
    """
    kept = settle(scored.filter(F.col("still_advertised") & (F.col("dedup_rank") == 1)))
    wanted = texts.join(kept.select("text_key").distinct(), "text_key", "left_semi")
    return with_texts(kept, wanted).select(*PUBLISHED_COLUMNS)


def published(scored: DataFrame) -> DataFrame:
    """One row per vacancy: still advertised and first of its employer and title."""
    return scored.filter(F.col("still_advertised") & (F.col("dedup_rank") == 1)).select(*PUBLISHED_COLUMNS)


def published_postings(
    listings: DataFrame,
    details: DataFrame,
    board: DataFrame,
    located: DataFrame,
    rules: ScopeRules = ScopeRules(),
    language: LanguageRules = LanguageRules(),
    tags: SourceTags = SourceTags(),
    params: Params = Params(),
) -> DataFrame:
    """The published rows without ranking the rest.

    Both selections keep one row per key, which Spark applies before each shuffle, so neither a
    posting listed in many runs nor a title advertised by everyone gathers in one task.
    """
    rows = narrow_rows(listings, located, tags, rules)
    passed = rows.filter(F.col("title_in_scope") & F.col("country_known"))
    latest = first_per_key(passed, ["source", "posting_id"], [F.col("run_date").desc()])
    newest = newest_run(listings.select("run_date").unionByName(board.select("run_date")))
    fresh = latest.filter(is_fresh(F.col("run_date"), newest, params.freshness_days))
    # The vacancies are few next to the texts, which are thinned out by their ids before the join.
    kept = settle(first_per_key(fresh.withColumns(dedup_keys()), ["employer_key", "title_key"], [by.sorted for by in dedup_order(tags)]))
    wanted_details = details.join(kept.select("posting_id").distinct(), "posting_id", "left_semi")
    wanted_board = board.join(kept.select("posting_id", "run_date"), ["posting_id", "run_date"], "left_semi")
    return _with_texts(kept, wanted_details, wanted_board, language, tags, params).select(*PUBLISHED_COLUMNS)
