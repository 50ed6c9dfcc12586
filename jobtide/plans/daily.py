"""The daily build: raw tables in, all models and published tables out, as one new version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.params import LanguageRules, Params, ScopeRules, SourceTags
from jobtide.plans import marts
from jobtide.plans.model_checks import check_build, checks_of, require_clean
from jobtide.plans.places import gazetteer, locate, verdict_table
from jobtide.plans.postings import published_rows, scored_rows
from jobtide.plans.staging import flatten_board, flatten_details, flatten_listings, flatten_runs
from jobtide.sources.texts import TextStore, addressed
from jobtide.sources.versions import VersionedTables


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "listings": flatten_listings(raw["listings"]),
        "details": flatten_details(raw["details"]),
        "board": flatten_board(raw["board"]),
        "runs": flatten_runs(raw["runs"]),
    }


def publish(
    scored: DataFrame, postings: DataFrame, runs: DataFrame, mentioned: DataFrame, params: Params = Params()
) -> dict[str, DataFrame]:
    """The five published tables from models that have been written once."""
    return {
        "mart_skill_frequency": marts.skill_frequency(postings, mentioned, params),
        "mart_language_requirement": marts.language_requirement(postings, params),
        "mart_city_stats": marts.city_stats(postings, params),
        "mart_salary_by_skill": marts.salary_by_skill(postings, mentioned, params),
        "mart_pipeline_funnel": marts.pipeline_funnel(scored, runs),
    }


def daily_build(
    raw: dict[str, DataFrame],
    skills: DataFrame,
    aliases: DataFrame,
    warehouse: str,
    params: Params = Params(),
    grouped: bool = True,
    runs: list[str] | None = None,
    rules: ScopeRules = ScopeRules(),
    language: LanguageRules = LanguageRules(),
    foreign_terms: list[str] = fixed.FOREIGN_TERMS,
    tags: SourceTags = SourceTags(),
) -> dict[str, DataFrame]:
    """Build all models from the raw tables, check them, and publish them as one new version.

    Payloads are parsed run by run: with `runs`, only those run dates are parsed and stored anew, and
    all others stay as the version before has them. Descriptions go to the text store, once each.
    Ranks, places and the published tables depend on all runs and are made whole. A build that
    breaks a rule leaves the last good version in place.
    """
    spark = skills.sparkSession
    draft = VersionedTables(spark, warehouse).draft()
    if not draft.before.tables:
        runs = None

    def wanted(rows: DataFrame) -> DataFrame:
        return rows if runs is None else rows.filter(F.col("run_date").cast("string").isin(runs))

    staged = stage({name: wanted(rows) for name, rows in raw.items()})
    store = TextStore(spark, f"{warehouse}/texts")
    store.add(staged["details"].select("description").unionByName(staged["board"].select("description")))
    texts = store.read()

    def parsed(name: str, rows: DataFrame) -> DataFrame:
        return draft.write_runs(name, rows, "run_date", runs)

    listings = parsed("listings", staged["listings"])
    details = parsed("details", addressed(staged["details"]))
    board = parsed("board", addressed(staged["board"]))
    counted = parsed("runs", staged["runs"])
    places = draft.write("places", gazetteer(listings, aliases, params.min_place_chars, rules.home_country))
    located = locate(board, places, foreign_terms, rules.home_country)
    verdicts = draft.write("verdicts", verdict_table(located))
    scored = draft.write("scored", scored_rows(listings, details, board, located, texts, rules, language, tags, params))
    # Few of the scored rows are published; the tables read those and not the texts of the rest.
    postings = draft.write("published", published_rows(scored, texts))
    mentioned = draft.write("mentions", marts.mentions(postings, skills, params, grouped))
    tables = {name: draft.write(name, df) for name, df in publish(scored, postings, counted, mentioned, params).items()}
    inputs = {name: raw[name] for name in ("listings", "details", "board")}
    checked = {
        **inputs, "skills": skills, "aliases": aliases, "places": places, "verdicts": verdicts,
        "published": postings, "mentions": mentioned, **tables,
    }
    require_clean(check_build(checked, checks_of(rules.home_country)))
    version = draft.publish()
    return {name: version.read(name) for name in tables}
