"""The one-day sample against results worked out by hand."""

import pytest
from sample_runs import one_day

from conftest import rows
from jobtide.operators.quality import growing_stages, tail_mismatch
from jobtide.params import Params
from jobtide.plans import marts
from jobtide.plans.postings import published, published_postings
from jobtide.sources import seeds


@pytest.fixture(scope="module")
def models(spark):
    built = one_day(spark)
    built["scored"] = built["scored"].cache()
    built["published"] = published(built["scored"])
    built["mentions"] = marts.mentions(built["published"], seeds.skills(spark))
    return built


def test_staging_types_and_blanks(models):
    flat = {r["posting_id"]: r for r in models["listings"].collect()}
    assert flat["ag1"]["location_count"] == 2 and flat["ag5"]["location_count"] == 0
    assert flat["ag1"]["is_full_time"] is True and flat["ag1"]["city"] == "Berlin"
    assert flat["ag2"]["salary_from"] is None and flat["ag2"]["changed_at"] is None
    assert flat["ag5"]["country"] is None
    assert dict(models["listings"].dtypes)["salary_from"] == "decimal(12,2)"
    assert dict(models["listings"].dtypes)["changed_at"] == "timestamp_ntz"
    assert {str(r["published_at"]) for r in models["board"].collect()} == {"2026-09-09"}


def test_gazetteer(models):
    found = {r["city_norm"]: (r["city"], r["region"]) for r in models["places"].collect()}
    assert len(found) == 16
    assert found["munchen"] == ("München", "Bayern")
    assert found["muenchen"] == ("Muenchen", "Bayern")
    assert found["munich"] == ("München", "Bayern")
    assert found["cologne"] == ("Köln", "NRW")
    assert found["nuremberg"] == ("Nürnberg", None)


def test_locations(models):
    found = {
        r["posting_id"]: (r["resolved_country"], r["resolved_city"], r["resolved_region"])
        for r in models["verdicts"].collect()
    }
    assert found == {
        "an1": ("DEUTSCHLAND", "Berlin", "Berlin"),
        "an2": ("FOREIGN", None, None),
        "an3": (None, None, None),
        "an4": ("DEUTSCHLAND", "Berlin", "Berlin"),
        "an5": ("DEUTSCHLAND", "München", "Bayern"),
        "an6": ("DEUTSCHLAND", None, None),
        "an7": ("DEUTSCHLAND", None, None),
        "an8": (None, None, None),
    }


def test_scored_keeps_every_row(models):
    assert models["scored"].count() == 19
    assert len(models["scored"].columns) == 25
    scope = {r["posting_id"]: r["title_in_scope"] for r in models["scored"].collect()}
    assert [k for k, v in sorted(scope.items()) if not v] == ["ag10", "ag3", "ag6", "ag7", "ag8", "ag9"]


def test_published(spark, models):
    kept = sorted(r["posting_id"] for r in models["published"].collect())
    assert kept == ["ag1", "ag11", "ag2", "an1", "an5", "an6", "an7"]
    direct = published_postings(models["listings"], models["details"], models["board"], models["located"])
    assert rows(direct, "posting_id") == rows(models["published"], "posting_id")
    assert len(direct.columns) == 18


def test_oversized_groups_give_the_same_ranks(spark, models):
    spread = one_day(spark, params=Params(hot_rows=1))["scored"]
    assert rows(spread, "posting_id") == rows(models["scored"], "posting_id")


def test_mentions_and_frequency(spark, models):
    assert models["mentions"].count() == 63
    table = marts.skill_frequency(models["published"], models["mentions"]).collect()
    counts = {r["skill_key"]: (r["postings"], r["postings_with_text"], r["pct_of_postings"]) for r in table}
    expected = {k: (7, 7, 100.0) for k in ("airflow", "dbt", "sql")}
    expected |= {k: (6, 7, 85.7) for k in ("aws", "etl", "gcp", "powerbi", "snowflake", "tableau")}
    expected |= {k: (1, 7, 14.3) for k in ("azure", "kafka", "postgres", "python", "spark", "warehouse")}
    assert counts == expected
    assert [r["skill_key"] for r in table[:4]] == ["airflow", "dbt", "sql", "aws"]
    loose = marts.mentions(models["published"], seeds.skills(spark), grouped=False)
    assert rows(loose) == rows(models["mentions"])


def test_funnel(models):
    table = marts.pipeline_funnel(models["scored"], models["runs"])
    assert [tuple(r) for r in table.collect()] == [
        (1, "rows_read", "posting-run", 21, None, 100.0, None, False),
        (2, "distinct_postings", "posting-run", 19, 90.5, 90.5, 2, False),
        (3, "title_in_scope", "posting-run", 13, 68.4, 61.9, 6, False),
        (4, "in_germany", "posting-run", 8, 61.5, 38.1, 5, False),
        (5, "latest_snapshot", "posting", 8, 100.0, 38.1, 0, True),
        (6, "still_advertised", "posting", 8, 100.0, 38.1, 0, False),
        (7, "deduplicated", "posting", 7, 87.5, 33.3, 1, False),
        (8, "with_description", "posting", 7, 100.0, 33.3, 0, False),
    ]
    assert growing_stages(table).isEmpty()
    frequency = marts.skill_frequency(models["published"], models["mentions"])
    assert tail_mismatch(table, frequency).isEmpty()


def test_language_salary_cities(models):
    table = marts.language_requirement(models["published"]).collect()
    assert [tuple(r) for r in table] == [("ALL", 7, 1, 7, 6, 14.3, 85.7)]
    assert marts.salary_by_skill(models["published"], models["mentions"]).isEmpty()
    assert [tuple(r) for r in marts.city_stats(models["published"]).collect()] == [
        ("Berlin", "Berlin", 2, 2, 1, 55000),
        ("München", "Bayern", 2, 0, 0, None),
        ("Unknown", None, 2, 2, 0, None),
    ]
