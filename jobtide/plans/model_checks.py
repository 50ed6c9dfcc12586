"""The rules every build has to meet. A build with a violated rule must not be published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.operators.quality import (
    AcceptedValues, NonNegative, NotNull, Relationship, Unique, growing_stages, run_checks, tail_mismatch,
)

SOURCES = (fixed.FEDERAL, fixed.BOARD)
STAGES = tuple(stage for _, stage, _ in fixed.FUNNEL_STAGES)
GRAINS = tuple(sorted({grain for _, _, grain in fixed.FUNNEL_STAGES}))


def _key(table: str, column: str) -> list:
    return [NotNull(table, column), Unique(table, (column,))]


def checks_of(home_country: str = fixed.HOME_COUNTRY) -> list:
    return [
        *[NotNull(raw, "source_id") for raw in ("listings", "details", "board")],
        *_key("skills", "skill_key"),
        *[NotNull("skills", c) for c in ("display_name", "category", "pattern")],
        *_key("aliases", "alias"),
        NotNull("aliases", "city"),
        *_key("places", "city_norm"),
        NotNull("places", "city"),
        NotNull("verdicts", "posting_id"),
        Unique("verdicts", ("posting_id", "run_date")),
        AcceptedValues("verdicts", "resolved_country", (home_country, fixed.FOREIGN)),
        *[NotNull("published", c) for c in ("posting_id", "source", "title", "country")],
        AcceptedValues("published", "source", SOURCES),
        AcceptedValues("published", "country", (home_country,)),
        NotNull("mentions", "posting_id"),
        NotNull("mentions", "skill_key"),
        Relationship("mentions", "skill_key", "skills", "skill_key"),
        *_key("mart_skill_frequency", "skill_key"),
        NotNull("mart_skill_frequency", "postings"),
        *_key("mart_salary_by_skill", "skill_key"),
        NotNull("mart_salary_by_skill", "postings_with_salary"),
        *_key("mart_language_requirement", "population"),
        NotNull("mart_language_requirement", "postings"),
        NotNull("mart_pipeline_funnel", "stage_order"),
        *_key("mart_pipeline_funnel", "stage"),
        AcceptedValues("mart_pipeline_funnel", "stage", STAGES),
        NotNull("mart_pipeline_funnel", "grain"),
        AcceptedValues("mart_pipeline_funnel", "grain", GRAINS),
        NotNull("mart_pipeline_funnel", "records"),
        NonNegative("mart_pipeline_funnel", "records"),
        NotNull("mart_pipeline_funnel", "grain_changes_here"),
    ]


CHECKS = checks_of()


def check_build(tables: dict[str, DataFrame], checks: list = CHECKS) -> DataFrame:
    """One row per rule with its number of violations."""
    report = run_checks(tables, checks)
    funnel, frequency = tables["mart_pipeline_funnel"], tables["mart_skill_frequency"]
    for rule, found in (
        ("funnel_is_monotonic", growing_stages(funnel)),
        ("funnel_tail_is_denominator", tail_mismatch(funnel, frequency)),
    ):
        counted = found.agg(F.count("*").alias("violations")).select(
            F.lit(rule).alias("check"), F.lit("mart_pipeline_funnel").alias("table_name"),
            F.lit("records").alias("column_name"), "violations",
        )
        report = report.unionByName(counted)
    return report


def require_clean(report: DataFrame) -> None:
    """Fail on any violation. The report has one row per rule."""
    broken = report.filter("violations > 0").collect()
    if broken:
        lines = [f"{r['check']} on {r['table_name']}.{r['column_name']}: {r['violations']}" for r in broken]
        raise ValueError("build rules violated: " + "; ".join(lines))
