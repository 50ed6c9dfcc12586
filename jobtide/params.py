"""Thresholds and rule sets, passed explicitly to every plan that needs them."""

from __future__ import annotations

from dataclasses import dataclass, field

from jobtide import fixed_values as fixed


@dataclass(frozen=True)
class Params:
    freshness_days: int = 7
    description_min_chars: int = 200
    salary_low: int = 20_000
    salary_high: int = 250_000
    min_salaried: int = 3
    min_city_postings: int = 2
    min_source_postings: int = 30
    min_place_chars: int = 4
    retain_days: int = 30
    top_skills: int = 15
    top_cities: int = 12
    # Rows one task may rank on its own; larger groups are split over many tasks.
    hot_rows: int = 2_000_000


def any_of(terms: list[str]) -> str:
    return "(?:" + "|".join(terms) + ")"


@dataclass(frozen=True)
class ScopeRules:
    """Title rule: an include hit, no exclusion, and no employer noise without a role head."""

    include: str = field(default_factory=lambda: any_of(fixed.SCOPE_TERMS))
    exclude: str = field(default_factory=lambda: any_of(fixed.SCOPE_EXCLUSIONS))
    noise: str = fixed.SCOPE_EMPLOYER_NOISE
    head: str = field(
        default_factory=lambda: any_of(fixed.SCOPE_ROLE_PREFIXES)
        + fixed.SCOPE_ROLE_GAP
        + any_of(fixed.SCOPE_ROLE_WORDS)
    )
    home_country: str = fixed.HOME_COUNTRY


@dataclass(frozen=True)
class LanguageRules:
    requires: str = field(default_factory=lambda: any_of(fixed.GERMAN_REQUIRED))
    mentions: str = field(default_factory=lambda: any_of(fixed.ENGLISH_MENTIONED))


@dataclass(frozen=True)
class SourceTags:
    federal: str = fixed.FEDERAL
    board: str = fixed.BOARD
