"""Registered queries over the given tables, each with the SQL that has to give the same rows."""

from jobtide.checks import pipeline, publishing, runs, tables, texts, writes
from jobtide.checks.base import Query

REGISTRIES = [texts.registry, runs.registry, tables.registry, writes.registry, pipeline.registry, publishing.registry]


def queries() -> dict[str, Query]:
    return {name: query for r in REGISTRIES for name, query in r.queries.items()}


def oracles() -> dict[str, str]:
    return {name: sql for r in REGISTRIES for name, sql in r.oracles.items()}
