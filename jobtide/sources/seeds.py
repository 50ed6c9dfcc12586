"""Seeds: small reviewed tables whose columns are all text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide import fixed_values as fixed
from jobtide.session import local_frame

SKILL_COLUMNS = ["skill_key", "display_name", "category", "pattern"]
ALIAS_COLUMNS = ["alias", "city", "note"]


def _text_schema(columns: list[str]) -> str:
    return ", ".join(f"{c} string" for c in columns)


def skills(spark: SparkSession) -> DataFrame:
    return local_frame(spark, fixed.SKILLS, _text_schema(SKILL_COLUMNS))


def city_aliases(spark: SparkSession) -> DataFrame:
    return local_frame(spark, fixed.CITY_ALIASES, _text_schema(ALIAS_COLUMNS))


def read_seed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A seed kept as CSV, read without guessing types."""
    return spark.read.schema(_text_schema(columns)).option("header", True).option("enforceSchema", False).csv(path)
