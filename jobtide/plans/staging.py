"""Raw payloads to typed columns. One parse per payload; no business rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.numbers import MONEY, blank_to_null, epoch_date
from jobtide.sources import schemas


def _parsed(raw: DataFrame, column: str, schema: str) -> DataFrame:
    return raw.withColumn("p", F.from_json(column, schema))


def _as(name: str, kind: str) -> Column:
    return blank_to_null(F.col(name)).cast(kind)


def flatten_listings(raw: DataFrame) -> DataFrame:
    """Federal listings. The first location is kept; the count shows multi-site postings."""
    place = F.get("p.stellenlokationen", F.lit(0))["adresse"]
    return _parsed(raw, "payload", schemas.LISTING_PAYLOAD).select(
        F.col("source_id").alias("posting_id"),
        "run_date",
        "search_term",
        F.col("p.stellenangebotsTitel").alias("title"),
        F.col("p.hauptberuf").alias("occupation"),
        F.col("p.firma").alias("employer"),
        F.col("p.stellenangebotsart").alias("posting_type"),
        F.col("p.vertragsdauer").alias("contract_duration"),
        F.col("p.arbeitszeitVollzeit").cast("boolean").alias("is_full_time"),
        F.col("p.quereinstiegGeeignet").cast("boolean").alias("suits_career_changers"),
        _as("p.gehaltsspanneVon", MONEY).alias("salary_from"),
        _as("p.gehaltsspanneBis", MONEY).alias("salary_to"),
        F.col("p.verguetungsangabe").alias("salary_basis"),
        place["ort"].alias("city"),
        place["plz"].alias("postcode"),
        place["region"].alias("region"),
        place["land"].alias("country"),
        F.coalesce(F.array_size("p.stellenlokationen"), F.lit(0)).alias("location_count"),
        _as("p.datumErsteVeroeffentlichung", "date").alias("published_at"),
        _as("p.aenderungsdatum", "timestamp_ntz").alias("changed_at"),
    )


def flatten_details(raw: DataFrame) -> DataFrame:
    return _parsed(raw, "payload", schemas.DETAIL_PAYLOAD).select(
        F.col("source_id").alias("posting_id"),
        "run_date",
        F.col("p.stellenangebotsBeschreibung").alias("description"),
        F.col("p.homeofficemoeglich").cast("boolean").alias("allows_home_office"),
        F.col("p.istArbeitnehmerUeberlassung").cast("boolean").alias("is_temp_agency"),
        F.col("p.istPrivateArbeitsvermittlung").cast("boolean").alias("is_private_placement"),
        F.col("p.vertragsdauer").alias("contract_duration"),
    )


def flatten_board(raw: DataFrame) -> DataFrame:
    """Board postings under the same names. The source states no country, so none is assumed."""
    return _parsed(raw, "payload", schemas.BOARD_PAYLOAD).select(
        F.col("source_id").alias("posting_id"),
        "run_date",
        F.col("p.title").alias("title"),
        F.col("p.company_name").alias("employer"),
        F.col("p.description").alias("description"),
        F.col("p.location").alias("city"),
        F.col("p.remote").cast("boolean").alias("allows_home_office"),
        F.col("p.url").alias("url"),
        epoch_date(F.col("p.created_at")).alias("published_at"),
    )


def flatten_runs(raw: DataFrame) -> DataFrame:
    return _parsed(raw, "manifest", schemas.MANIFEST).select(
        F.col("source").alias("source_name"),
        "run_date",
        F.col("p.rows_read").cast("int").alias("rows_read"),
        F.col("p.duplicates_collapsed").cast("int").alias("duplicates_collapsed"),
        F.col("p.results_key").alias("results_key"),
    )
