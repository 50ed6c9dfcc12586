"""The load step: landed run folders into the raw tables, old runs out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobtide.session import settle, shared_folder
from jobtide.sources import landing
from jobtide.sources.schemas import RAW_TABLES
from jobtide.sources.tables import RawTable, prune, read_table, upsert


def load_runs(
    spark: SparkSession,
    raw: str,
    warehouse: str,
    listing_source: str,
    board_source: str,
    run_date: str | None = None,
    today: str | None = None,
    retain_days: int | None = None,
) -> DataFrame:
    """Upsert the landed runs, or those of one date, and report the runs pruned (table, run_date, rows).

    Loading a run again gives the same tables. Nothing is pruned unless both `today` and
    `retain_days` are given.
    """

    def files(source: str, name: str) -> DataFrame:
        return landing.read_run_files(spark, raw, source, name, run_date)

    # Read once: they are counted for the manifests and collapsed for the tables.
    listings = settle(landing.enveloped_rows(files(listing_source, "page_*.json")))
    board = settle(landing.plain_rows(files(board_source, "page_*.json")))
    details = settle(landing.detail_rows(files(listing_source, "details/*.json")))
    counted = [rows.select("source", "run_date", "source_id") for rows in (listings, board)]
    accounting = landing.run_accounting(counted[0].unionByName(counted[1]))
    loaded = {
        "listings": landing.collapse_written(listings),
        "details": landing.collapse_written(details),
        "board": landing.collapse_written(board),
        "runs": landing.load_manifests(landing.read_manifests(spark, raw, run_date), accounting),
    }
    staging = f"{shared_folder(spark)}/jobtide/{uuid.uuid4().hex}"
    for name, rows in loaded.items():
        table = RawTable.at(warehouse, name)
        columns = [c for c in read_table(spark, table).columns if c != "loaded_at"]
        upsert(table, rows.select(*columns), f"{staging}/{name}")
    limited = today is not None and retain_days is not None
    return prune(spark, [RawTable.at(warehouse, name) for name in RAW_TABLES] if limited else [], today, retain_days)
