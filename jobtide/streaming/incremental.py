"""Landing new page files as they appear, with the batch upsert doing the writing.

The checkpoint remembers which files were read; the upsert keeps a replayed batch harmless, and a row whose file
arrives late does not replace one that was read from a later place. Files in any order give what one batch gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import settle
from jobtide.sources.landing import READ_ORDER, RUN_PATH, collapse_written
from jobtide.sources.tables import RawTable, upsert_latest


def land_new_files(
    spark: SparkSession,
    files: str,
    table: RawTable,
    to_rows: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    staging: str,
) -> None:
    """Read all files not seen before, turn them into rows and upsert them; then stop."""
    documents = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .schema("value string")
        .load(files)
        .select(
            F.regexp_extract("_metadata.file_path", RUN_PATH, 1).alias("source"),
            F.regexp_extract("_metadata.file_path", RUN_PATH, 2).cast("date").alias("run_date"),
            F.col("_metadata.file_path").alias("file"),
            F.col("value").alias("document"),
        )
    )
    columns = [c.split()[0] for c in table.schema.split(", ") if not c.startswith("loaded_at")]

    def write(batch: DataFrame, _: int) -> None:
        rows = collapse_written(settle(to_rows(batch)))
        upsert_latest(table, rows.select(*columns, *READ_ORDER), READ_ORDER, staging)

    query = (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
