"""Raw tables as they stand after being written: upsert, replacement of a run, pruning."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.checks.base import Registry, table
from jobtide.operators.ranking import last_wins
from jobtide.session import shared_folder
from jobtide.sources.tables import RawTable, prune, read_table, replace_run, upsert, upsert_latest

registry = Registry()
DAY = "cast(ts as date)"


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/jobtide/{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("run_date", F.col("ts").cast("date"))


@registry.add("upsert_written", f"""
select user_id, {DAY} as run_date, event_id from events
qualify row_number() over (partition by user_id, {DAY} order by event_type = 'signup' desc, event_id desc) = 1""")
def upsert_written(spark, sf):
    """Two batches in turn; the second one takes over the keys both have."""
    keys, folder = ["user_id", "run_date"], _new_folder(spark)
    users = RawTable(f"{folder}/users", "user_id bigint, event_id bigint, loaded_at timestamp, run_date date", keys, ["run_date"])
    events = _events(spark, sf).select(*keys, "event_id", "event_type")
    for batch in ("event_type <> 'signup'", "event_type = 'signup'"):
        rows = last_wins(events.filter(batch), keys, ["event_id"]).select(*keys, "event_id")
        upsert(users, rows, f"{folder}/staging")
    return read_table(spark, users).select(*keys, "event_id")


@registry.add("upsert_out_of_order", f"""
select user_id, {DAY} as run_date, event_id, event_type from events
qualify row_number() over (partition by user_id, {DAY} order by event_id desc) = 1""")
def upsert_out_of_order(spark, sf):
    """Batches by kind of event, each with earlier and later rows of the keys there are; the last event of a day stays."""
    keys, folder = ["user_id", "run_date"], _new_folder(spark)
    schema = "user_id bigint, event_id bigint, event_type string, loaded_at timestamp, run_date date"
    users = RawTable(f"{folder}/users", schema, keys, ["run_date"])
    events = _events(spark, sf).select(*keys, "event_id", "event_type", F.col("event_id").alias("place"))
    for batch in ("event_type = 'signup'", "event_type = 'purchase'", "event_type not in ('signup', 'purchase') or event_type is null"):
        upsert_latest(users, last_wins(events.filter(batch), keys, ["place"]), ["place"], f"{folder}/staging")
    return read_table(spark, users).select(*keys, "event_id", "event_type")


def _written_events(spark: SparkSession, rows: DataFrame) -> RawTable:
    """Events as a raw table of their own."""
    folder = _new_folder(spark)
    written = RawTable(f"{folder}/events", "event_id bigint, event_type string, loaded_at timestamp, run_date date", ["event_id"], ["run_date"])
    upsert(written, rows, f"{folder}/staging")
    return written


@registry.add("replace_run_events", f"""
select event_id, {DAY} as run_date, event_type from events
where {DAY} not in (date '2024-01-05', date '2024-01-06') or ({DAY} = date '2024-01-05' and event_type = 'click')""")
def replace_run_events(spark, sf):
    """One run replaced by some of its rows, the next one by none."""
    events = _events(spark, sf).select("event_id", "run_date", "event_type")
    written = _written_events(spark, events)
    replace_run(written, events.filter("event_type = 'click'"), run_date="2024-01-05")
    replace_run(written, events.filter("event_type is null"), run_date="2024-01-06")
    return read_table(spark, written).select("event_id", "run_date", "event_type")


@registry.add("prune_written", f"""
select case when {DAY} < date '2024-02-10' - 30 then 'pruned' else 'kept' end as fate, {DAY} as run_date, count(*) as rows
from events group by all""")
def prune_written(spark, sf):
    """Runs reported as pruned, and those still in the table."""
    written = _written_events(spark, _events(spark, sf).select("event_id", "run_date", "event_type"))
    gone = prune(spark, [written], "2024-02-10", 30).select(F.lit("pruned").alias("fate"), "run_date", "rows")
    left = read_table(spark, written).groupBy("run_date").agg(F.count("*").alias("rows"))
    return gone.unionByName(left.withColumn("fate", F.lit("kept")))
