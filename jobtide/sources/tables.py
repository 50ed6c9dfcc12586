"""Raw tables as Parquet folders partitioned by run: upsert, replace, prune.

A run is a partition, so writing a run again replaces exactly that folder. Spark's committer makes
each partition appear whole or not at all, and repeating a step after a failure gives the same
table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.ranking import join_null_safe
from jobtide.session import settle
from jobtide.sources.schemas import RAW_TABLES

PLACES = "_places"


@dataclass(frozen=True)
class RawTable:
    path: str
    schema: str
    keys: list[str]
    partitions: list[str]

    @classmethod
    def at(cls, root: str, name: str) -> "RawTable":
        schema, keys, partitions = RAW_TABLES[name]
        return cls(f"{root}/{name}", schema, keys, partitions)


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path as it knows it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _folder(spark, path)
    return system.exists(folder)


def newest_change(spark: SparkSession, path: str) -> tuple[int, int]:
    """When the newest file or folder right below a path was changed, and how many there are."""
    system, folder = _folder(spark, f"{path}/*")
    changes = [status.getModificationTime() for status in system.globStatus(folder) or []]
    return max(changes, default=0), len(changes)


def drop_folder(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, in order; none if there is no such folder."""
    system, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, file = _folder(spark, path)
    target = _folder(spark, to)[1]
    system.mkdirs(target.getParent())
    system.rename(file, target)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as a manifest."""
    system, file = _folder(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def place_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place as a whole; false if there is one of that name already."""
    system, file = _folder(spark, path)
    aside = file.suffix(f".{uuid.uuid4().hex}")
    stream = system.create(aside)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not system.exists(file) and system.rename(aside, file):
        return True
    system.delete(aside, False)
    return False


def read_table(spark: SparkSession, table: RawTable) -> DataFrame:
    if not exists(spark, table.path):
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(table.path)


def stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("loaded_at", F.current_timestamp())


def merge_rows(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target with rows added; a key present on both sides takes the new row.

    `rows` has one row per key. Only its keys meet the target, so the target's payloads stay where
    they are whenever the keys are few enough to broadcast.
    """
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


def upsert(table: RawTable, rows: DataFrame, staging: str) -> None:
    """Insert rows, one per key, or overwrite those with the same key; only their runs are touched.

    The new rows are written once and read from there. Where the table has other rows in their runs,
    the merged runs go to a staging folder first, because a table cannot be overwritten while the
    same plan reads it. The last step replaces whole partitions. A repeat after an interruption
    starts from the unchanged or the finished table.
    """
    spark = rows.sparkSession
    new = settle(stamped(rows))
    if new.isEmpty():
        return
    touched = new.select(*table.partitions).distinct()
    target = read_table(spark, table).select(*new.columns).filter(_only_runs(touched))
    if target.isEmpty():
        _write_partitions(table, new)
        return
    merged = merge_rows(target, new, table.keys)
    merged.write.mode("overwrite").partitionBy(*table.partitions).parquet(staging)
    _write_partitions(table, spark.read.schema(table.schema).parquet(staging))


def places_of(table: RawTable, rows: DataFrame, read_order: list[str]) -> RawTable:
    """The narrow table beside a raw table that says where each of its rows was read."""
    names = list(dict.fromkeys([*table.keys, *read_order, *table.partitions]))
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in names]
    return RawTable(table.path + PLACES, ", ".join([*fields, "loaded_at timestamp"]), table.keys, table.partitions)


def upsert_latest(table: RawTable, rows: DataFrame, read_order: list[str], staging: str) -> None:
    """Upsert rows, one per key, but for those whose key the table holds from a later place.

    `rows` brings the columns of `read_order` beside the table's own; they are kept in a narrow table of the
    same runs, so batches may arrive in any order and give what one batch of all rows gives. A row from the very
    same place is taken again: rows are written before their places, and a batch repeated after an interruption
    between the two finishes what was begun. Keys that came in by `upsert` have no place and are overwritten.
    """
    spark = rows.sparkSession
    new = settle(rows)
    if new.isEmpty():
        return
    places = places_of(table, new, read_order)
    place = F.struct(*read_order)
    held = read_table(spark, places).filter(_only_runs(new.select(*table.partitions).distinct()))
    held = held.select(*places.keys, place.alias("__held"))
    met = join_null_safe(new, held, table.keys, "left")
    later = settle(met.filter(F.col("__held").isNull() | (place >= F.col("__held"))).select(*new.columns))
    upsert(table, later.drop(*[c for c in read_order if c not in table.keys]), f"{staging}/rows")
    upsert(places, later.select(*dict.fromkeys([*places.keys, *read_order, *table.partitions])), f"{staging}/places")


def _only_runs(runs: DataFrame) -> Column:
    """The partitions of these runs as literals, so that no other folder is read.

    A batch holds one run per source and day it brings.
    """
    conditions = [reduce(and_, [F.col(name).eqNullSafe(F.lit(run[name])) for name in runs.columns]) for run in runs.collect()]
    return reduce(or_, conditions, F.lit(False))


def _write_partitions(table: RawTable, rows: DataFrame) -> None:
    # Few, even files per run, however many tasks the rows come from.
    balanced = rows.hint("rebalance", *table.partitions)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*table.partitions)
        .parquet(table.path)
    )


def replace_run(table: RawTable, rows: DataFrame, **run: str) -> None:
    """Make one run hold exactly these rows, also when there are none; where its rows were read is forgotten."""
    spark = rows.sparkSession
    partition = "/".join(f"{name}={run[name]}" for name in table.partitions)
    drop_folder(spark, f"{table.path}{PLACES}/{partition}")
    for name, value in run.items():
        rows = rows.filter(F.col(name) == F.lit(value).cast(dict(rows.dtypes)[name]))
    if rows.isEmpty():
        # Dynamic overwrite leaves a partition alone when no row arrives for it.
        drop_folder(spark, f"{table.path}/{partition}")
    else:
        _write_partitions(table, stamped(rows))


def expired_runs(df: DataFrame, today: str, retain_days: int) -> DataFrame:
    """Rows per run older than the retention window."""
    cutoff = F.date_sub(F.lit(today).cast("date"), retain_days)
    return df.filter(F.col("run_date") < cutoff).groupBy("run_date").agg(F.count("*").alias("rows"))


def prune(spark: SparkSession, tables: list[RawTable], today: str, retain_days: int) -> DataFrame:
    """Drop expired runs from all tables and report (table, run_date, rows) of what went.

    The list of run dates is short: a table has one per day.
    """
    report = []
    for table in tables:
        expired = expired_runs(read_table(spark, table), today, retain_days)
        for run in expired.orderBy("run_date").collect():
            report.append((table.path, run["run_date"], run["rows"]))
            pattern = "/".join(
                f"run_date={run['run_date']}" if p == "run_date" else f"{p}=*" for p in table.partitions
            )
            for path in (table.path, table.path + PLACES):
                system, folder = _folder(spark, f"{path}/{pattern}")
                for match in system.globStatus(folder) or []:
                    system.delete(match.getPath(), True)
    return spark.createDataFrame(report, "table string, run_date date, rows bigint")
