"""Tables published together: readers see all of the last version or all of the next, never a mix.

A version is a small manifest that names, per table, its schema and the folders its rows lie in. A
draft writes new folders beside the published ones and becomes visible in one step, when its
manifest gets the next number; nothing published is ever overwritten. A table kept by runs has a
folder per run, so writing a run again replaces that folder's name in the manifest and leaves all
other runs where they are. A draft that is not published changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.sources.tables import drop_folder, names_in, place_text, read_text

RUN_FOLDER = "__run"


@dataclass(frozen=True)
class Version:
    """One state of all tables. It stays readable until it is vacuumed."""

    spark: SparkSession
    root: str
    number: int
    tables: dict[str, dict]

    def read(self, name: str) -> DataFrame:
        entry = self.tables[name]
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["folders"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in entry["folders"].values()])

    def runs(self, name: str) -> dict[str, str]:
        """The folder of each run of a table kept by runs."""
        return self.tables[name]["folders"] if name in self.tables else {}


class VersionedTables:
    """All versions below a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def numbers(self) -> list[int]:
        names = names_in(self.spark, f"{self.root}/versions")
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def at(self, number: int) -> Version:
        tables = json.loads(read_text(self.spark, f"{self.root}/versions/{number:010d}.json"))
        return Version(self.spark, self.root, number, tables)

    def current(self) -> Version:
        """The last published version; version 0 has no tables."""
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Version(self.spark, self.root, 0, {})

    def draft(self) -> Draft:
        return Draft(self.current())

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the last `keep` versions and the folders only older ones or unpublished drafts name.

        Not to be run while a draft is being written.
        """
        numbers = self.numbers()
        kept = [self.at(n) for n in numbers[-keep:]]
        named = {f.split("/")[1] for v in kept for t in v.tables.values() for f in t["folders"].values()}
        for n in numbers[:-keep]:
            drop_folder(self.spark, f"{self.root}/versions/{n:010d}.json")
        for folder in names_in(self.spark, f"{self.root}/data"):
            if folder not in named:
                drop_folder(self.spark, f"{self.root}/data/{folder}")


class Draft:
    """The next version in the making; tables not written stay as they are in the one before."""

    def __init__(self, before: Version):
        self.before = before
        self.next = Version(before.spark, before.root, before.number + 1, dict(before.tables))

    def _folder(self, name: str) -> str:
        return f"data/{uuid.uuid4().hex}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Replace a table, and go on from what is written."""
        folder = self._folder(name)
        df.write.parquet(f"{self.next.root}/{folder}")
        self.next.tables[name] = {"schema": df.schema.jsonValue(), "folders": {"": folder}}
        return self.next.read(name)

    def write_runs(self, name: str, df: DataFrame, run: str, runs: list[str] | None = None) -> DataFrame:
        """Replace some runs of a table by the rows of `df`, whose column `run` says which run they are of.

        `runs` names the runs to replace, also those that `df` has no rows of; None replaces all.
        """
        folder = self._folder(name)
        keyed = df.withColumn(RUN_FOLDER, F.col(run).cast("string"))
        if runs is not None:
            keyed = keyed.filter(F.col(RUN_FOLDER).isin(runs))
        keyed.hint("rebalance", RUN_FOLDER).write.partitionBy(RUN_FOLDER).parquet(f"{self.next.root}/{folder}")
        left = {} if runs is None else {r: f for r, f in self.before.runs(name).items() if r not in runs}
        names = [n for n in names_in(self.next.spark, f"{self.next.root}/{folder}") if n.startswith(f"{RUN_FOLDER}=")]
        written = {n.removeprefix(f"{RUN_FOLDER}="): f"{folder}/{n}" for n in names}
        self.next.tables[name] = {"schema": df.schema.jsonValue(), "folders": left | written}
        return self.next.read(name)

    def publish(self) -> Version:
        """Make the draft the current version; another draft published since stops it."""
        path = f"{self.next.root}/versions/{self.next.number:010d}.json"
        if not place_text(self.next.spark, path, json.dumps(self.next.tables)):
            raise RuntimeError(f"version {self.next.number} was published by another build")
        return self.next
