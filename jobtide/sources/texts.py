"""Texts stored apart from the rows that carry them, once per distinct text, under their digest.

A posting is listed again in every run, mostly with the text of the day before. Rows keep a 32-byte
digest; a text is shuffled and written when it first appears and never again, and joined only to
rows someone wants to read. Two texts with one SHA-256 are not expected to exist.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import settle, shared_folder
from jobtide.sources.tables import exists

TEXT_COLUMNS = "text_key binary, text string"
# A text listed every day lies next to itself in landed rows, farther apart than the default codec looks back.
LANDED = "zstd"


def text_key(text: Column) -> Column:
    """The address of a text; null for no text."""
    return F.unhex(F.sha2(text, 256))


def addressed(rows: DataFrame, text: str = "description") -> DataFrame:
    """Rows with the address of their text in place of the text."""
    return rows.withColumn("text_key", text_key(F.col(text))).drop(text)


@dataclass(frozen=True)
class TextStore:
    """Distinct texts in a folder of batches. One writer at a time."""

    spark: SparkSession
    path: str

    @classmethod
    def scratch(cls, spark: SparkSession) -> "TextStore":
        return cls(spark, f"{shared_folder(spark)}/jobtide/{uuid.uuid4().hex}/texts")

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], TEXT_COLUMNS)
        return self.spark.read.schema(TEXT_COLUMNS).parquet(self.path)

    def add(self, texts: DataFrame, text: str = "description") -> None:
        """Write the texts the store does not hold yet. Repeating it changes nothing.

        Keys of known texts are read without the texts, and only unknown texts are shuffled.
        """
        new = texts.select(text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
        if exists(self.spark, self.path):
            new = settle(new.join(self.read().select("text_key"), "text_key", "left_anti"))
            if new.isEmpty():
                return
        distinct = new.dropDuplicates(["text_key"])
        distinct.write.mode("append").option("compression", LANDED).parquet(self.path)


def with_texts(rows: DataFrame, texts: DataFrame, name: str = "description") -> DataFrame:
    """Rows with their texts; `texts` is the store as read."""
    found = texts.withColumnsRenamed({"text_key": "__text_key", "text": name})
    return rows.join(found, F.col("text_key") == F.col("__text_key"), "left").drop("__text_key")
