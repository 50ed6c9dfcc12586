"""What several operators share: words, row batches, chunks of texts and settled tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import settle

__all__ = ["settle", "BLANKS", "read", "native_words", "mix64", "batches_of", "fold_hash", "documents_only", "unused"]

#: The white space that parts words: space and the controls 9 to 13.
BLANKS = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def native_words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def documents_only(docs: DataFrame, *columns: str) -> DataFrame:
    """Just the named columns, so that further columns of any name cannot clash with those added later."""
    return docs.select(*[docs[c] for c in columns])


def unused(docs: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as keep it apart from the columns of `docs`."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def fold_hash(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets))


def batches_of(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of a bounded number of rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def each_row(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names])


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
