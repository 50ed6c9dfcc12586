"""A table as one named text file with a header line.

Rows are written by all tasks as usual and the finished parts are then strung together, in order and
as a stream, so neither the driver nor a task ever holds the table. The file appears under its name
at once, when it is whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.tables import canonical_lines
from jobtide.session import shared_folder
from jobtide.sources.tables import _folder, drop_folder, names_in


def _string_together(spark: SparkSession, parts: str, header: str, path: str) -> None:
    system, target = _folder(spark, path)
    aside = target.suffix(f".{uuid.uuid4().hex}")
    system.mkdirs(target.getParent())
    copy = spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out = system.create(aside)
    out.write(bytearray((header + "\n").encode("utf-8")))
    for name in names_in(spark, parts):
        if name.startswith("part-"):
            source, part = _folder(spark, f"{parts}/{name}")
            stream = source.open(part)
            copy(stream, out, 1 << 16, False)
            stream.close()
    out.close()
    if system.exists(target):
        # An earlier export, be it a file or a folder of parts.
        system.delete(target, True)
    system.rename(aside, target)
    drop_folder(spark, parts)


def _parts(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/jobtide/{uuid.uuid4().hex}"


def write_csv_file(df: DataFrame, path: str) -> None:
    """Rows in their order, comma-separated, null as an empty cell."""
    parts = _parts(df.sparkSession)
    df.write.csv(parts)
    _string_together(df.sparkSession, parts, ",".join(df.columns), path)


def write_dump(df: DataFrame, path: str) -> None:
    """The canonical dump: column names, then the sorted lines of `canonical_lines`."""
    parts = _parts(df.sparkSession)
    canonical_lines(df).write.text(parts)
    _string_together(df.sparkSession, parts, "|".join(df.columns), path)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a dump with their place in the file, from 0 for the header."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("place", "line"))
