"""Session settings. Nothing here is needed to call an operator; plans work on any session."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Runtime settings that fix result semantics or let AQE deal with skewed joins.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "jobtide") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate results go: the cluster's shared folder, or a scratch one on one machine."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return shared
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="jobtide-"))
    return context.getCheckpointDir()


def require_checkpoint_dir(spark: SparkSession) -> None:
    """Make `checkpoint()` usable."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def settle(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write a result that several later steps read, and go on from the written table.

    It cuts the lineage like a checkpoint, survives lost executors, and gives the planner true sizes.
    `compression` is the session's own unless it is named.
    """
    path = f"{shared_folder(df.sparkSession)}/jobtide/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_frame(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A few rows as a local relation, whose size the planner knows."""
    kind = schema if isinstance(schema, T.StructType) else T.DataType.fromDDL(schema)
    named = [dict(zip(kind.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, schema=to_arrow_schema(kind)), schema=kind)
