"""Shared-folder tables and size-checked joins."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it has at most this many rows of at most this many bytes in all.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, a temporary one of a local session only.

    A cluster's executors don't share a machine's folder, so there the setting is required.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="strandloom-")
    return _own[app]


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage and outlives any executor."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row of fixed-width columns; strings and nested columns count 64 bytes each."""
    fixed = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    return sum(fixed.get(t, 8 if t in ("bigint", "double", "timestamp", "timestamp_ntz") else 64) for _, t in df.dtypes)


def if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within both bounds, else ``df`` as it is.

    ``df`` should be a written table, since it is counted. Without the hint the join shuffles both
    sides and adaptive execution splits skewed partitions.
    """
    rows = df.limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows and rows * row_bytes(df) <= max_bytes else df
