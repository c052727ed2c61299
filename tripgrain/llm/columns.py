"""Small helpers shared by the operators: result columns, sample tables, bounded broadcasts."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts are long, so the batches in which workers get them are kept to so many rows.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

# A broadcast is refused above this size; what may grow with the data is never broadcast.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def prepare_workers(spark: SparkSession) -> None:
    """What Python workers need: this package on their path, and batches of bounded size.

    Where the package is not installed, workers on the same machine find it where the driver did.
    A worker holds a few batches at once beside what it remembers, so the session's Arrow batches
    are lowered to `BATCH_ROWS` rows if they are larger.
    """
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """Add result columns; an input column of the same name, in any case, gives way to them."""
    prepare_workers(df.sparkSession)
    taken = {name.lower() for name in results}
    kept = [f"`{name}`" for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in results.items()])


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until the input has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def whole_text(name: str) -> Column:
    """A text column with NULL read as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_broadcast(spark: SparkSession, payload: bytes):
    """Broadcast bytes after a check of their number."""
    prepare_workers(spark)
    if len(payload) > MAX_BROADCAST_BYTES:
        raise ValueError(f"{len(payload)} bytes are too many to broadcast")
    return spark.sparkContext.broadcast(payload)
