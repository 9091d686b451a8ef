"""Scans of stored tables, as a batch, as a stream, and as a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import PROCESSING_TIME
from shedlake.operators.serving import TABLE_NAME
from shedlake.operators.snapshots import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION

BATCH_ID = "batch_id"


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Make a Parquet folder readable by name through the session catalog."""
    if not TABLE_NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def batch_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def bronze_change_feed(bronze: DataFrame) -> DataFrame:
    """Bronze rows, batch or stream, as a change feed.

    Bronze only ever grows, so every row is an insert; its version is the batch that wrote it.
    """
    return bronze.select(
        *(c for c in bronze.columns if c != BATCH_ID),
        F.lit("insert").alias(CHANGE_TYPE),
        F.col(BATCH_ID).alias(COMMIT_VERSION),
        F.col(PROCESSING_TIME).alias(COMMIT_TIMESTAMP),
    )
