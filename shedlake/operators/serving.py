"""Reads for dashboards: table pages and chart series."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.functions.columns import decimals_to_double

TABLE_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*){0,2}")


def serve_table(spark: SparkSession, name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """All columns and rows of a named table; the name is checked, never spliced into SQL."""
    if not TABLE_NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    table = spark.table(name)
    return table.orderBy(*order_by) if order_by else table


def serve_csv_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A gold table exported as CSV with a header row, read back with its own types."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def chart_series(df: DataFrame, x: str, ys: Sequence[str], ordered: bool = True) -> DataFrame:
    """Points of a line chart as (x, series, y), one row per series and input row."""
    points = (
        decimals_to_double(df.select(F.col(x).alias("x"), *ys))
        .unpivot(["x"], list(ys), "series", "y")
    )
    return points.orderBy("x", "series", "y") if ordered else points
