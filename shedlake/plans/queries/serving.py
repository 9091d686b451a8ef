"""Dashboard reads."""

from __future__ import annotations

import uuid

from shedlake.contracts import DAILY_KEYS
from shedlake.functions.columns import decimals_to_double
from shedlake.operators.serving import chart_series, serve_csv_extract, serve_table
from shedlake.plans.lakehouse import DAILY_SCHEMA
from shedlake.plans.oracle import gold
from shedlake.plans.queries.gold import gold_daily
from shedlake.plans.registry import query
from shedlake.session import scratch_dir

ACTIVITY = ("AVG_BIRD_ACTIVITY", "AVG_SOUND_LEVEL")


@query(gold("SELECT * FROM daily"))
def serve_gold(spark, sf_dir):
    """The gold table, stored and registered under a name, as a page shows it."""
    name = f"gold_activity_daily_{uuid.uuid4().hex[:8]}"
    path = scratch_dir(spark, "serve")
    gold_daily(spark, sf_dir).write.parquet(path)
    spark.read.schema(DAILY_SCHEMA).parquet(path).createOrReplaceTempView(name)
    rows = serve_table(spark, name, DAILY_KEYS)
    spark.catalog.dropTempView(name)
    return rows


@query(gold("SELECT * FROM daily"), name="serve_csv_extract")
def csv_extract_of_gold(spark, sf_dir):
    path = scratch_dir(spark, "extract")
    gold_daily(spark, sf_dir).write.option("header", True).csv(path)
    return serve_csv_extract(spark, path, DAILY_SCHEMA)


@query(
    gold(
        "SELECT FARM_NO, SHED_NO, DAY, "
        + ", ".join(
            f"CAST(AVG_{m} AS DOUBLE) AS AVG_{m}" for m in ("BIRD_ACTIVITY", "SOUND_LEVEL", "TEMPRATURE", "HUMIDITY")
        )
        + " FROM daily"
    ),
    name="decimals_to_double",
)
def gold_as_doubles(spark, sf_dir):
    return decimals_to_double(gold_daily(spark, sf_dir))


def series_sql(x: str) -> str:
    return gold(
        " UNION ALL ".join(
            f"SELECT CAST({x} AS DOUBLE) AS x, '{y}' AS series, CAST({y} AS DOUBLE) AS y FROM daily" for y in ACTIVITY
        )
    )


@query(series_sql("AVG_TEMPRATURE"))
def series_by_temperature(spark, sf_dir):
    return chart_series(gold_daily(spark, sf_dir), "AVG_TEMPRATURE", ACTIVITY)


@query(series_sql("AVG_HUMIDITY"))
def series_by_humidity(spark, sf_dir):
    return chart_series(gold_daily(spark, sf_dir), "AVG_HUMIDITY", ACTIVITY)
