"""The three feeds as they follow from the ``events`` test table, and landing files made of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shedlake.sources.paths import glob, rename

# Which events feed which sensor, and the first day of the production cycle.
CAMERA_EVENTS = ("click", "view", "purchase")
ENVIRONMENTAL_EVENTS = ("signup", "error")
SYNTHETIC_EVENTS = ("purchase",)
FIRST_DAY = "2024-01-01"
PERIOD_DAYS = 10
FILE_PREFIXES = {
    "camera": "Camera",
    "environmental": "Environmental",
    "synthetic": "Synthetic_Poultry",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _site_and_time(hourly: bool = True) -> list[Column]:
    day = F.date_diff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")) + 1
    return [
        (F.col("user_id") % 4).cast("int").alias("FARM_NO"),
        F.expr("user_id div 4 % 2").cast("int").alias("SHED_NO"),
        day.cast("smallint").alias("DAY"),
        *([F.hour("ts").cast("smallint").alias("HOUR")] if hourly else []),
    ]


def reading_number() -> Column:
    """The number ``k`` of an event, as text. Parsing JSON costs more than all else a feed does to
    an event, so documents of the one common shape are matched instead."""
    common = F.regexp_extract("props", r'^\{"k": (0|[1-9]\d*)\}$', 1)
    return F.when(common != "", common).otherwise(F.get_json_object("props", "$.k"))


def _reading(column: str, types: Sequence[str] | None = None) -> Column:
    source = F.col("value") if column == "value" else reading_number().try_cast("int")
    value = source.try_cast("decimal(6,2)")
    return value if types is None else F.when(F.col("event_type").isin(*types), value)


def camera_feed(events: DataFrame) -> DataFrame:
    k = reading_number().try_cast("int")
    return events.where(F.col("event_type").isin(*CAMERA_EVENTS)).select(
        *_site_and_time(),
        (F.lit(100) - k).try_cast("decimal(6,2)").alias("BRIGHTNESS"),
        _reading("value", ("click", "purchase")).alias("BIRD_ACTIVITY"),
        _reading("k", ("view", "purchase")).alias("SOUND_LEVEL"),
        (k >= 50).alias("CAMERA_OPERATIONAL"),
        "event_id",
    )


def environmental_feed(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*ENVIRONMENTAL_EVENTS)).select(
        *_site_and_time(),
        _reading("value").alias("TEMPRATURE"),
        _reading("k", ("error",)).alias("HUMIDITY"),
        "event_id",
    )


def synthetic_feed(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*SYNTHETIC_EVENTS)).select(
        *_site_and_time(hourly=False), _reading("value").alias("WEIGHT_GM"), "event_id"
    )


FEED_BUILDERS = {"camera": camera_feed, "environmental": environmental_feed, "synthetic": synthetic_feed}
# Headers under which renamed columns appear in landing files.
LANDING_HEADERS = {"TEMPRATURE": "temperature", "HUMIDITY": "humidity", "WEIGHT_GM": "Weight(g)"}


def landing_rows(feed: DataFrame) -> DataFrame:
    """A feed as its landing files show it: file headers, no sequence number."""
    return feed.drop("event_id").withColumnsRenamed(LANDING_HEADERS)


def write_landing_files(rows: DataFrame, folder: str, prefix: str, tag: str = "") -> list[str]:
    """Write rows as CSV files named after their farm, shed and ten-day period, and return the paths.

    The names follow from the rows alone, whatever the session's settings for files and tasks.
    """
    spark = rows.sparkSession
    staging = f"{folder}/_staging_{prefix}{tag}"
    named_by = ["FARM_NO", "SHED_NO", "PERIOD"]
    (
        rows.withColumn("PERIOD", F.expr(f"(DAY - 1) div {PERIOD_DAYS}"))
        .repartition(*named_by)
        .write.partitionBy(*named_by)
        .option("header", True)
        .option("maxRecordsPerFile", 0)
        .csv(staging)
    )
    landed = []
    for part in glob(spark, f"{staging}/FARM_NO=*/SHED_NO=*/PERIOD=*/part-*"):
        farm, shed, period = (p.split("=")[1] for p in part.split("/")[-4:-1])
        landed.append(f"{folder}/{prefix}_Farm_{farm}_Shed_{shed}_Period_{period}{tag}.csv")
        rename(spark, part, landed[-1])
    return landed


def land_feed(events: DataFrame, feed: str, folder: str, tag: str = "") -> list[str]:
    """Land the part of a feed that follows from ``events``."""
    return write_landing_files(landing_rows(FEED_BUILDERS[feed](events)), folder, FILE_PREFIXES[feed], tag)
