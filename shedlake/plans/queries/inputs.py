"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shedlake.contracts import PROCESSING_TIME, FEEDS, FeedContract
from shedlake.operators.scd1 import scd1_fold
from shedlake.session import scratch_dir
from shedlake.sources.derived import FEED_BUILDERS, land_feed, load

# Ingest time of reproducible runs, and the day that splits the cycle in two.
RUN_TIME = "2024-02-01 00:00:00"
SECOND_RUN_TIME = "2024-02-02 00:00:00"
MID_CYCLE = "2024-01-16 00:00:00"

# Landing files per batch in these queries: fewer than a feed has, so that each takes several batches.
FILES_PER_BATCH = 12

_landed: dict[tuple[str, str], str] = {}


def feed_of(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return FEED_BUILDERS[feed](load(spark, sf_dir, "events"))


def before(events: DataFrame, moment: str = MID_CYCLE) -> DataFrame:
    return events.where(F.col("ts") < F.lit(moment).cast("timestamp_ntz"))


def after(events: DataFrame, moment: str = MID_CYCLE) -> DataFrame:
    return events.where(F.col("ts") >= F.lit(moment).cast("timestamp_ntz"))


def fold_feed(feed: DataFrame, contract: FeedContract) -> DataFrame:
    """Silver state of a derived feed, whose events are numbered in order."""
    return scd1_fold(feed, contract.keys, "event_id", contract.value_columns, unique_sequence=True)


def silver_of(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return fold_feed(feed_of(spark, sf_dir, feed), FEEDS[feed])


def run_time(moment: str = RUN_TIME):
    return F.lit(moment).cast("timestamp")


def wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as plain wall-clock times, which read the same whatever the session time zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (columns or (PROCESSING_TIME,))})


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """One folder with the landing files of all three feeds, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        folder = scratch_dir(spark, "landing")
        for feed in FEEDS:
            land_feed(load(spark, sf_dir, "events"), feed, folder)
        _landed[key] = folder
    return _landed[key]
