"""Gold tables: hourly readings of both sensors side by side, and their daily averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shedlake.contracts import DAILY_KEYS, HOURLY_KEYS, PROCESSING_TIME
from shedlake.operators.snapshots import CHANGE_COLUMNS

# The measures of both gold tables, in the column order readers expect.
ACTIVITY_MEASURES = ("BIRD_ACTIVITY", "SOUND_LEVEL")
CLIMATE_MEASURES = ("TEMPRATURE", "HUMIDITY")


def business_view(silver: DataFrame) -> DataFrame:
    """Silver without operational and change columns; names that are absent are ignored."""
    return silver.drop(PROCESSING_TIME, *CHANGE_COLUMNS)


def join_activity(environmental: DataFrame, camera: DataFrame) -> DataFrame:
    """Hours for which both sensors have a row.

    No join hint: after a fold both sides are already partitioned by the join keys, and the
    adaptive planner broadcasts a side only when its measured size allows it.
    """
    climate = environmental.select(*HOURLY_KEYS, *CLIMATE_MEASURES)
    activity = camera.select(*HOURLY_KEYS, *ACTIVITY_MEASURES)
    return climate.join(activity, list(HOURLY_KEYS), "inner").select(
        "DAY", "HOUR", "FARM_NO", "SHED_NO", *ACTIVITY_MEASURES, *CLIMATE_MEASURES
    )


def aggregate_activity(hourly: DataFrame) -> DataFrame:
    """Daily mean of every measure per shed; nulls do not count."""
    measures = (*ACTIVITY_MEASURES, *CLIMATE_MEASURES)
    return hourly.groupBy(*DAILY_KEYS).agg(*(F.avg(m).alias(f"AVG_{m}") for m in measures))
