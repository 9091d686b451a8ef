"""The whole lake end to end: landing files through streams to silver, dimension and gold."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shedlake.contracts import CAMERA, ENVIRONMENTAL, FEEDS, SYNTHETIC
from shedlake.plans.lakehouse import Lake, declare_tables, run_all, run_feeds
from shedlake.plans.oracle import landed_gold, landed_silver
from shedlake.plans.queries.inputs import (
    FILES_PER_BATCH,
    RUN_TIME,
    SECOND_RUN_TIME,
    after,
    before,
    landing_folder,
    run_time,
    wall_clock,
)
from shedlake.plans.registry import query
from shedlake.session import scratch_dir
from shedlake.sources.catalog import described
from shedlake.sources.derived import land_feed, load
from shedlake.sources.tables import batch_table


def landing_of(spark, sf_dir, *feeds):
    return {feed: landing_folder(spark, sf_dir) for feed in (feeds or FEEDS)}


def landed_lake(spark, sf_dir, *feeds, **options):
    lake = Lake(scratch_dir(spark, "lake"), **options)
    run_feeds(spark, lake, landing_of(spark, sf_dir, *feeds), FILES_PER_BATCH, processing_time=run_time())
    return lake


def with_time(source: str) -> str:
    return landed_silver(f"SELECT *, TIMESTAMP '{RUN_TIME}' AS _processing_timestamp FROM {source}")


@query(with_time("silver_camera"))
def lake_silver_camera(spark, sf_dir):
    lake = landed_lake(spark, sf_dir, "camera", partition_by=("FARM_NO",))
    return wall_clock(lake.silver(CAMERA).read(spark))


@query(with_time("silver_environmental"))
def lake_silver_environmental(spark, sf_dir):
    return wall_clock(landed_lake(spark, sf_dir, "environmental").silver(ENVIRONMENTAL).read(spark))


@query(with_time("silver_synthetic"))
def lake_silver_synthetic(spark, sf_dir):
    return wall_clock(landed_lake(spark, sf_dir, "synthetic").silver(SYNTHETIC).read(spark))


def finished_lake(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    run_all(spark, lake, landing_of(spark, sf_dir), FILES_PER_BATCH, processing_time=run_time())
    return lake


@query(landed_gold("SELECT * FROM daily"))
def lake_gold_daily(spark, sf_dir):
    return finished_lake(spark, sf_dir).daily.read(spark)


@query(landed_gold("SELECT * FROM daily"), name="lake_gold_two_runs")
def gold_of_two_runs(spark, sf_dir):
    """Gold refreshed by the groups that a second delivery touches, equal to one run over everything."""
    events = load(spark, sf_dir, "events")
    lake, landing = Lake(scratch_dir(spark, "lake")), scratch_dir(spark, "landing")
    folders = {"camera": landing, "environmental": landing}
    for part, tag, moment in ((before(events), "", RUN_TIME), (after(events), "_Late", SECOND_RUN_TIME)):
        for feed in folders:
            land_feed(part, feed, landing, tag)
        run_all(spark, lake, folders, FILES_PER_BATCH, processing_time=run_time(moment))
    return lake.daily.read(spark)


@query(landed_gold("SELECT * FROM hourly"))
def lake_gold_hourly(spark, sf_dir):
    return finished_lake(spark, sf_dir).hourly.read(spark)


def facts(name: str, comment: str, keys: str, quality: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS name, '{comment}' AS comment, '{keys}' AS keys, '{quality}' AS quality, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM {source}"
    )


HOURLY, DAILY = "FARM_NO,SHED_NO,DAY,HOUR", "FARM_NO,SHED_NO,DAY"
FARMS = "(SELECT FARM_NO FROM camera UNION SELECT FARM_NO FROM environmental)"
DESCRIBED = [
    *(facts(f"bronze_{f}", f"{f} readings as landed", "", "bronze", f) for f in FEEDS),
    *(
        facts(f"quarantine_{f}", f"{f} readings without a complete key", "", "quarantine", f"{f} WHERE FARM_NO IS NULL")
        for f in FEEDS
    ),
    *(
        facts(f"silver_{f}", f"{f} readings, current value per key", ",".join(c.keys), "silver", f"silver_{f}")
        for f, c in FEEDS.items()
    ),
    facts("gold_activity_hourly", "hourly climate and activity per shed", HOURLY, "gold", "hourly"),
    facts("gold_activity_daily", "daily mean climate and activity per shed", DAILY, "gold", "daily"),
    facts("dim_farm", "farms seen in any feed", "FARM_NO", "silver", FARMS),
]


@query(landed_gold("\nUNION ALL\n".join(DESCRIBED)))
def target_metadata(spark, sf_dir):
    """Name, comment, keys, quality and size of every table of a finished lake, by name from the catalog."""
    lake = finished_lake(spark, sf_dir)
    database = f"lake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake.root}/{database}'")
    declare_tables(spark, lake, database)
    told = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:  # views of the session are listed with the tables of any database
            continue
        known = described(spark, f"{database}.{table.name}")
        if "quality" in known:  # the stored changes of keyed tables have none of their own
            told.append(
                batch_table(spark, f"{database}.{table.name}")
                .agg(F.count(F.lit(1)).alias("n_rows"))
                .select(*(F.lit(known[k]).alias(k) for k in ("name", "comment", "keys", "quality")), "n_rows")
            )
    return reduce(DataFrame.unionByName, told)
