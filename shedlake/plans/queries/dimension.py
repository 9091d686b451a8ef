"""Dimension maintenance: members, unseen members, bootstrap and second run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shedlake.operators.dimension import maintain_dimension, members, new_members
from shedlake.plans.lakehouse import Lake
from shedlake.plans.oracle import feeds
from shedlake.plans.queries.inputs import (
    RUN_TIME,
    SECOND_RUN_TIME,
    before,
    feed_of,
    run_time,
    wall_clock,
)
from shedlake.plans.registry import query
from shedlake.session import scratch_dir
from shedlake.sources.derived import FEED_BUILDERS, load

OPENING = "2024-01-01 00:10:00"
DIM_FEEDS = ("camera", "environmental")


def dim_feeds(spark, sf_dir):
    return [feed_of(spark, sf_dir, f) for f in DIM_FEEDS]


def opening_feeds(spark, sf_dir):
    """What the feeds held ten minutes after the start, when few farms had reported."""
    events = before(load(spark, sf_dir, "events"), OPENING)
    return [FEED_BUILDERS[f](events) for f in DIM_FEEDS]


FARMS = "SELECT FARM_NO FROM camera UNION SELECT FARM_NO FROM environmental"
KNOWN_FARMS = (
    f"SELECT FARM_NO FROM camera WHERE ts < TIMESTAMP '{OPENING}' "
    f"UNION SELECT FARM_NO FROM environmental WHERE ts < TIMESTAMP '{OPENING}'"
)
FARM_ID = "md5('farm|' || CAST(FARM_NO AS VARCHAR)) AS ID"


@query(feeds(FARMS))
def dim_farm_members(spark, sf_dir):
    return members(dim_feeds(spark, sf_dir))


@query(feeds("SELECT DISTINCT FARM_NO FROM camera UNION ALL SELECT DISTINCT FARM_NO FROM environmental"))
def dim_farm_union(spark, sf_dir):
    """Farm lists of both feeds, one after the other, repeats included."""
    return reduce(DataFrame.unionByName, (members([f]) for f in dim_feeds(spark, sf_dir)))


@query(feeds(f"({FARMS}) EXCEPT ({KNOWN_FARMS})"))
def dim_farm_new(spark, sf_dir):
    known = members(opening_feeds(spark, sf_dir))
    return new_members(members(dim_feeds(spark, sf_dir)), known)


@query(feeds(f"""SELECT FARM_NO, {FARM_ID},
  CASE WHEN FARM_NO IN ({KNOWN_FARMS}) THEN TIMESTAMP '{RUN_TIME}' ELSE TIMESTAMP '{SECOND_RUN_TIME}' END
    AS _processing_timestamp
FROM ({FARMS})"""))
def dim_farm(spark, sf_dir):
    """Two runs: farms of the first keep their id and time, farms of the second are added."""
    first = maintain_dimension(None, opening_feeds(spark, sf_dir), processing_time=run_time())
    second = maintain_dimension(first, dim_feeds(spark, sf_dir), processing_time=run_time(SECOND_RUN_TIME))
    return wall_clock(second)


@query(feeds(f"SELECT FARM_NO, {FARM_ID}, TIMESTAMP '{RUN_TIME}' AS _processing_timestamp FROM ({FARMS})"))
def dim_farm_bootstrap(spark, sf_dir):
    """The target does not exist yet, so every farm is new; stored, then read back."""
    farms = Lake(scratch_dir(spark, "dimension")).farms
    current = farms.read(spark) if farms.versions(spark) else None
    rows = maintain_dimension(current, dim_feeds(spark, sf_dir), processing_time=run_time())
    farms.append_batch(rows, 0)
    return wall_clock(farms.read(spark))


@query("""
SELECT o_custkey, md5('customer|' || CAST(o_custkey AS VARCHAR)) AS ID
FROM orders GROUP BY o_custkey HAVING min(o_orderdate) >= TIMESTAMP '1996-01-01 00:00:00'""")
def dim_customer_new(spark, sf_dir):
    """The same operators on a large dimension: customers whose first order came after 1995."""
    orders = load(spark, sf_dir, "orders")
    earlier = orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    known = maintain_dimension(None, [earlier], "o_custkey", "customer")
    added = new_members(members([orders], "o_custkey"), known, "o_custkey")
    return maintain_dimension(None, [added], "o_custkey", "customer").select("o_custkey", "ID")
