"""Keyed folds: silver tables, full-row folds, ties, and folds spread over batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import CAMERA, ENVIRONMENTAL, PROCESSING_TIME
from shedlake.operators.activity import business_view
from shedlake.operators.scd1 import publish, scd1_fold, scd1_merge
from shedlake.operators.snapshots import change_feed, collapse_change_feed
from shedlake.plans.oracle import HOURLY, feeds, silver
from shedlake.plans.queries.inputs import after, before, feed_of, run_time, silver_of
from shedlake.plans.registry import query
from shedlake.session import scratch_dir
from shedlake.sources.derived import camera_feed, environmental_feed, load
from shedlake.streaming.targets import KeyedTarget


@query(silver("SELECT * FROM silver_camera"))
def silver_camera(spark, sf_dir):
    return silver_of(spark, sf_dir, "camera")


@query(silver("SELECT * FROM silver_environmental"))
def silver_environmental(spark, sf_dir):
    return silver_of(spark, sf_dir, "environmental")


@query(silver("SELECT * FROM silver_synthetic"))
def silver_synthetic(spark, sf_dir):
    return silver_of(spark, sf_dir, "synthetic")


@query(
    feeds(f"""
SELECT FARM_NO, SHED_NO, DAY, HOUR, BRIGHTNESS, BIRD_ACTIVITY, SOUND_LEVEL, CAMERA_OPERATIONAL, event_id
FROM camera QUALIFY row_number() OVER (PARTITION BY {HOURLY} ORDER BY event_id DESC) = 1""")
)
def scd1_latest(spark, sf_dir):
    """Whole last row per key, nulls included."""
    feed = feed_of(spark, sf_dir, "camera")
    return scd1_fold(feed, CAMERA.keys, "event_id", ignore_nulls=False, unique_sequence=True)


LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


@query(f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) = 1""")
def scd1_tiebreak(spark, sf_dir):
    """Order lines arriving several times on one ship date: the rest of the row breaks the tie."""
    return scd1_fold(load(spark, sf_dir, "lineitem"), LINE_KEYS, LINE_ORDER, LINE_ORDER, ignore_nulls=False)


@query(f"""
SELECT o_custkey,
       arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE o_totalprice IS NOT NULL) AS o_totalprice,
       arg_max(finished, (o_orderdate, o_orderkey)) FILTER (WHERE finished IS NOT NULL) AS finished
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS finished FROM orders)
GROUP BY o_custkey""")
def scd1_customer_state(spark, sf_dir):
    """Null-preserving fold of orders per customer: last priority, price, and last finished order."""
    orders = load(spark, sf_dir, "orders").withColumn(
        "finished", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))
    )
    return scd1_fold(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority", "o_totalprice", "finished"]
    )


@query(silver("SELECT * FROM silver_environmental"))
def scd1_merge_out_of_order(spark, sf_dir):
    """The later half of the cycle is merged first, the earlier half afterwards, then both again."""
    events = load(spark, sf_dir, "events")
    halves = [environmental_feed(after(events)), environmental_feed(before(events))]

    def merge(state, changes):
        return scd1_merge(state, changes, ENVIRONMENTAL.keys, "event_id", except_columns=["event_id"])

    return publish(reduce(merge, [*halves, halves[0]], None))


def camera_target(root: str) -> KeyedTarget:
    stored = [f for f in CAMERA.standard_schema().fields if f.name in (*CAMERA.keys, *CAMERA.value_columns)]
    return KeyedTarget(
        name="silver_camera",
        path=root,
        schema=T.StructType(stored),
        keys=CAMERA.keys,
        sequence=("event_id",),
        sequence_types=T.StructType([T.StructField("event_id", T.LongType())]),
    )


@query(silver("SELECT * FROM silver_camera"))
def silver_incremental(spark, sf_dir):
    """Upserts in three batches, newest first, and a replay."""
    events = load(spark, sf_dir, "events")
    target = camera_target(scratch_dir(spark, "silver"))
    target.merge_batch(camera_feed(after(events)), 0)
    target.merge_batch(camera_feed(before(events, "2024-01-08 00:00:00")), 1)
    target.merge_batch(camera_feed(after(before(events), "2024-01-08 00:00:00")), 2)
    target.merge_batch(camera_feed(after(events)), 0)
    return target.read(spark)


@query(silver("SELECT * FROM silver_environmental"))
def silver_business_view(spark, sf_dir):
    """Silver as gold reads it: change columns and the ingest time are gone."""
    silver_rows = silver_of(spark, sf_dir, "environmental").withColumn(PROCESSING_TIME, run_time())
    nothing = silver_rows.where(F.lit(False))
    feed = change_feed(nothing, silver_rows, ENVIRONMENTAL.keys, 0, run_time(), unique=True)
    return business_view(feed)


@query(silver("SELECT * FROM silver_camera"))
def silver_batches_as_changes(spark, sf_dir):
    """The change feed that eight batches of a target leave behind, collapsed to the current state."""
    events = load(spark, sf_dir, "events")
    target = camera_target(scratch_dir(spark, "silver"))
    for number in range(8):
        target.merge_batch(camera_feed(events.where((F.day("ts") - 1 >= 28 - 4 * number) & (F.day("ts") - 1 < 32 - 4 * number))), number)
    return collapse_change_feed(target.read_changes(spark), CAMERA.keys)
