"""Snapshot diffs, snapshot apply, and change feeds between two versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shedlake.contracts import ENVIRONMENTAL
from shedlake.operators.scd1 import scd1_fold
from shedlake.operators.snapshots import change_feed, collapse_change_feed, snapshot_apply, snapshot_diff
from shedlake.plans.oracle import HOURLY, silver, silver_ctes
from shedlake.plans.queries.inputs import MID_CYCLE, RUN_TIME, after, before, fold_feed
from shedlake.plans.registry import query
from shedlake.sources.derived import environmental_feed, load


def committed():
    return F.lit(RUN_TIME).cast("timestamp_ntz")


# Orders as recorded, against orders as their lines show them.

ORDER_VERSIONS = """
WITH old AS (SELECT o_orderkey, o_orderstatus FROM orders),
new AS (
  SELECT l_orderkey AS o_orderkey,
         CASE WHEN bool_and(l_linestatus = 'F') THEN 'F' WHEN bool_and(l_linestatus = 'O') THEN 'O' ELSE 'P' END
           AS o_orderstatus
  FROM lineitem GROUP BY l_orderkey)"""


# Orders and lines that one task groups, sorts and joins. Shuffled keys are small and need many times their
# space in memory, so tasks that follow from shuffled bytes alone would hold too many.
ROWS_PER_TASK = 1_000_000


def order_versions(spark, sf_dir):
    recorded = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    tasks = -(-(recorded.count() + lines.count()) // ROWS_PER_TASK)  # counted by the files' footers
    tasks = max(tasks, spark.sparkContext.defaultParallelism)
    recorded, lines = (side.repartition(tasks, "o_orderkey") for side in (recorded, lines))
    status = F.col("l_linestatus")
    shown = (
        lines.groupBy("o_orderkey")
        .agg(
            F.when(F.bool_and(status == "F"), "F")
            .when(F.bool_and(status == "O"), "O")
            .otherwise("P")
            .alias("o_orderstatus")
        )
    )
    return recorded, shown


@query(f"""{ORDER_VERSIONS}
SELECT o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
       CASE WHEN NOT coalesce(had, false) THEN 'insert' WHEN NOT coalesce(has, false) THEN 'delete'
            WHEN o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus THEN 'unchanged' ELSE 'update' END
         AS _change_type
FROM (SELECT *, true AS had FROM old) o FULL JOIN (SELECT *, true AS has FROM new) n USING (o_orderkey)""")
def snapshot_diff_orders(spark, sf_dir):
    recorded, shown = order_versions(spark, sf_dir)
    return snapshot_diff(recorded, shown, ["o_orderkey"], unique="new")


# What each user did last at each hour of the day, in the first and in the second half of the cycle.

HABIT_KEYS = ["user_id", "at_hour"]
HABIT_VERSIONS = f"""
WITH habits AS (
  SELECT user_id, CAST(hour(ts) AS INTEGER) AS at_hour, event_type, value, event_id,
         ts < TIMESTAMP '{MID_CYCLE}' AS early
  FROM events),
old AS (
  SELECT user_id, at_hour, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
  FROM habits WHERE early GROUP BY user_id, at_hour),
new AS (
  SELECT user_id, at_hour, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
  FROM habits WHERE NOT early GROUP BY user_id, at_hour),
pairs AS (
  SELECT user_id, at_hour, o.event_type AS old_type, n.event_type AS new_type, o.value AS old_value,
         n.value AS new_value, coalesce(had, false) AS had, coalesce(has, false) AS has
  FROM (SELECT *, true AS had FROM old) o FULL JOIN (SELECT *, true AS has FROM new) n USING (user_id, at_hour))"""


def habit_versions(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("at_hour", F.hour("ts"))

    def last(rows):
        return scd1_fold(rows, HABIT_KEYS, "event_id", ["event_type", "value"], unique_sequence=True)

    return last(before(events)), last(after(events))


@query(f"""{HABIT_VERSIONS}
SELECT user_id, at_hour, CASE WHEN has THEN new_type ELSE old_type END AS event_type,
       CASE WHEN has THEN new_value ELSE old_value END AS value,
       CASE WHEN NOT had THEN 'insert' WHEN NOT has THEN 'delete'
            WHEN old_type IS NOT DISTINCT FROM new_type THEN 'unchanged' ELSE 'update' END AS _change_type
FROM pairs""", name="snapshot_diff")
def diff_of_habits(spark, sf_dir):
    """Insert, delete, update and unchanged; only the kind of event makes a row count as changed."""
    old, new = habit_versions(spark, sf_dir)
    return snapshot_diff(old, new, HABIT_KEYS, unique=True, compare=["event_type"])


@query(f"""{HABIT_VERSIONS}
SELECT user_id, at_hour, new_type AS event_type,
       CASE WHEN had AND old_type IS NOT DISTINCT FROM new_type THEN old_value ELSE new_value END AS value
FROM pairs WHERE has""", name="snapshot_apply")
def apply_habits(spark, sf_dir):
    """Keys missing from the snapshot go; rows whose kind of event is the same stay as stored."""
    old, new = habit_versions(spark, sf_dir)
    return snapshot_apply(old, new, HABIT_KEYS, compare=["event_type"])


@query(f"""{HABIT_VERSIONS},
changed AS (
  SELECT * FROM pairs
  WHERE NOT had OR NOT has OR old_type IS DISTINCT FROM new_type OR old_value IS DISTINCT FROM new_value)
SELECT user_id, at_hour, old_type AS event_type, old_value AS value,
       CASE WHEN has THEN 'update_preimage' ELSE 'delete' END AS _change_type,
       CAST(7 AS BIGINT) AS _commit_version, TIMESTAMP '{RUN_TIME}' AS _commit_timestamp
FROM changed WHERE had
UNION ALL
SELECT user_id, at_hour, new_type, new_value, CASE WHEN had THEN 'update_postimage' ELSE 'insert' END,
       CAST(7 AS BIGINT), TIMESTAMP '{RUN_TIME}'
FROM changed WHERE has""")
def snapshot_change_feed(spark, sf_dir):
    old, new = habit_versions(spark, sf_dir)
    return change_feed(old, new, HABIT_KEYS, 7, committed(), unique=True)


# Silver when half of the afternoon readings were still missing, and silver with all of them.

KNOWN = "hour(ts) < 12 OR minute(ts) < 30"


def silver_versions(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    known = events.where((F.hour("ts") < 12) | (F.minute("ts") < 30))
    return (
        fold_feed(environmental_feed(known), ENVIRONMENTAL),
        fold_feed(environmental_feed(events), ENVIRONMENTAL),
    )


@query(f"""WITH {silver_ctes()},
old AS (
  SELECT {HOURLY},
         arg_max(TEMPRATURE, event_id) FILTER (WHERE TEMPRATURE IS NOT NULL) AS TEMPRATURE,
         arg_max(HUMIDITY, event_id) FILTER (WHERE HUMIDITY IS NOT NULL) AS HUMIDITY
  FROM environmental WHERE {KNOWN} GROUP BY {HOURLY}),
pairs AS (
  SELECT {HOURLY}, coalesce(had, false) AS had, o.TEMPRATURE AS old_t, o.HUMIDITY AS old_h,
         n.TEMPRATURE AS new_t, n.HUMIDITY AS new_h
  FROM silver_environmental n LEFT JOIN (SELECT *, true AS had FROM old) o USING ({HOURLY})),
changed AS (
  SELECT * FROM pairs WHERE NOT had OR old_t IS DISTINCT FROM new_t OR old_h IS DISTINCT FROM new_h)
SELECT {HOURLY}, old_t AS TEMPRATURE, old_h AS HUMIDITY, 'update_preimage' AS _change_type,
       CAST(1 AS BIGINT) AS _commit_version, TIMESTAMP '{RUN_TIME}' AS _commit_timestamp
FROM changed WHERE had
UNION ALL
SELECT {HOURLY}, new_t, new_h, CASE WHEN had THEN 'update_postimage' ELSE 'insert' END,
       CAST(1 AS BIGINT), TIMESTAMP '{RUN_TIME}'
FROM changed""")
def silver_change_feed(spark, sf_dir):
    old, new = silver_versions(spark, sf_dir)
    return change_feed(old, new, ENVIRONMENTAL.keys, 1, committed(), unique=True)


@query(silver("SELECT * FROM silver_environmental"), name="collapse_change_feed")
def collapse_silver_feed(spark, sf_dir):
    """The feed of two commits, first load and correction, read back as the current state."""
    old, new = silver_versions(spark, sf_dir)
    loaded = change_feed(old.where(F.lit(False)), old, ENVIRONMENTAL.keys, 0, committed(), unique=True)
    corrected = change_feed(old, new, ENVIRONMENTAL.keys, 1, committed(), unique=True)
    return collapse_change_feed(loaded.unionByName(corrected), ENVIRONMENTAL.keys)


@query(f"{HABIT_VERSIONS}\nSELECT user_id, at_hour, new_type AS event_type, new_value AS value FROM pairs WHERE has")
def collapse_feed_with_deletes(spark, sf_dir):
    old, new = habit_versions(spark, sf_dir)
    loaded = change_feed(old.where(F.lit(False)), old, HABIT_KEYS, 0, committed(), unique=True)
    replaced = change_feed(old, new, HABIT_KEYS, 1, committed(), unique=True)
    return collapse_change_feed(loaded.unionByName(replaced), HABIT_KEYS)
