"""Shape of the physical plans: shuffles, pruning, and no Python in the data path."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from shedlake.contracts import CAMERA, ENVIRONMENTAL, OPERATIONAL
from shedlake.functions import standardize
from shedlake.operators.scd1 import fold_changes
from shedlake.operators.activity import aggregate_activity, join_activity
from shedlake.plans import queries as _queries  # noqa: F401  (fills the registry)
from shedlake.plans.lakehouse import Lake
from shedlake.plans.registry import QUERIES
from shedlake.sources.paths import glob
from test_streaming import BATCHES, bronze_rows, silver_changes

def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_flagship_shuffles_each_feed_once_and_the_result_once(spark, sf_dir, no_broadcast):
    plan = plan_of(QUERIES["gold_daily"](spark, sf_dir))
    assert exchanges(plan) == 3
    assert "SortAggregate" not in plan
    assert "PushedFilters: [In(event_type" in plan
    assert "CAMERA_OPERATIONAL" not in plan and "BRIGHTNESS" not in plan


def test_joining_stored_deltas_shuffles_no_more_than_folding_them(spark, scratch, no_broadcast):
    lake = Lake(scratch)
    camera, environmental = lake.silver(CAMERA), lake.silver(ENVIRONMENTAL)
    climate = bronze_rows(spark, *BATCHES[0]).select(
        "DAY", "HOUR", F.lit("20").alias("temperature"), F.lit("60").alias("humidity"), *OPERATIONAL
    )
    for number, batch in enumerate(BATCHES):
        camera.merge_batch(silver_changes(spark, *batch), number)
        environmental.merge_batch(standardize(climate, ENVIRONMENTAL), number)
    daily = aggregate_activity(join_activity(environmental.read(spark), camera.read(spark)))
    plan = plan_of(daily)
    assert exchanges(plan) == 3 and plan.count("SortMergeJoin") == 1
    assert daily.count() == 2


def test_a_hot_partition_value_is_written_by_several_tasks(spark, scratch):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        silver = Lake(scratch, partition_by=("FARM_NO",)).silver(CAMERA)
        changes = spark.range(0, 240_000, 1, 8).selectExpr(
            "CAST(CASE WHEN id % 3 > 0 THEN 0 ELSE id % 7 END AS INT) AS FARM_NO", "CAST(id AS INT) AS SHED_NO",
            "CAST(id % 30 AS SMALLINT) AS DAY", "CAST(id % 24 AS SMALLINT) AS HOUR",
            "CAST(id % 100 AS DECIMAL(6,2)) AS BRIGHTNESS", "CAST(id % 90 AS DECIMAL(6,2)) AS BIRD_ACTIVITY",
            "CAST(id % 80 AS DECIMAL(6,2)) AS SOUND_LEVEL", "id % 2 = 0 AS CAMERA_OPERATIONAL",
            "timestamp'2024-01-01 00:00:00' AS _processing_timestamp", "concat('f', id) AS _source_file_name",
        )
        silver.merge_batch(changes, 0)
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = {f: len(glob(spark, f"{silver.deltas}/*/FARM_NO={f}/part-*")) for f in range(7)}
    assert files[0] >= 4 and max(files[f] for f in range(1, 7)) <= 2
    assert silver.read(spark).count() == 240_000


@pytest.mark.parametrize("name", ["snapshot_diff", "snapshot_apply", "snapshot_change_feed"])
def test_comparing_two_folds_adds_no_shuffle(spark, sf_dir, no_broadcast, name):
    assert exchanges(plan_of(QUERIES[name](spark, sf_dir))) == 2


def test_filter_on_a_partition_column_reaches_the_stored_folders(spark, scratch):
    silver = Lake(scratch, partition_by=("FARM_NO",)).silver(CAMERA)
    for number, batch in enumerate(BATCHES):
        silver.merge_batch(silver_changes(spark, *batch), number)
    plan = plan_of(silver.read(spark).where("FARM_NO = 2"))
    assert re.search(r"PartitionFilters: \[[^\]]*FARM_NO[^\]]* = 2", plan)


def test_unused_marks_are_not_read(spark, scratch):
    silver = Lake(scratch).silver(CAMERA)
    for number, batch in enumerate(BATCHES):
        silver.merge_batch(silver_changes(spark, *batch), number)
    plan = plan_of(silver.read(spark).select("FARM_NO", "SHED_NO", "DAY", "HOUR", "SOUND_LEVEL"))
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "__mark_SOUND_LEVEL" in schema and "__mark_BRIGHTNESS" not in schema


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "BatchEvalPython", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


def test_upserts_fold_by_hash_and_state_grows_with_the_columns(spark, scratch):
    silver = Lake(scratch).silver(CAMERA)
    folded = fold_changes(silver_changes(spark, *BATCHES[0]), silver.keys, silver.sequence, silver.values)
    assert "SortAggregate" not in plan_of(folded)
    assert len(leaves(silver.state_schema)) <= len(silver.keys) + 2 * len(silver.values)


def leaves(schema):
    return [x for f in schema.fields for x in (leaves(f.dataType) if hasattr(f.dataType, "fields") else [f.name])]


def test_change_feed_of_many_batches_is_one_pass(spark, scratch):
    silver = Lake(scratch).silver(CAMERA)
    for number in range(8):
        silver.merge_batch(silver_changes(spark, *BATCHES[number % 3]), number)
    plan = plan_of(silver.read_changes(spark))
    assert exchanges(plan) == 1 and plan.count("FileScan parquet") == 1
