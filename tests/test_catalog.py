"""Tables by name: what the catalog says of them, and that nothing half written shows."""

import uuid

import pytest

from shedlake.contracts import CAMERA
from shedlake.plans.lakehouse import Lake, declare_tables, run_all
from shedlake.plans.queries.lake import target_metadata
from shedlake.sources.catalog import declare, described
from shedlake.sources.tables import BATCH_ID
from test_landing import HEADER, put
from test_streaming import BATCHES, CLIMATE, bronze_rows, rows_of, silver_changes


@pytest.fixture
def database(spark, scratch):
    name = f"lake_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_by_name_follow_the_runs(spark, scratch, database):
    lake, landing = Lake(f"{scratch}/lake"), {"camera": f"{scratch}/camera", "environmental": f"{scratch}/environmental"}
    for run in range(2):
        put(landing["camera"], f"Camera_Farm_{run}_Shed_1.csv", HEADER + f"{run},0,1,1,1,true\n")
        put(landing["environmental"], f"Environmental_Farm_{run}_Shed_1.csv", CLIMATE + f"{run},0,20,60\n")
        run_all(spark, lake, landing)
        declare_tables(spark, lake, database)
        for target in lake.targets():
            by_name = spark.table(f"{database}.{target.name}").select(*target.schema.names)
            assert rows_of(by_name) == rows_of(target.read(spark)), target.name
        assert spark.table(f"{database}.gold_activity_daily").count() == run + 1
    known = described(spark, f"{database}.silver_camera")
    assert known["comment"] == "camera readings, current value per key" and known["quality"] == "silver"
    assert known["keys"] == "FARM_NO,SHED_NO,DAY,HOUR" and known["name"] == "silver_camera"
    assert described(spark, f"{database}.gold_activity_daily")["quality"] == "gold"


def test_half_written_batches_do_not_show_by_name(spark, scratch, database):
    lake = Lake(scratch)
    bronze = lake.bronze(CAMERA)
    bronze.append_batch(bronze_rows(spark, *BATCHES[0]), 0)
    bronze_rows(spark, *BATCHES[1]).write.parquet(f"{bronze.data}/{BATCH_ID}=1")
    name = declare(spark, bronze, database)
    assert spark.table(name).count() == 2
    bronze.append_batch(bronze_rows(spark, *BATCHES[1]), 1)
    declare(spark, bronze, database)
    assert spark.table(name).count() == 4


@pytest.mark.parametrize("partition_by", [(), ("FARM_NO",)])
def test_keyed_tables_by_name_before_and_after_compaction(spark, scratch, database, partition_by):
    silver = Lake(scratch, partition_by=partition_by).silver(CAMERA)
    for number, batch in enumerate(BATCHES[:2]):
        silver.merge_batch(silver_changes(spark, *batch), number)
    name = declare(spark, silver, database)
    assert rows_of(spark.table(name)) == rows_of(silver.read(spark))
    silver.compact(spark)
    silver.merge_batch(silver_changes(spark, *BATCHES[2]), 2)
    declare(spark, silver, database)
    assert rows_of(spark.table(name)) == rows_of(silver.read(spark)) and spark.table(name).count() == 3


def test_names_are_checked(spark, scratch):
    with pytest.raises(ValueError):
        declare(spark, Lake(scratch).bronze(CAMERA), "a b")


def test_metadata_leaves_out_views_of_the_session(spark, sf_dir):
    """A temporary view is listed with the tables of every database, but is in none."""
    spark.range(1).createOrReplaceTempView("passing_by")
    try:
        assert target_metadata(spark, sf_dir).where("name = 'passing_by'").count() == 0
    finally:
        spark.catalog.dropTempView("passing_by")
