import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import CAMERA, ENVIRONMENTAL, SYNTHETIC
from shedlake.operators.snapshots import collapse_change_feed
from shedlake.plans.lakehouse import MEASURES, Lake, publish_views, run_all, run_dimension, run_feeds, run_gold
from shedlake.sources.tables import BATCH_ID
from shedlake.streaming.flows import append_flow, upsert_flow
from shedlake.streaming.targets import ADVISORY, FILE_BYTES, AppendTarget
from test_landing import HEADER, put

CLIMATE = "DAY,HOUR,temperature,humidity\n"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def lake(scratch):
    return Lake(f"{scratch}/lake")


@pytest.fixture
def landing(scratch):
    folders = {feed: f"{scratch}/{feed}" for feed in ("camera", "environmental", "synthetic")}
    for folder in folders.values():
        os.makedirs(folder)
    return folders


def test_new_files_reach_gold_and_a_correction_replaces_what_it_holds(spark, lake, landing):
    put(landing["camera"], "Camera_Farm_1_Shed_2.csv", HEADER + "1,0,50,10,20,true\n1,1,50,30,40,true\n")
    put(landing["environmental"], "Environmental_Farm_1_Shed_2.csv", CLIMATE + "1,0,20,60\n1,1,22,\n1,2,99,99\n")
    put(landing["synthetic"], "Synthetic_Poultry_Farm_1_Shed_2.csv", "Day,Weight(g)\n1,40.5\n")
    run_all(spark, lake, landing)
    assert rows_of(lake.daily.read(spark)) == [(1, 2, 1, Decimal("20.000000"), Decimal("30.000000"), Decimal("21.000000"), Decimal("60.000000"))]
    farms = rows_of(lake.farms.read(spark))

    put(landing["camera"], "Camera_Farm_1_Shed_2_Correction.csv", HEADER + "1,0,,16,,\n")
    put(landing["environmental"], "Environmental_Farm_3_Shed_1.csv", CLIMATE + "1,0,25,50\n")
    run_all(spark, lake, landing)
    assert rows_of(lake.daily.read(spark))[0][3:] == (
        Decimal("23.000000"), Decimal("30.000000"), Decimal("21.000000"), Decimal("60.000000"),
    )
    report = lake.daily.read_report(spark).where(F.col(BATCH_ID) == 1).select("FARM_NO", "AVG_BIRD_ACTIVITY", "_change_type")
    assert rows_of(report) == [(1, Decimal("23.000000"), "update")]
    now = rows_of(lake.farms.read(spark))
    assert [r[0] for r in now] == [1, 3] and now[0] == farms[0]

    names = publish_views(spark, lake)
    assert spark.table("silver_synthetic").count() == 1 and "gold_activity_daily" in names


def test_rows_without_a_key_are_quarantined_and_kept(spark, lake, landing):
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n1,bad,1,1,1,true\n")
    put(landing["camera"], "Camera_Farm_x.csv", HEADER + "1,0,2,2,2,true\n")
    run_feeds(spark, lake, landing)
    assert lake.bronze(CAMERA).read(spark).count() == 3
    assert lake.silver(CAMERA).read(spark).count() == 1
    broken = lake.quarantine(CAMERA).read(spark)
    assert sorted(r._source_file_name for r in broken.collect()) == ["Camera_Farm_1_Shed_1.csv", "Camera_Farm_x.csv"]


def test_every_file_is_read_once_under_the_rate_limit(spark, lake, landing):
    for i in range(8):
        put(landing["camera"], f"Camera_Farm_{i}_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    put(landing["camera"], "Notes_Farm_1.csv", HEADER + "1,0,1,1,1,true\n")
    for _ in range(2):
        run_feeds(spark, lake, landing)
    rows = lake.bronze(CAMERA).read(spark, with_batch_id=True)
    per_batch = rows.groupBy(BATCH_ID).agg(F.count_distinct("_source_file_name").alias("files"))
    assert rows_of(per_batch) == [(0, 5), (1, 3)]
    assert rows.count() == 8


def test_rewritten_file_of_the_same_name_is_not_read_again(spark, lake, landing):
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, landing)
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,2,2,2,true\n")
    run_feeds(spark, lake, landing)
    assert lake.bronze(CAMERA).read(spark).count() == 1


def test_clean_source_deletes_files_of_earlier_batches(spark, lake, landing):
    for name in ("Camera_Farm_1_Shed_1.csv", "Camera_Farm_1_Shed_2.csv", "Camera_Farm_1_Shed_3.csv"):
        put(landing["camera"], name, HEADER + "1,0,1,1,1,true\n")
        run_feeds(spark, lake, {"camera": landing["camera"]}, clean_source=True)
    assert lake.bronze(CAMERA).read(spark).count() == 3
    assert len(os.listdir(landing["camera"])) < 3


def test_empty_landing_folder_is_fine(spark, lake, landing):
    run_all(spark, lake, landing)
    assert lake.daily.read(spark).count() == 0 and lake.farms.read(spark).count() == 0


def bronze_rows(spark, *rows):
    """(farm, day, hour, activity, sound, minute) as bronze camera rows."""
    return spark.createDataFrame(
        [
            (str(day), str(hour), None, activity, sound, None, f"Camera_Farm_{farm}_Shed_1.csv", minute)
            for farm, day, hour, activity, sound, minute in rows
        ],
        "DAY string, HOUR string, BRIGHTNESS string, BIRD_ACTIVITY string, SOUND_LEVEL string, "
        "CAMERA_OPERATIONAL string, _source_file_name string, minute int",
    ).select(
        "*", F.expr("timestamp_seconds(1700000000 + minute * 60)").alias("_processing_timestamp"),
        F.lit(None).cast("string").alias("_rescued_data"),
    ).drop("minute")


def silver_changes(spark, *rows):
    from shedlake.functions import standardize

    return standardize(bronze_rows(spark, *rows), CAMERA)


BATCHES = [
    [(1, 1, 0, "10", None, 0), (2, 1, 0, "1", "1", 0)],
    [(1, 1, 0, None, "5", 1), (1, 1, 1, "7", "7", 1)],
    [(1, 1, 0, "12", None, 2), (2, 1, 0, None, None, 2)],
]
EXPECTED = [(1, 1, 0, Decimal("12.00"), Decimal("5.00")), (1, 1, 1, Decimal("7.00"), Decimal("7.00")), (2, 1, 0, Decimal("1.00"), Decimal("1.00"))]
SHOWN = ["FARM_NO", "DAY", "HOUR", "BIRD_ACTIVITY", "SOUND_LEVEL"]


@pytest.mark.parametrize("partition_by", [(), ("FARM_NO",)])
def test_keyed_target_folds_replays_and_compacts(spark, scratch, partition_by):
    silver = Lake(scratch, partition_by=partition_by).silver(CAMERA)
    for number, batch in enumerate(BATCHES):
        assert silver.merge_batch(silver_changes(spark, *batch), number)
    assert not silver.merge_batch(silver_changes(spark, *BATCHES[1]), 1)
    assert rows_of(silver.read(spark).select(SHOWN)) == EXPECTED

    assert silver.compact(spark) == 2 and silver.compact(spark) is None
    assert rows_of(silver.read(spark).select(SHOWN)) == EXPECTED
    silver.merge_batch(silver_changes(spark, (1, 1, 1, "8", None, 9), (3, 1, 0, "0", "0", 9)), 3)
    later = rows_of(silver.read(spark).select(SHOWN))
    assert later[1] == (1, 1, 1, Decimal("8.00"), Decimal("7.00")) and len(later) == 4
    assert rows_of(silver.read(spark, as_of=2).select(SHOWN)) == EXPECTED
    assert rows_of(silver.read(spark, as_of=0).select(SHOWN)) == [
        (1, 1, 0, Decimal("10.00"), None), (2, 1, 0, Decimal("1.00"), Decimal("1.00")),
    ]
    assert sorted({r.FARM_NO for r in silver.read_keys(spark, "FARM_NO").collect()}) == [1, 2, 3]

    feed = silver.read_changes(spark)
    assert rows_of(collapse_change_feed(feed, CAMERA.keys)) == rows_of(silver.read(spark))
    second = silver.read_changes(spark, 1, 1).select("HOUR", "_change_type", "_commit_version")
    assert rows_of(second) == [(0, "update_postimage", 1), (0, "update_preimage", 1), (1, "insert", 1)]


def test_changes_by_range_and_by_commit_time(spark, scratch):
    """Times are those of the commits, and survive a copy of the folder."""
    import datetime
    import shutil
    import time

    silver, moments = Lake(f"{scratch}/a").silver(CAMERA), []
    for number, batch in enumerate(BATCHES):
        moments.append(datetime.datetime.now(datetime.UTC))
        time.sleep(0.01)
        silver.merge_batch(silver_changes(spark, *batch), number)
    shutil.copytree(f"{scratch}/a", f"{scratch}/b")
    copy = Lake(f"{scratch}/b").silver(CAMERA)
    for commit in os.listdir(copy.commits):
        os.utime(f"{copy.commits}/{commit}", (1, 1))
    whole = rows_of(silver.read_changes(spark))
    assert rows_of(copy.read_changes(spark)) == whole and len({r[-1] for r in whole}) == 3
    assert rows_of(copy.read_changes_between(spark, moments[1])) == rows_of(silver.read_changes(spark, 1))
    assert rows_of(copy.read_changes_between(spark, moments[1], moments[2])) == rows_of(silver.read_changes(spark, 1, 1))
    later = moments[2] + datetime.timedelta(days=1)
    none = copy.read_changes_between(spark, later)
    assert none.count() == 0 and none.dtypes == silver.read_changes(spark).dtypes
    assert silver.read_changes(spark, 5).count() == 0


def test_reads_of_many_batches_do_not_grow_with_them(spark, scratch):
    bronze = Lake(scratch).bronze(CAMERA)
    for n in range(36):
        bronze_rows(spark, (1, 1, n, "1", "1", n)).write.parquet(f"{bronze.data}/{BATCH_ID}={n}")
        if n != 20:
            bronze._commit(spark, n)
    rows = bronze.read(spark, with_batch_id=True)
    assert sorted(r.batch_id for r in rows.collect()) == [n for n in range(36) if n != 20]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and plan.count("batch_id=") == 0
    assert bronze.read_batches(spark, [3, 20]).count() == 2


def test_batch_that_broke_off_is_written_again(spark, scratch):
    silver = Lake(scratch).silver(CAMERA)
    silver.merge_batch(silver_changes(spark, *BATCHES[0]), 0)
    os.remove(f"{silver.deltas}/{BATCH_ID}=0/_SUCCESS")
    assert silver.read(spark).count() == 0
    assert silver.merge_batch(silver_changes(spark, *BATCHES[0]), 0)
    assert silver.read(spark).count() == 2

    bronze = Lake(scratch).bronze(CAMERA)
    bronze.append_batch(bronze_rows(spark, *BATCHES[0]), 0)
    bronze.append_batch(bronze_rows(spark, *BATCHES[1]), 0)
    assert bronze.read(spark).count() == 2
    os.remove(f"{bronze.commits}/0.commit")
    assert bronze.read(spark).count() == 0
    bronze.append_batch(bronze_rows(spark, *BATCHES[0]), 0)
    assert bronze.read(spark).count() == 2


def test_flow_that_lost_its_checkpoint_progress_repeats_nothing(spark, lake, landing):
    """A crash after the write and before the commit of the batch: the batch is run again."""
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    bronze, silver, quarantine = lake.bronze(CAMERA), lake.silver(CAMERA), lake.quarantine(CAMERA)

    def run():
        append_flow(spark, CAMERA, landing["camera"], bronze).awaitTermination()
        upsert_flow(spark, CAMERA, bronze, silver, quarantine).awaitTermination()

    run()
    before = rows_of(silver.read(spark))
    for target in (bronze, silver):
        for name in ("0", ".0.crc"):
            commit = f"{target.checkpoint}/commits/{name}"
            if os.path.exists(commit):
                os.remove(commit)
    run()
    assert bronze.read(spark).count() == 1 and rows_of(silver.read(spark)) == before


def test_flow_refuses_to_start_on_batches_without_their_checkpoint(spark, lake, landing):
    lake.bronze(CAMERA).append_batch(bronze_rows(spark, *BATCHES[0]), 0)
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    with pytest.raises(ValueError, match="checkpoint"):
        run_feeds(spark, lake, {"camera": landing["camera"]})


def test_gold_report_and_source_columns(spark, scratch, landing):
    lake = Lake(f"{scratch}/lake", keep_source_columns=True)
    put(landing["environmental"], "Environmental_Farm_1_Shed_2.csv", CLIMATE + "1,0,20,60\n")
    put(landing["camera"], "Camera_Farm_1_Shed_2.csv", HEADER + "1,0,50,10,20,true\n")
    run_feeds(spark, lake, landing)
    assert "temperature" in lake.silver(ENVIRONMENTAL).read(spark).columns
    assert run_gold(spark, lake) == 0 and run_gold(spark, lake) == 0
    put(landing["camera"], "Camera_Farm_1_Shed_2_Later.csv", HEADER + "1,0,50,11,20,true\n2,0,50,11,20,true\n")
    run_feeds(spark, lake, landing)
    assert run_gold(spark, lake) == 1
    report = lake.hourly.read_report(spark).select(BATCH_ID, "DAY", "BIRD_ACTIVITY", "_change_type")
    assert rows_of(report) == [(0, 1, Decimal("10.00"), "insert"), (1, 1, Decimal("11.00"), "update")]
    assert run_dimension(spark, lake) == 0
    assert lake.hourly.read(spark).columns == [
        "DAY", "HOUR", "FARM_NO", "SHED_NO", "BIRD_ACTIVITY", "SOUND_LEVEL", "TEMPRATURE", "HUMIDITY",
    ]


def hourly_rows(spark, *rows):
    names = "DAY smallint, HOUR smallint, FARM_NO int, SHED_NO int"
    made = spark.createDataFrame([(d, h, f, 1, v) for d, h, f, v in rows], f"{names}, v int")
    return made.select("DAY", "HOUR", "FARM_NO", "SHED_NO", *(F.col("v").cast("decimal(6,2)").alias(m) for m in MEASURES))


def test_a_read_of_gold_scans_current_rows_only_after_many_refreshes(spark, lake):
    gold = lake.hourly
    for n in range(20):
        gold.refresh(hourly_rows(spark, (n % 3, 0, 1, n), (n % 3, 1, 1, n)), F.col("DAY") == n % 3, n)
    assert sorted((r.DAY, r.HOUR, int(r.HUMIDITY)) for r in gold.read(spark).collect()) == [(0, 0, 18), (0, 1, 18), (1, 0, 19), (1, 1, 19), (2, 0, 17), (2, 1, 17)]
    scanned = gold.read(spark).inputFiles()
    assert sum(spark.read.parquet(f).count() for f in scanned) == 6
    assert gold.read_report(spark).groupBy("_change_type").count().orderBy("_change_type").collect() == [("insert", 6), ("update", 34)]


def test_rows_and_days_that_are_gone_leave_gold(spark, lake):
    gold = lake.hourly
    gold.refresh(hourly_rows(spark, (1, 0, 1, 5), (1, 1, 1, 5), (2, 0, 1, 5), (3, 0, 1, 5)), F.lit(True), 0)
    gold.refresh(hourly_rows(spark, (1, 0, 1, 5)), F.col("DAY").isin(1, 2), 1)
    assert sorted((r.DAY, r.HOUR) for r in gold.read(spark).collect()) == [(1, 0), (3, 0)]
    report = gold.read_report(spark).where(F.col(BATCH_ID) == 1).select("DAY", "HOUR", "_change_type")
    assert rows_of(report) == [(1, 1, "delete"), (2, 0, "delete")]


def test_refresh_that_broke_off_is_finished_from_its_report(spark, lake):
    gold, first = lake.hourly, [(1, 0, 1, 5), (2, 0, 1, 5)]
    gold.refresh(hourly_rows(spark, *first), F.lit(True), 0)
    later = [(1, 0, 1, 6), (2, 1, 1, 6)]
    gold.refresh(hourly_rows(spark, *later), F.lit(True), 1)
    told = rows_of(gold.read_report(spark))
    for day in (1, 2):  # as a crash between the report and the table would leave it
        for file in spark.read.parquet(f"{gold.data}/DAY={day}").inputFiles():
            os.remove(file.removeprefix("file://"))
    gold.refresh(hourly_rows(spark, *later), F.lit(True), 1)
    assert rows_of(gold.read_report(spark)) == told
    assert sorted((r.DAY, r.HOUR, int(r.HUMIDITY)) for r in gold.read(spark).collect()) == [(1, 0, 6), (2, 1, 6)]


def test_second_dimension_run_reads_new_deltas_only(spark, lake, landing, monkeypatch):
    from shedlake.streaming.targets import KeyedTarget

    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, landing)
    assert run_dimension(spark, lake) == 0
    put(landing["camera"], "Camera_Farm_2_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, landing)
    read = []
    monkeypatch.setattr(KeyedTarget, "touched", lambda *args, touched=KeyedTarget.touched: read.append(touched(*args)) or read[-1])
    assert run_dimension(spark, lake) == 1
    assert [f for r in read for f in r.inputFiles() if f"{BATCH_ID}=0" in f] == [] and any(r.inputFiles() for r in read)
    assert sorted(r.FARM_NO for r in lake.farms.read(spark).collect()) == [1, 2]
    assert lake.farms.read_batches(spark, [1]).count() == 1
    assert run_dimension(spark, lake) == 1


def test_many_tiny_tasks_make_files_of_the_stated_size(spark, scratch):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("h", T.StringType())])
    rows = spark.range(0, 400_000, 1, 200).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    files = {}
    for size in (None, 8 << 20, 64 << 20):
        target = AppendTarget(f"t{size}", f"{scratch}/{size}", schema, properties={} if size is None else {FILE_BYTES: str(size)})
        before = spark.conf.get(ADVISORY, None)
        target.append_batch(rows, 0)
        assert spark.conf.get(ADVISORY, None) == before
        assert target.read(spark).count() == 400_000
        files[size] = len(target.read(spark).inputFiles())
    assert files[None] == 200 and files[64 << 20] == 1 and 2 <= files[8 << 20] <= 16


def test_folders_below_the_landing_folder_are_searched(spark, lake, landing):
    put(f"{landing['camera']}/2024/week=1", "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    put(landing["camera"], "Camera_Farm_2_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, {"camera": landing["camera"]})
    assert sorted(r.FARM_NO for r in lake.silver(CAMERA).read(spark).collect()) == [1, 2]


def test_files_with_different_headers_in_one_batch(spark, lake, landing):
    put(landing["synthetic"], "Synthetic_Poultry_Farm_1_Shed_1.csv", "Day,Weight(g)\n1,40\n")
    put(landing["synthetic"], "Synthetic_Poultry_Farm_1_Shed_2.csv", "Weight (g),DAY,Vet\n41,1,x\n")
    run_feeds(spark, lake, {"synthetic": landing["synthetic"]})
    silver = lake.silver(SYNTHETIC).read(spark).drop("_processing_timestamp")
    assert rows_of(silver) == [(1, 1, 1, Decimal("40.00")), (1, 2, 1, Decimal("41.00"))]


def test_files_under_the_known_header_are_read_once(spark, lake, landing, monkeypatch):
    """No first line is looked at once a header is known, and 400 files are one scan."""
    from shedlake.streaming import flows

    put(landing["camera"], "Camera_Farm_0_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, {"camera": landing["camera"]})
    looked, scans = [], []
    monkeypatch.setattr(flows, "header_groups", lambda *args: looked.append(args))
    monkeypatch.setattr(flows, "read_files", lambda *args, read=flows.read_files: scans.append(read(*args)) or scans[-1])
    for n in range(1, 401):
        put(landing["camera"], f"Camera_Farm_{n}_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    put(landing["camera"], "Camera_Farm_401_Shed_1.csv", "")
    run_feeds(spark, lake, {"camera": landing["camera"]}, max_files=1000)
    assert looked == [] and len(scans) == 1
    assert scans[0]._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    assert lake.bronze(CAMERA).read(spark).count() == 401


def test_another_header_among_known_ones(spark, lake, landing):
    """The check fails, first lines are looked at, and the batch is written once and whole."""
    put(landing["synthetic"], "Synthetic_Poultry_Farm_1_Shed_1.csv", "Day,Weight(g)\n1,40\n")
    run_feeds(spark, lake, {"synthetic": landing["synthetic"]})
    for n in range(4):
        put(landing["synthetic"], f"Synthetic_Poultry_Farm_2_Shed_{n}.csv", "Day,Weight(g)\n1,41\n" if n % 2 else "Weight (g),DAY,Vet\n42,1,x\n")
    run_feeds(spark, lake, {"synthetic": landing["synthetic"]})
    put(landing["synthetic"], "Synthetic_Poultry_Farm_3_Shed_1.csv", "Day\n7\n")
    run_feeds(spark, lake, {"synthetic": landing["synthetic"]})
    rows = lake.bronze(SYNTHETIC).read(spark, with_batch_id=True)
    assert rows_of(rows.select(BATCH_ID, "Day", "Weight_g", "_rescued_data")) == sorted(
        [(0, "1", "40", None), (2, "7", None, None)] + 2 * [(1, "1", "41", None), (1, "1", "42", '{"Vet":"x"}')], key=repr
    )


def test_upserts_of_few_files_at_a_time_give_the_same_state(spark, scratch, landing):
    for i in range(6):
        put(landing["camera"], f"Camera_Farm_1_Shed_{i % 2}_{i}.csv", HEADER + f"1,0,{i},{i if i % 3 else ''},1,true\n")
    at_once, in_steps = Lake(f"{scratch}/a"), Lake(f"{scratch}/b")
    moment = F.lit("2024-02-01 00:00:00").cast("timestamp")
    run_feeds(spark, at_once, {"camera": landing["camera"]}, 100, processing_time=moment)
    run_feeds(spark, in_steps, {"camera": landing["camera"]}, 2, processing_time=moment, bronze_batches=1)
    assert len(in_steps.silver(CAMERA).versions(spark)) == 3
    assert in_steps.silver(CAMERA).compact(spark) == 2
    assert rows_of(in_steps.silver(CAMERA).read(spark)) == rows_of(at_once.silver(CAMERA).read(spark))


@pytest.mark.parametrize("partition_by", [(), ("FARM_NO",)])
def test_batch_without_a_single_key(spark, scratch, landing, partition_by):
    lake = Lake(f"{scratch}/lake", partition_by=partition_by)
    put(landing["camera"], "Camera_Farm_x.csv", HEADER + "1,0,2,2,2,true\n")
    run_feeds(spark, lake, {"camera": landing["camera"]})
    assert lake.silver(CAMERA).read(spark).count() == 0
    assert lake.quarantine(CAMERA).read(spark).count() == 1
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER)
    run_feeds(spark, lake, {"camera": landing["camera"]})
    put(landing["camera"], "Camera_Farm_1_Shed_2.csv", HEADER + "1,0,2,2,2,true\n")
    run_feeds(spark, lake, {"camera": landing["camera"]})
    assert lake.silver(CAMERA).read(spark).count() == 1
    assert lake.quarantine(CAMERA).read(spark).count() == 1


def test_flow_that_keeps_running(spark, lake, landing):
    bronze = lake.bronze(CAMERA)
    query = append_flow(spark, CAMERA, landing["camera"], bronze, trigger={"processingTime": "200 milliseconds"})
    try:
        for i in range(2):
            put(landing["camera"], f"Camera_Farm_{i}_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
            query.processAllAvailable()
    finally:
        query.stop()
    assert bronze.read(spark).count() == 2


def test_file_names_with_glob_characters_are_ingested_once_each(spark, lake, landing):
    for name in ("Camera_Farm_1_Shed_[12].csv", "Camera_Farm_1_Shed_1.csv", "Camera_Farm_1_Shed_{1}.csv"):
        put(landing["camera"], name, HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, {"camera": landing["camera"]}, max_files=1)
    names = [r._source_file_name for r in lake.bronze(CAMERA).read(spark).collect()]
    assert len(names) == 3 and len(set(names)) == 3


def test_late_dated_file_is_not_lost(spark, lake, landing):
    """A copy that keeps old modification times lands after a newer file."""
    put(landing["camera"], "Camera_Farm_1_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    run_feeds(spark, lake, {"camera": landing["camera"]})
    late = put(landing["camera"], "Camera_Farm_2_Shed_1.csv", HEADER + "1,0,1,1,1,true\n")
    moment = os.path.getmtime(late) - 10 * 24 * 3600
    os.utime(late, (moment, moment))
    for _ in range(2):
        run_feeds(spark, lake, {"camera": landing["camera"]})
    assert sorted(r.FARM_NO for r in lake.silver(CAMERA).read(spark).collect()) == [1, 2]


def test_half_written_batch_is_not_streamed(spark, lake, landing):
    bronze, silver, quarantine = lake.bronze(CAMERA), lake.silver(CAMERA), lake.quarantine(CAMERA)
    bronze.append_batch(bronze_rows(spark, *BATCHES[0]), 0)
    bronze_rows(spark, *BATCHES[1]).write.parquet(f"{bronze.data}/{BATCH_ID}=1")
    upsert_flow(spark, CAMERA, bronze, silver, quarantine).awaitTermination()
    assert bronze.read(spark).count() == 2 and silver.read(spark).count() == 2
    bronze.append_batch(bronze_rows(spark, *BATCHES[1]), 1)
    upsert_flow(spark, CAMERA, bronze, silver, quarantine).awaitTermination()
    assert bronze.read(spark).count() == 4 and silver.read(spark).count() == 3
