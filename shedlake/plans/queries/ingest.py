"""Ingest of landing files: batch reads, streams, rate limit, clean-up, schema discovery."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from shedlake.contracts import CAMERA, ENVIRONMENTAL, PROCESSING_TIME, SOURCE_FILE, SYNTHETIC
from shedlake.functions.columns import stamp_operational, standardize
from shedlake.functions.rescue import CORRUPT
from shedlake.plans.lakehouse import Lake
from shedlake.plans.oracle import feeds
from shedlake.plans.queries.inputs import (
    MID_CYCLE,
    FILES_PER_BATCH,
    RUN_TIME,
    after,
    before,
    landing_folder,
    run_time,
    wall_clock,
)
from shedlake.plans.registry import query
from shedlake.session import scratch_dir
from shedlake.sources.derived import (
    FILE_PREFIXES,
    camera_feed,
    land_feed,
    landing_rows,
    load,
    synthetic_feed,
    write_landing_files,
)
from shedlake.sources.landing import header_groups, infer_feed_schema, read_csv_group, read_files
from shedlake.sources.paths import glob, modified_at, set_modified
from shedlake.sources.tables import BATCH_ID, batch_table, bronze_change_feed, register_table, stream_table
from shedlake.streaming.flows import ONCE, append_flow
from shedlake.streaming.targets import AppendTarget

TEN_DAYS = 10 * 24 * 3600 * 1000


def landed_files(spark, sf_dir, contract):
    return glob(spark, f"{landing_folder(spark, sf_dir)}/{contract.glob}")


def ingest(spark, contract, landing, bronze, **options):
    append_flow(spark, contract, landing, bronze, processing_time=run_time(), **options).awaitTermination()


def fresh_bronze(spark, contract):
    return Lake(scratch_dir(spark, "lake")).bronze(contract)


def camera_bronze(spark, sf_dir):
    """All camera landing files, appended by a stream in several batches."""
    bronze = fresh_bronze(spark, CAMERA)
    ingest(spark, CAMERA, landing_folder(spark, sf_dir), bronze, max_files=FILES_PER_BATCH)
    return bronze


def file_name(prefix: str, suffix: str = "") -> str:
    return f"'{prefix}_Farm_' || FARM_NO || '_Shed_' || SHED_NO || '_Period_' || ((DAY - 1) // 10) || '{suffix}.csv'"


CAMERA_TEXT = """CAST(DAY AS VARCHAR) AS DAY, CAST(HOUR AS VARCHAR) AS HOUR, CAST(BRIGHTNESS AS VARCHAR) AS BRIGHTNESS,
  CAST(BIRD_ACTIVITY AS VARCHAR) AS BIRD_ACTIVITY, CAST(SOUND_LEVEL AS VARCHAR) AS SOUND_LEVEL,
  CAST(CAMERA_OPERATIONAL AS VARCHAR) AS CAMERA_OPERATIONAL"""
BRONZE_SQL = f"""SELECT {CAMERA_TEXT}, TIMESTAMP '{RUN_TIME}' AS _processing_timestamp,
  {file_name('Camera')} AS _source_file_name, CAST(NULL AS VARCHAR) AS _rescued_data"""


# Batch reads of landing files.


@query(feeds(f"SELECT {CAMERA_TEXT} FROM camera"))
def ingest_csv_roundtrip(spark, sf_dir):
    files = landed_files(spark, sf_dir, CAMERA)
    (header,) = header_groups(spark, files)
    return read_csv_group(spark, header, files).drop(CORRUPT)


@query(feeds(f"""SELECT CAST(DAY AS VARCHAR) AS DAY, CAST(HOUR AS VARCHAR) AS HOUR,
  CAST(TEMPRATURE AS VARCHAR) AS temperature, CAST(HUMIDITY AS VARCHAR) AS humidity,
  TIMESTAMP '{RUN_TIME}' AS _processing_timestamp, {file_name('Environmental')} AS _source_file_name
FROM environmental"""), name="stamp_operational")
def stamp_landing_rows(spark, sf_dir):
    files = landed_files(spark, sf_dir, ENVIRONMENTAL)
    (header,) = header_groups(spark, files)
    return wall_clock(stamp_operational(read_csv_group(spark, header, files).drop(CORRUPT), run_time()))


@query(feeds("""
SELECT v.position, v.column_name, v.inferred_type, CASE v.position
         WHEN 0 THEN count(DAY) WHEN 1 THEN count(HOUR) WHEN 2 THEN count(BRIGHTNESS)
         WHEN 3 THEN count(BIRD_ACTIVITY) WHEN 4 THEN count(SOUND_LEVEL) ELSE count(CAMERA_OPERATIONAL) END AS filled
FROM camera, (VALUES (0, 'DAY', 'int'), (1, 'HOUR', 'int'), (2, 'BRIGHTNESS', 'double'),
                     (3, 'BIRD_ACTIVITY', 'double'), (4, 'SOUND_LEVEL', 'double'),
                     (5, 'CAMERA_OPERATIONAL', 'boolean')) v(position, column_name, inferred_type)
GROUP BY v.position, v.column_name, v.inferred_type"""), name="infer_feed_schema")
def infer_camera_schema(spark, sf_dir):
    return infer_feed_schema(spark, landing_folder(spark, sf_dir), CAMERA.glob)


@query("""
SELECT v.column_name, v.inferred_type, CASE v.column_name
         WHEN 'Settled' THEN count(*) FILTER (o_orderkey % 3 = 0) ELSE count(*) END AS filled
FROM orders, (VALUES ('DAY', 'int'), ('Receipt', 'bigint'), ('Serial', 'decimal(' || (SELECT length(max(o_orderkey)::VARCHAR) + 19 FROM orders) || ',0)'),
                     ('Price', 'double'), ('Placed', 'date'), ('Settled', 'timestamp'), ('Urgent', 'boolean'),
                     ('Remark', 'string')) v(column_name, inferred_type)
GROUP BY v.column_name, v.inferred_type""")
def infer_widening_types(spark, sf_dir):
    """Orders as landing files: every type of the lattice, two of them only once all files are folded."""
    key, placed = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    rows = load(spark, sf_dir, "orders").select(
        (key % 4).cast("int").alias("FARM_NO"),
        (F.col("o_custkey") % 2).cast("int").alias("SHED_NO"),
        (key % 30 + 1).cast("int").alias("DAY"),
        (key + 5_000_000_000).alias("Receipt"),
        F.concat(key.cast("string"), F.lit("0" * 19)).alias("Serial"),
        (key * 0.25 + 0.125).cast("double").alias("Price"),
        placed.alias("Placed"),
        F.when(key % 6 == 0, F.concat(placed, F.lit(" 10:30:00"))).when(key % 3 == 0, placed).alias("Settled"),
        F.when(key % 2 == 0, "yes").otherwise("false").alias("Urgent"),
        F.when(key % 4 == 1, "on hold").otherwise(placed).alias("Remark"),
    )
    folder = scratch_dir(spark, "landing")
    write_landing_files(rows, folder, FILE_PREFIXES["camera"])
    return infer_feed_schema(spark, folder, CAMERA.glob).drop("position")


def standard_rows(spark, sf_dir, contract, keep_source_columns=False):
    bronze = read_files(spark, landed_files(spark, sf_dir, contract), contract, run_time())
    return wall_clock(standardize(bronze, contract, keep_source_columns))


def standard_sql(columns: str, feed: str) -> str:
    return feeds(
        f"SELECT FARM_NO, SHED_NO, {columns}, TIMESTAMP '{RUN_TIME}' AS _processing_timestamp, "
        f"{file_name(FILE_PREFIXES[feed])} AS _source_file_name, CAST(NULL AS VARCHAR) AS _rescued_data FROM {feed}"
    )


@query(standard_sql("DAY, HOUR, BRIGHTNESS, BIRD_ACTIVITY, SOUND_LEVEL, CAMERA_OPERATIONAL", "camera"))
def standardize_camera(spark, sf_dir):
    return standard_rows(spark, sf_dir, CAMERA)


@query(standard_sql("DAY, HOUR, TEMPRATURE, HUMIDITY, CAST(TEMPRATURE AS VARCHAR) AS temperature_raw", "environmental"))
def standardize_environmental(spark, sf_dir):
    """The renamed column keeps its source beside it; the one that only changed case does not."""
    rows = standard_rows(spark, sf_dir, ENVIRONMENTAL, keep_source_columns=True)
    return rows.withColumnRenamed("temperature", "temperature_raw")


@query(standard_sql("DAY, WEIGHT_GM", "synthetic"))
def standardize_synthetic(spark, sf_dir):
    return standard_rows(spark, sf_dir, SYNTHETIC)


@query(standard_sql("DAY, WEIGHT_GM, 'flock ' || (DAY % 3) AS Flock", "synthetic"))
def standardize_pass_through(spark, sf_dir):
    """A column outside the contract that the feed passes through as text."""
    rows = landing_rows(synthetic_feed(load(spark, sf_dir, "events")))
    folder = scratch_dir(spark, "landing")
    flock = F.concat(F.lit("flock "), (F.col("DAY") % 3).cast("string"))
    files = write_landing_files(rows.withColumn("Flock", flock), folder, FILE_PREFIXES["synthetic"])
    contract = replace(SYNTHETIC, pass_through=("Flock",))
    return wall_clock(standardize(read_files(spark, files, contract, run_time()), contract))


@query(feeds("""
SELECT v.column_name, v.inferred_type, CASE v.column_name
         WHEN 'DAY' THEN 2 * count(DAY) WHEN 'HOUR' THEN 2 * count(HOUR) WHEN 'BRIGHTNESS' THEN 2 * count(BRIGHTNESS)
         WHEN 'BIRD_ACTIVITY' THEN 2 * count(BIRD_ACTIVITY) WHEN 'SOUND_LEVEL' THEN 2 * count(SOUND_LEVEL)
         WHEN 'CAMERA_OPERATIONAL' THEN 2 * count(CAMERA_OPERATIONAL) ELSE count(*) END AS filled
FROM camera, (VALUES ('DAY', 'int'), ('HOUR', 'int'), ('BRIGHTNESS', 'double'), ('BIRD_ACTIVITY', 'double'),
                     ('SOUND_LEVEL', 'double'), ('CAMERA_OPERATIONAL', 'boolean'), ('Vet', 'string')) v(column_name, inferred_type)
GROUP BY v.column_name, v.inferred_type"""))
def infer_mixed_headers(spark, sf_dir):
    """The feed twice, the second time with its columns turned round and one more."""
    rows = landing_rows(camera_feed(load(spark, sf_dir, "events")))
    folder = scratch_dir(spark, "landing")
    write_landing_files(rows, folder, FILE_PREFIXES["camera"])
    keys = ["FARM_NO", "SHED_NO"]
    turned = [c for c in reversed(rows.columns) if c not in keys]
    write_landing_files(rows.select(*keys, F.lit("none").alias("Vet"), *turned), folder, FILE_PREFIXES["camera"], "_Turned")
    return infer_feed_schema(spark, folder, CAMERA.glob).drop("position")


# Streams.


@query(feeds(f"{BRONZE_SQL} FROM camera"))
def bronze_append(spark, sf_dir):
    return wall_clock(camera_bronze(spark, sf_dir).read(spark))


@query(feeds(f"""{BRONZE_SQL}, 'insert' AS _change_type, CAST(1 AS BIGINT) AS versions_of_file,
  TIMESTAMP '{RUN_TIME}' AS _commit_timestamp FROM camera"""), name="bronze_change_feed")
def stream_bronze_changes(spark, sf_dir):
    """Change feed of bronze as a stream of its commits. Which batch took a file is up to the source,
    but each file has one version."""
    bronze = camera_bronze(spark, sf_dir)
    out = AppendTarget("changes", scratch_dir(spark, "changes"), bronze_change_feed(bronze.read(spark, True)).schema)

    def copy(commits, batch_id):
        rows = bronze.read_batches(spark, sorted(row[BATCH_ID] for row in commits.collect()))
        out.append_batch(bronze_change_feed(rows), batch_id)

    stream = bronze.commit_stream(spark, max_batches=1)
    writer = stream.writeStream.option("checkpointLocation", out.checkpoint).trigger(**ONCE)
    writer.foreachBatch(copy).start().awaitTermination()
    changes = out.read(spark)
    versions = changes.groupBy(SOURCE_FILE).agg(F.count_distinct("_commit_version").alias("versions_of_file"))
    told = changes.join(versions, SOURCE_FILE).drop("_commit_version")
    return wall_clock(told, PROCESSING_TIME, "_commit_timestamp")


def drain(spark, stream, label):
    """Everything a stream has to offer now, stored as Parquet and read back."""
    out = scratch_dir(spark, label)
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(**ONCE)
        .start(f"{out}/rows")
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def registered_bronze(spark, sf_dir):
    bronze = camera_bronze(spark, sf_dir)
    name = f"bronze_camera_{uuid.uuid4().hex[:8]}"
    register_table(spark, name, bronze.data, bronze.stored_schema)
    return name


@query(feeds(f"{BRONZE_SQL} FROM camera"))
def stream_table_scan(spark, sf_dir):
    name = registered_bronze(spark, sf_dir)
    rows = drain(spark, stream_table(spark, name), "scan")
    spark.sql(f"DROP TABLE {name}")  # the name; the files stay
    return wall_clock(rows.drop(BATCH_ID))


@query(feeds(f"{BRONZE_SQL} FROM camera"))
def batch_table_scan(spark, sf_dir):
    name = registered_bronze(spark, sf_dir)
    rows = batch_table(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return wall_clock(rows.drop(BATCH_ID))


PER_FILE = "CAST(count(*) AS BIGINT) AS n_rows"
TWO_DELIVERIES = feeds(f"""
SELECT {file_name('Camera')} AS _source_file_name, {PER_FILE}
FROM camera WHERE ts < TIMESTAMP '{MID_CYCLE}' GROUP BY 1
UNION ALL
SELECT {file_name('Camera', '_Late')}, count(*)
FROM camera WHERE ts >= TIMESTAMP '{MID_CYCLE}' GROUP BY 1""")


def rows_per_file(bronze, spark):
    return bronze.read(spark).groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n_rows"))


def two_deliveries(spark, sf_dir, **options):
    """Files of the first half of the cycle, then those of the second, then nothing new.

    The second delivery keeps old modification times, as a restored backup does.
    """
    events = load(spark, sf_dir, "events")
    landing, bronze = scratch_dir(spark, "landing"), fresh_bronze(spark, CAMERA)
    land_feed(before(events), "camera", landing)
    ingest(spark, CAMERA, landing, bronze, **options)
    for path in land_feed(after(events), "camera", landing, tag="_Late"):
        set_modified(spark, path, modified_at(spark, path) - TEN_DAYS)
    ingest(spark, CAMERA, landing, bronze, **options)
    ingest(spark, CAMERA, landing, bronze, **options)
    return rows_per_file(bronze, spark)


@query(TWO_DELIVERIES)
def ingest_incremental(spark, sf_dir):
    return two_deliveries(spark, sf_dir, max_files=FILES_PER_BATCH)


@query(TWO_DELIVERIES)
def ingest_clean_source(spark, sf_dir):
    """Processed files are deleted along the way, which must not change what was read."""
    return two_deliveries(spark, sf_dir, max_files=FILES_PER_BATCH, clean_source=True)


@query(feeds(f"""
SELECT {file_name('Synthetic_Poultry')} AS _source_file_name, {PER_FILE}
FROM synthetic GROUP BY 1"""))
def ingest_glob(spark, sf_dir):
    """One feed out of a folder that holds the files of all three."""
    bronze = fresh_bronze(spark, SYNTHETIC)
    ingest(spark, SYNTHETIC, landing_folder(spark, sf_dir), bronze, max_files=FILES_PER_BATCH)
    return rows_per_file(bronze, spark)


@query(feeds("""
SELECT CAST(b AS BIGINT) AS batch_id, CAST(least(5, n - 5 * b) AS BIGINT) AS n_files
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT FARM_NO, SHED_NO, (DAY - 1) // 10 FROM camera)), range(1000) r(b)
WHERE 5 * b < n"""))
def ingest_rate_limit(spark, sf_dir):
    """Files per micro-batch under the limit of the contract."""
    bronze = fresh_bronze(spark, CAMERA)
    ingest(spark, CAMERA, landing_folder(spark, sf_dir), bronze)
    rows = bronze.read(spark, with_batch_id=True)
    return rows.groupBy(BATCH_ID).agg(F.count_distinct(SOURCE_FILE).alias("n_files"))
