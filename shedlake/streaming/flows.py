"""The two streaming flows of a feed: landing files to bronze, bronze to silver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shedlake.contracts import FeedContract
from shedlake.functions.columns import incomplete_key, split_quarantine, standardize
from shedlake.sources.landing import HeaderBook, header_groups, header_mismatch, new_files_stream, read_files
from shedlake.sources.paths import exists
from shedlake.sources.tables import BATCH_ID
from shedlake.streaming.targets import AppendTarget, KeyedTarget

ONCE = {"availableNow": True}


def _check_start(spark: SparkSession, target: AppendTarget | KeyedTarget) -> None:
    """Without its checkpoint a stream counts batches from zero again, and new batches would pass for replays."""
    if target.versions(spark) and not exists(spark, target.checkpoint):
        raise ValueError(f"{target.name} holds batches but its checkpoint {target.checkpoint} is gone")


def commits_flow(
    spark: SparkSession,
    sources: Sequence[AppendTarget | KeyedTarget],
    checkpoint: str,
    act: Callable[[list[list[int]], int], None],
    max_batches: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a flow that acts on the batches that several tables commit.

    ``act`` gets the numbers of the new batches of each source and the number of the micro-batch, which
    may come again after a crash. How far each source has been read is kept by the stream's checkpoint.
    """
    streams = [s.commit_stream(spark, max_batches).withColumn("source", F.lit(n)) for n, s in enumerate(sources)]

    def write(commits: DataFrame, batch_id: int) -> None:
        rows = commits.collect()  # at most max_batches numbers of each source
        if rows:
            act([sorted(r[BATCH_ID] for r in rows if r.source == n) for n in range(len(sources))], batch_id)

    return (
        reduce(DataFrame.unionByName, streams)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .foreachBatch(write)
        .start()
    )


def _counted(seen: Observation, name: str) -> int:
    """An observed count. Where Spark found a step empty it drops what was observed; then assume one."""
    try:
        return seen.get.get(name, 1)
    except Py4JJavaError:
        return 1


def append_flow(
    spark: SparkSession,
    contract: FeedContract,
    landing: str,
    bronze: AppendTarget,
    max_files: int | None = None,
    clean_source: bool = False,
    trigger: dict | None = None,
    processing_time: Column | None = None,
    bytes_per_task: int = 16 * 1024 * 1024,
) -> StreamingQuery:
    """Start the flow that appends the rows of each new landing file to bronze exactly once.

    ``bytes_per_task`` is what one task takes in when a batch is many small files, which then become
    few tasks and stored files. It changes neither rows nor the splitting of large files.
    """

    def write(listing: DataFrame, batch_id: int) -> None:
        # At most max_files short rows; the data itself never leaves the executors.
        files = {row.path: row.length for row in listing.collect()}
        if not files:
            return
        paths, enough = sorted(files), 1 + sum(files.values()) // bytes_per_task

        def append(groups: dict[tuple[str, ...], list[str]], checked: bool) -> None:
            rows = read_files(spark, paths, contract, processing_time, groups, checked)
            bronze.append_batch(rows.coalesce(enough) if enough < len(files) else rows, batch_id)

        header = book.expected()
        if header is not None:
            try:
                return append({header: paths}, True)
            except (PySparkException, Py4JJavaError) as error:  # nothing has been committed
                if not header_mismatch(error):
                    raise
        groups = header_groups(spark, paths)
        book.learn(groups, batch_id)
        append(groups, False)

    _check_start(spark, bronze)
    book = HeaderBook(spark, f"{bronze.path}/headers")
    listing = new_files_stream(spark, landing, contract.glob, max_files or contract.max_files, clean_source)
    return (
        listing.writeStream.option("checkpointLocation", bronze.checkpoint)
        .trigger(**(trigger or ONCE))
        .foreachBatch(write)
        .start()
    )


def upsert_flow(
    spark: SparkSession,
    contract: FeedContract,
    bronze: AppendTarget,
    silver: KeyedTarget,
    quarantine: AppendTarget,
    keep_source_columns: bool = False,
    max_batches: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the flow that standardises new bronze rows and upserts them into silver.

    One upsert takes in at most ``max_batches`` committed batches of bronze. Rows without a complete key cannot be upserted and go to quarantine instead.
    """

    def upsert(batches: list[list[int]], batch_id: int) -> None:
        rows = bronze.read_batches(spark, batches[0]).drop(BATCH_ID)
        standard = standardize(rows, contract, keep_source_columns)
        seen = Observation()
        incomplete = F.count_if(incomplete_key(contract.keys))
        keyed = split_quarantine(standard.observe(seen, incomplete.alias("broken")), contract.keys)[0]
        # The upsert counts the rows without a key on its way; only if there are any, or if this is a
        # replay that need not repeat the upsert, is the batch scanned again for them.
        if not silver.merge_batch(keyed, batch_id) or _counted(seen, "broken"):
            quarantine.append_batch(split_quarantine(standard, contract.keys)[1], batch_id)

    _check_start(spark, silver)
    return commits_flow(spark, [bronze], silver.checkpoint, upsert, max_batches, trigger)
