"""Write targets on plain Parquet folders.

Each target writes a batch or version into a folder of its own, and only folders that are marked
complete are read: by Spark's own marker, or, where the batches are streamed on, by a small file
that names the batch. A batch that is replayed after a crash finds its folder either complete, and
is skipped, or incomplete, and is overwritten. Nothing that can be read is ever rewritten.
One writer per target; its stream checkpoint lives beside the data, so batch numbers and folders
cannot drift apart.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.operators.scd1 import MARK, fold_changes, fold_lifted, mark_order, publish
from shedlake.operators.snapshots import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, change_images, snapshot_diff
from shedlake.sources.landing import new_files_stream
from shedlake.sources.paths import complete_versions, drop_folder, exists, glob, make_folder, put_text
from shedlake.sources.tables import BATCH_ID

VERSION = "version"
COMMIT = ".commit"
NAMED_FOLDERS = 32  # folders that a read names one by one
FILE_BYTES = "file_bytes"  # table property: size that stored files should have
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def _ranges(numbers: Sequence[int]) -> list[tuple[int, int]]:
    """Ascending numbers as ranges without gaps."""
    out: list[tuple[int, int]] = []
    for n in sorted(numbers):
        out = [*out[:-1], (out[-1][0], n)] if out and out[-1][1] == n - 1 else [*out, (n, n)]
    return out


@contextmanager
def _advised(spark: SparkSession, size: str | None) -> Iterator[None]:
    """Have Spark aim at partitions of a size while a write runs. Streams have a session of their own each."""
    if size is None:
        yield
        return
    wanted = {ADVISORY: size, PARALLELISM_FIRST: "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@dataclass(frozen=True)
class Target:
    """What a table is: where it lives, its columns, its keys, and what to tell its readers."""

    name: str
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    comment: str = ""
    properties: dict[str, str] = field(default_factory=dict)

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/_checkpoint"

    @property
    def commits(self) -> str:
        return f"{self.path}/commits"

    def _commit(self, spark: SparkSession, batch_id: int) -> None:
        """Make a batch visible; its commit says when, in milliseconds since the epoch."""
        put_text(spark, self.commits, f"{batch_id}{COMMIT}", str(time.time_ns() // 1_000_000))

    def commit_times(self, spark: SparkSession) -> DataFrame:
        """(batch_id, committed_at) of every committed batch, as told by the commits themselves."""
        told = spark.read.text(f"{self.commits}/*{COMMIT}").select(
            F.regexp_extract("_metadata.file_name", rf"^(\d+)\{COMMIT}$", 1).cast("bigint").alias(BATCH_ID),
            F.timestamp_millis(F.col("value").try_cast("bigint")).alias("committed_at"),
        )
        return told

    def commit_stream(self, spark: SparkSession, max_batches: int = 1000) -> DataFrame:
        """The numbers of committed batches as a stream, for micro-batches that read these batches.

        Streaming the data folder itself would also show what a crash left half written.
        """
        make_folder(spark, self.commits)
        names = new_files_stream(spark, self.commits, f"*{COMMIT}", max_batches)
        return names.select(F.regexp_extract("path", rf"(\d+)\{COMMIT}$", 1).cast("bigint").alias(BATCH_ID))

    def _write(self, df: DataFrame, path: str) -> None:
        # Rebalancing splits a partition value that holds most of the rows and merges small ones. Without
        # partition columns it is done where a file size is asked for, whatever tasks the rows come in.
        size = self.properties.get(FILE_BYTES)
        sized = df.hint("rebalance", *self.partition_by) if self.partition_by or size else df
        writer = sized.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        with _advised(df.sparkSession, size):
            writer.parquet(path)

    def _read_numbered(
        self, spark: SparkSession, root: str, label: str, numbers: Sequence[int], schema: T.StructType
    ) -> DataFrame:
        """Rows of the folders ``<label>=<number>`` under ``root``.

        A few folders are named one by one. Many are ranges of numbers in one scan of the root, so that
        neither the plan nor the list of paths grows with them; Spark prunes the other folders.
        """
        if len(numbers) <= NAMED_FOLDERS:
            return self._read(spark, root, [f"{root}/{label}={n}" for n in numbers], schema)
        stored = schema if label in schema.names else T.StructType([*schema.fields, T.StructField(label, T.LongType())])
        wanted = reduce(lambda a, b: a | b, (F.col(label).between(low, high) for low, high in _ranges(numbers)))
        rows = spark.read.schema(stored).parquet(root).where(wanted)
        return rows.select(*(f"`{c}`" for c in schema.names))

    def _read(self, spark: SparkSession, root: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", root).parquet(*folders)
        return rows.select(*(f"`{c}`" for c in schema.names))


@dataclass(frozen=True)
class AppendTarget(Target):
    """Append-only table: one folder per batch."""

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BATCH_ID, T.LongType())])

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the committed batches."""
        found = glob(spark, f"{self.commits}/*{COMMIT}")
        return sorted(int(p.rsplit("/", 1)[1].removesuffix(COMMIT)) for p in found)

    def append_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Store one batch and commit it, unless that has been done already: one look-up."""
        spark, commit = batch.sparkSession, f"{self.commits}/{batch_id}{COMMIT}"
        if not exists(spark, commit):
            self._write(batch.select(*self.schema.names), f"{self.data}/{BATCH_ID}={batch_id}")
            self._commit(spark, batch_id)

    def read(self, spark: SparkSession, with_batch_id: bool = False) -> DataFrame:
        rows = self.read_batches(spark, self.versions(spark))
        return rows if with_batch_id else rows.drop(BATCH_ID)

    def read_batches(self, spark: SparkSession, batches: Sequence[int]) -> DataFrame:
        """The rows of some committed batches, batch number included."""
        return self._read_numbered(spark, self.data, BATCH_ID, batches, self.stored_schema)


@dataclass(frozen=True)
class KeyedTarget(Target):
    """Current-state table fed by sequenced upserts.

    A batch is folded by itself and stored as a small delta; the state is the fold of all deltas,
    which does not depend on their order or on replays. Writing a batch therefore costs as much as
    the batch, not as much as the table, and reading costs no shuffle beyond the one a join on the
    keys needs anyway. Under one sequence column a batch is folded by hash, and the state holds one
    position and one value per column. ``compact`` folds the deltas so far into a base, to keep reads
    short; when to do that is up to the owner of the table.
    """

    sequence: tuple[str, ...] = ()
    sequence_types: T.StructType = field(default_factory=T.StructType)

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.keys]

    @property
    def state_schema(self) -> T.StructType:
        def mark(column: str) -> T.StructField:
            before = [self.sequence_types[c] for c in mark_order(column, self.sequence)]
            position = [T.StructField("position", T.StructType(before))] if before else []
            value = T.StructField("value", self.schema[column].dataType)
            return T.StructField(MARK + column, T.StructType([*position, value]))

        return T.StructType([*(self.schema[k] for k in self.keys), *(mark(c) for c in self.values)])

    @property
    def deltas(self) -> str:
        return f"{self.path}/delta"

    @property
    def bases(self) -> str:
        return f"{self.path}/base"

    def merge_batch(self, changes: DataFrame, batch_id: int) -> bool:
        """Upsert one batch of changes; a null never replaces a stored value. False if already done."""
        spark, fresh = changes.sparkSession, not exists(changes.sparkSession, f"{self.deltas}/{BATCH_ID}={batch_id}/_SUCCESS")
        if fresh:
            folded = fold_changes(changes, self.keys, self.sequence, self.values)
            self._write(folded, f"{self.deltas}/{BATCH_ID}={batch_id}")
        if not exists(spark, f"{self.commits}/{batch_id}{COMMIT}"):
            self._commit(spark, batch_id)
        return fresh

    def versions(self, spark: SparkSession) -> list[int]:
        return complete_versions(spark, self.deltas, BATCH_ID)

    def _base(self, spark: SparkSession, as_of: int | None) -> int | None:
        fit = [n for n in complete_versions(spark, self.bases, VERSION) if as_of is None or n <= as_of]
        return max(fit, default=None)

    def base_version(self, spark: SparkSession) -> int | None:
        """The last batch that the base, if there is one, has taken in."""
        return self._base(spark, None)

    def _delta_rows(self, spark: SparkSession, batches: Sequence[int]) -> DataFrame:
        return self._read_numbered(spark, self.deltas, BATCH_ID, batches, self.state_schema)

    def _base_rows(self, spark: SparkSession, base: int) -> DataFrame:
        return self._read(spark, self.bases, [f"{self.bases}/{VERSION}={base}"], self.state_schema)

    def read_where(self, spark: SparkSession, condition: Column) -> DataFrame:
        """Current state of the keys that meet a condition on the key columns.

        Other rows are left out before anything is folded, in the scan where the condition allows it.
        """
        rows, folded = self._lifted(spark, None)
        rows = rows.where(condition)
        return publish(rows if folded else fold_lifted(rows, self.keys)).select(*self.schema.names)

    def touched(self, spark: SparkSession, batches: Sequence[int], *columns: str) -> DataFrame:
        """Distinct values of some key columns that the given batches brought changes for."""
        return self._delta_rows(spark, batches).select(*columns).distinct()

    def _pending(self, spark: SparkSession, as_of: int | None) -> list[int]:
        """Batches up to ``as_of`` that no base covers."""
        base = self._base(spark, as_of)
        return [
            n for n in self.versions(spark) if (base is None or n > base) and (as_of is None or n <= as_of)
        ]

    def _lifted(self, spark: SparkSession, as_of: int | None) -> tuple[DataFrame, bool]:
        """Rows to fold for the state after batch ``as_of``, and whether they are folded already."""
        base, pending = self._base(spark, as_of), self._pending(spark, as_of)
        if base is None:
            return self._delta_rows(spark, pending), len(pending) <= 1
        stored = self._base_rows(spark, base)
        return (stored.unionByName(self._delta_rows(spark, pending)) if pending else stored), not pending

    def state(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """One lifted row per key. Only keys that deltas touch are folded; other base rows pass through."""
        rows, folded = self._lifted(spark, as_of)
        if folded:
            return rows
        base, pending = self._base(spark, as_of), self._pending(spark, as_of)
        if base is None:
            return fold_lifted(rows, self.keys)
        keys, fresh = list(self.keys), self._delta_rows(spark, pending)
        touched, stored = fresh.select(*keys).distinct(), self._base_rows(spark, base)
        again = fold_lifted(stored.join(touched, keys, "left_semi").unionByName(fresh), keys)
        return stored.join(touched, keys, "left_anti").unionByName(again)

    def read(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """Current state, or the state right after batch ``as_of``."""
        return publish(self.state(spark, as_of)).select(*self.schema.names)

    def read_keys(self, spark: SparkSession, *columns: str) -> DataFrame:
        """Key columns of every stored row, unfolded: folding never adds or removes a key."""
        return self._lifted(spark, None)[0].select(*columns)

    def read_changes(self, spark: SparkSession, start: int = 0, end: int | None = None) -> DataFrame:
        """Change feed of batches ``start`` to ``end``, each batch a commit of its own.

        One pass, however many batches: the stored rows of a key, in the order of the batches, are
        folded step by step, and each step is compared with the one before it.
        """
        base = self._base(spark, start - 1)
        batches = [n for n in self.versions(spark) if (base is None or n > base) and (end is None or n <= end)]
        schema = T.StructType([*self.state_schema.fields, T.StructField(BATCH_ID, T.LongType())])
        rows = self._read_numbered(spark, self.deltas, BATCH_ID, batches, schema)
        if base is not None:
            rows = rows.unionByName(self._base_rows(spark, base).withColumn(BATCH_ID, F.lit(base).cast("bigint")))
        if not any(n >= start for n in batches):
            return self._no_changes(spark)
        times = self.commit_times(spark).select(F.col(BATCH_ID).alias("number"), "committed_at").where(F.col("number") >= start)
        steps = Window.partitionBy(*self.keys).orderBy(BATCH_ID)
        before = steps.rowsBetween(Window.unboundedPreceding, -1)
        up_to = steps.rowsBetween(Window.unboundedPreceding, 0)

        def image(window: WindowSpec) -> Column:
            return F.struct(*(F.max(MARK + c).over(window)["value"].alias(c) for c in self.values))

        first = F.row_number().over(steps) == 1
        same = F.col("old").eqNullSafe(F.col("new"))
        pairs = rows.select(*self.keys, BATCH_ID, first.alias("first"), image(before).alias("old"), image(up_to).alias("new"))
        label = F.when(F.col("first"), "insert").when(same, "unchanged").otherwise("update")
        told = pairs.withColumn("label", label).join(times, F.col(BATCH_ID) == F.col("number"))
        return change_images(told, self.keys, self.values, F.col("number"), F.col("committed_at"))

    def read_changes_between(self, spark: SparkSession, since: datetime, until: datetime | None = None) -> DataFrame:
        """Change feed of the batches committed from ``since`` on and up to ``until``."""
        times = self.commit_times(spark).where(F.col("committed_at") >= F.lit(since))
        if until is not None:
            times = times.where(F.col("committed_at") <= F.lit(until))
        first, last = times.agg(F.min(BATCH_ID), F.max(BATCH_ID)).first()
        return self._no_changes(spark) if first is None else self.read_changes(spark, first, last)

    def _no_changes(self, spark: SparkSession) -> DataFrame:
        kinds = [(CHANGE_TYPE, T.StringType()), (COMMIT_VERSION, T.LongType()), (COMMIT_TIMESTAMP, T.TimestampType())]
        fields = [self.schema[c] for c in (*self.keys, *self.values)]
        return spark.createDataFrame([], T.StructType([*fields, *(T.StructField(n, k) for n, k in kinds)]))

    def compact(self, spark: SparkSession) -> int | None:
        """Fold everything stored so far into a base. None if there is nothing new to fold."""
        pending = self._pending(spark, None)
        if not pending:
            return None
        self._write(self.state(spark), f"{self.bases}/{VERSION}={pending[-1]}")
        return pending[-1]


@dataclass(frozen=True)
class SnapshotTarget(Target):
    """Table replaced as a whole: one folder per version, the highest complete one is current."""

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    def versions(self, spark: SparkSession) -> list[int]:
        return complete_versions(spark, self.data, VERSION)

    def write_version(self, rows: DataFrame) -> int:
        version = max(self.versions(rows.sparkSession), default=-1) + 1
        self._write(rows.select(*self.schema.names), f"{self.data}/{VERSION}={version}")
        return version

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        chosen = max(self.versions(spark), default=None) if version is None else version
        folders = [] if chosen is None else [f"{self.data}/{VERSION}={chosen}"]
        return self._read(spark, self.data, folders, self.schema)

    def read_or_none(self, spark: SparkSession) -> DataFrame | None:
        """Current version, or ``None`` before the first one: an explicit test, not a caught error."""
        return self.read(spark) if self.versions(spark) else None


@dataclass(frozen=True)
class PartitionTarget(Target):
    """Table derived from others and refreshed by partitions, each replaced as a whole.

    Spark overwrites the partitions that a refresh has rows for, so the table's folder holds current
    rows only. Before that, the rows are stored with what became of each since the last refresh:
    the change report, from which a refresh that broke off is finished.
    """

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    @property
    def reports(self) -> str:
        return f"{self.path}/reports"

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the refreshes."""
        return complete_versions(spark, self.reports, BATCH_ID)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.data, [self.data] if exists(spark, self.data) else [], self.schema)

    def _report(self, spark: SparkSession, batches: Sequence[int]) -> DataFrame:
        change = [T.StructField(CHANGE_TYPE, T.StringType()), T.StructField(BATCH_ID, T.LongType())]
        folders = [f"{self.reports}/{BATCH_ID}={n}" for n in batches]
        return self._read(spark, self.reports, folders, T.StructType([*self.schema.fields, *change]))

    def refresh(self, rows: DataFrame, where: Column, batch_id: int) -> DataFrame:
        """Make ``rows`` all that the table holds where the partitions meet ``where``; returns them as stored.

        Running a refresh again under its number changes nothing.
        """
        spark = rows.sparkSession
        if not exists(spark, f"{self.reports}/{BATCH_ID}={batch_id}/_SUCCESS"):
            told = rows.select(*self.schema.names)
            if exists(spark, self.data):
                told = snapshot_diff(self.read(spark).where(where), told, self.keys, unique=True)
            else:
                told = told.withColumn(CHANGE_TYPE, F.lit("insert"))
            told.write.mode("overwrite").parquet(f"{self.reports}/{BATCH_ID}={batch_id}")
        stored = self._report(spark, [batch_id]).drop(BATCH_ID)
        kept = stored.where(F.col(CHANGE_TYPE) != "delete").drop(CHANGE_TYPE)
        with _advised(spark, self.properties.get(FILE_BYTES)):
            (
                kept.hint("rebalance", *self.partition_by)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*self.partition_by)
                .parquet(self.data)
            )
        # Spark leaves partitions alone that there are no rows for any more.
        gone = stored.where(F.col(CHANGE_TYPE) == "delete").select(*self.partition_by).distinct()
        for row in gone.join(kept.select(*self.partition_by).distinct(), list(self.partition_by), "left_anti").collect():
            drop_folder(spark, "/".join([self.data, *(f"{c}={row[c]}" for c in self.partition_by)]))
        return kept

    def read_report(self, spark: SparkSession) -> DataFrame:
        """What each refresh inserted, updated and deleted."""
        return self._report(spark, self.versions(spark)).where(F.col(CHANGE_TYPE) != "unchanged")
