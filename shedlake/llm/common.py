"""Helpers shared by the operators: shared scratch tables, ASCII case folding, labelled samples."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shedlake.session import scratch_dir


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder; later reads survive lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_rounds(rounds: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all rounds, as ``stored`` has them. One round is written after the other, so that with
    ``shuffles_dropped`` the disk holds the shuffles of one at a time."""
    path = None
    for df in rounds:
        path = path or scratch_dir(df.sparkSession, label)
        df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run within go when each of them ends.

    Else they stay until the driver happens to collect its garbage, which a small driver of a long job may not do.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows with their lineage cut, in the shared folder; Spark removes them when unused."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Plain ASCII text takes the fast built-in path."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def among_few(key: Column, wanted: int, count: int) -> Column:
    """True for about three times ``wanted`` of ``count`` rows, chosen by a hash; for all if there are no more.

    Taken before a sort with a limit, it keeps each task from handing over as many rows as the limit.
    """
    span = 2**31
    bar = span if count <= 3 * wanted else -(-3 * wanted * span // count)
    return F.pmod(F.xxhash64(F.lit("few"), key), F.lit(span)) < F.lit(bar)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """Whole texts and labels of at most ``per_class`` documents of either class, the same ones each time.

    Ids are picked from the label table alone, in the order of a hash. Held-out ids, null labels
    and ids that carry both labels are left out.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .where("low = high")
    )
    counts = {r.high: r.n for r in known.groupBy("high").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for value in (0, 1):
        few = known.where((F.col("high") == value) & among_few(F.col("doc_id"), per_class, counts.get(value, 0)))
        part = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    ids = picked.select(F.col("doc_id").alias("picked_id"), F.col("high").cast("int").alias("picked_label"))
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(ids), F.col("doc_id") == F.col("picked_id"))  # 2 * per_class rows at most
        .groupBy("picked_id", "picked_label")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("picked_text"))
        .collect()
    )
    return [(r.picked_text, r.picked_label) for r in sorted(rows, key=lambda r: r.picked_id)]
