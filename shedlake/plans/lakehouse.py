"""The lake as a whole: three feeds to silver, silver to gold, and the farm dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shedlake.contracts import (
    CAMERA,
    DAILY_KEYS,
    ENVIRONMENTAL,
    FEEDS,
    HOURLY_KEYS,
    PROCESSING_TIME,
    READING,
    SMALLINT,
    FeedContract,
)
from shedlake.operators.activity import (
    ACTIVITY_MEASURES,
    CLIMATE_MEASURES,
    aggregate_activity,
    business_view,
    join_activity,
)
from shedlake.operators.dimension import added_members
from shedlake.sources.catalog import declare
from shedlake.sources.paths import exists
from shedlake.streaming.flows import append_flow, commits_flow, upsert_flow
from shedlake.streaming.targets import AppendTarget, KeyedTarget, PartitionTarget, Target

MEAN = T.DecimalType(10, 6)
GOLD_PARTITION = ("DAY",)  # gold is refreshed by days of the cycle, of which there are few
MEASURES = (*ACTIVITY_MEASURES, *CLIMATE_MEASURES)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


HOURLY_SCHEMA = _columns(
    DAY=SMALLINT, HOUR=SMALLINT, FARM_NO=T.IntegerType(), SHED_NO=T.IntegerType(), **dict.fromkeys(MEASURES, READING)
)
DAILY_SCHEMA = _columns(
    FARM_NO=T.IntegerType(), SHED_NO=T.IntegerType(), DAY=SMALLINT, **{f"AVG_{m}": MEAN for m in MEASURES}
)
DIM_SCHEMA = _columns(FARM_NO=T.IntegerType(), ID=T.StringType(), **{PROCESSING_TIME: T.TimestampType()})


@dataclass(frozen=True)
class Lake:
    """All tables under one root folder.

    ``partition_by`` lays out silver by key columns, for readers that filter on them. Silver tables
    grow by a delta per upsert; call ``silver(feed).compact(spark)`` when reads should get shorter.
    """

    root: str
    partition_by: tuple[str, ...] = ()
    keep_source_columns: bool = False

    def bronze(self, feed: FeedContract) -> AppendTarget:
        return AppendTarget(
            name=f"bronze_{feed.name}",
            path=f"{self.root}/bronze_{feed.name}",
            schema=feed.bronze_schema(),
            comment=f"{feed.name} readings as landed",
            properties=dict(feed.properties),
        )

    def silver(self, feed: FeedContract) -> KeyedTarget:
        standard = feed.standard_schema(self.keep_source_columns)
        stored = feed.stored_columns(self.keep_source_columns)
        return KeyedTarget(
            name=f"silver_{feed.name}",
            path=f"{self.root}/silver_{feed.name}",
            schema=T.StructType([standard[c] for c in (*feed.keys, *stored)]),
            keys=feed.keys,
            partition_by=self.partition_by,
            comment=f"{feed.name} readings, current value per key",
            properties={"quality": "silver"},
            sequence=(feed.sequence,),
            sequence_types=standard,
        )

    def quarantine(self, feed: FeedContract) -> AppendTarget:
        return AppendTarget(
            name=f"quarantine_{feed.name}",
            path=f"{self.root}/quarantine_{feed.name}",
            schema=feed.standard_schema(self.keep_source_columns),
            comment=f"{feed.name} readings without a complete key",
            properties={"quality": "quarantine"},
        )

    @property
    def hourly(self) -> PartitionTarget:
        return PartitionTarget(
            name="gold_activity_hourly",
            path=f"{self.root}/gold_activity_hourly",
            schema=HOURLY_SCHEMA,
            keys=HOURLY_KEYS,
            partition_by=GOLD_PARTITION,
            comment="hourly climate and activity per shed",
            properties={"quality": "gold"},
        )

    @property
    def daily(self) -> PartitionTarget:
        return PartitionTarget(
            name="gold_activity_daily",
            path=f"{self.root}/gold_activity_daily",
            schema=DAILY_SCHEMA,
            keys=DAILY_KEYS,
            partition_by=GOLD_PARTITION,
            comment="daily mean climate and activity per shed",
            properties={"quality": "gold"},
        )

    @property
    def farms(self) -> AppendTarget:
        return AppendTarget(
            name="dim_farm",
            path=f"{self.root}/dim_farm",
            schema=DIM_SCHEMA,
            keys=("FARM_NO",),
            comment="farms seen in any feed",
            properties={"quality": "silver"},
        )

    def targets(self) -> list[Target]:
        per_feed = [t for f in FEEDS.values() for t in (self.bronze(f), self.silver(f), self.quarantine(f))]
        return [*per_feed, self.hourly, self.daily, self.farms]


def run_feeds(
    spark: SparkSession,
    lake: Lake,
    landing: Mapping[str, str],
    max_files: int | None = None,
    clean_source: bool = False,
    processing_time: Column | None = None,
    bronze_batches: int = 1000,
) -> None:
    """Bring silver up to date with the landing folders, given by feed name.

    The feeds do not depend on each other, so their flows run side by side. ``max_files`` limits
    the landing files of a batch (the contract says how many otherwise), ``bronze_batches`` the
    batches of bronze that one upsert takes in.
    """
    feeds = [FEEDS[name] for name in landing]
    appends = [
        append_flow(spark, f, landing[f.name], lake.bronze(f), max_files, clean_source, None, processing_time)
        for f in feeds
    ]
    for query in appends:
        query.awaitTermination()
    upserts = [
        upsert_flow(
            spark, f, lake.bronze(f), lake.silver(f), lake.quarantine(f), lake.keep_source_columns, bronze_batches
        )
        for f in feeds
        if exists(spark, lake.bronze(f).commits)
    ]
    for query in upserts:
        query.awaitTermination()


def gold_flow(spark: SparkSession, lake: Lake, trigger: dict | None = None) -> StreamingQuery:
    """Start the flow that brings both gold tables up to date with what silver has committed.

    Only days that silver has got changes for are recomputed. The daily means come from the hourly rows
    as they have just been stored.
    """
    sources = [lake.silver(CAMERA), lake.silver(ENVIRONMENTAL)]

    def refresh(batches: list[list[int]], batch_id: int) -> None:
        days = reduce(DataFrame.union, (s.touched(spark, n, "DAY") for s, n in zip(sources, batches, strict=True)))
        touched = sorted(r.DAY for r in days.distinct().collect())  # a day is a small number within a cycle
        if not touched:
            return
        where = F.col("DAY").isin(touched)
        camera, environmental = (business_view(s.read_where(spark, where)) for s in sources)
        hourly = lake.hourly.refresh(join_activity(environmental, camera), where, batch_id)
        lake.daily.refresh(aggregate_activity(hourly), where, batch_id)

    return commits_flow(spark, sources, lake.hourly.checkpoint, refresh, trigger=trigger)


def dimension_flow(
    spark: SparkSession,
    lake: Lake,
    processing_time: Column | None = None,
    feeds: Sequence[FeedContract] = (CAMERA, ENVIRONMENTAL),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the flow that adds farms which new batches of silver are the first to name.

    Only the key column of these batches is read, and only new members are stored.
    """
    sources = [lake.silver(f) for f in feeds]

    def add(batches: list[list[int]], batch_id: int) -> None:
        keys = [s.touched(spark, n, "FARM_NO") for s, n in zip(sources, batches, strict=True)]
        lake.farms.append_batch(added_members(lake.farms.read(spark), keys, processing_time=processing_time), batch_id)

    return commits_flow(spark, sources, lake.farms.checkpoint, add, trigger=trigger)


def run_gold(spark: SparkSession, lake: Lake) -> int | None:
    """Bring gold up to date; the number of the last refresh, if there has been one."""
    gold_flow(spark, lake).awaitTermination()
    return max(lake.daily.versions(spark), default=None)


def run_dimension(
    spark: SparkSession,
    lake: Lake,
    processing_time: Column | None = None,
    feeds: Sequence[FeedContract] = (CAMERA, ENVIRONMENTAL),
) -> int | None:
    """Bring the farm dimension up to date; the number of its last batch, if there has been one."""
    dimension_flow(spark, lake, processing_time, feeds).awaitTermination()
    return max(lake.farms.versions(spark), default=None)


def run_all(
    spark: SparkSession,
    lake: Lake,
    landing: Mapping[str, str],
    max_files: int | None = None,
    clean_source: bool = False,
    processing_time: Column | None = None,
) -> None:
    """One pass over the whole lake: ingest what is new, then refresh dimension and gold."""
    run_feeds(spark, lake, landing, max_files, clean_source, processing_time)
    for query in (dimension_flow(spark, lake, processing_time), gold_flow(spark, lake)):  # side by side
        query.awaitTermination()


def publish_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Make every table readable by name in this session; call again after a run to see its result."""
    targets = lake.targets()
    for target in targets:
        target.read(spark).createOrReplaceTempView(target.name)
    return [t.name for t in targets]


def declare_tables(spark: SparkSession, lake: Lake, database: str = "default") -> list[str]:
    """Declare every table in the catalog, for whoever shares it; call again after a run to see its result."""
    return [declare(spark, target, database) for target in lake.targets()]
