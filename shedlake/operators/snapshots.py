"""Snapshot apply, snapshot diff and change feeds between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
CHANGE_COLUMNS = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)


def _row(values: Sequence[str]) -> Column:
    """The value columns as one struct, which is there even when a table is all keys."""
    return F.struct(*(values or [F.lit(True).alias("__present")]))


def _one_row_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], unique: bool, side: str) -> DataFrame:
    """Rows as (keys, struct of values); unless ``unique``, failing on a null or repeated key.

    The check groups by the join keys, so the join that follows reuses its shuffle, and a key
    repeated without bound is combined before it moves rather than multiplied by the join.
    """
    row = _row(values)
    if unique:
        return df.select(*keys, row.alias(side))
    return (
        df.groupBy(*keys)
        .agg(F.max(row).alias(side), F.count(F.lit(1)).alias("__rows"))
        .select(*keys, F.when(_fine(keys), F.col(side)).otherwise(_complaint(side)).alias(side))
    )


def _fine(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys), F.col("__rows") == 1)


def _complaint(side: str) -> Column:
    return F.raise_error(F.lit(f"{side} snapshot: null or repeated key"))


def _no_rows_or_error(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Keys of ``df`` that make a query fail: none, or an error. Counts keys by hash and sorts nothing."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.where(F.when(_fine(keys), False).otherwise(_complaint(side).cast("boolean"))).select(*keys)


def _pair(
    old: DataFrame, new: DataFrame, keys: Sequence[str], unique: bool | str, compare: Sequence[str] | None
) -> tuple[DataFrame, list[str], Column]:
    """Both versions side by side, the value columns, and the change label of a pair."""
    values = [c for c in new.columns if c not in keys]
    checked = [s for s in ("old", "new") if unique is False or unique in ("old", "new") and unique != s]
    # One side alone cannot multiply rows, so there the join need not wait for the check.
    first = len(checked) == 2
    pairs = _one_row_per_key(old, keys, values, not first, "old").join(
        _one_row_per_key(new, keys, values, not first, "new"), list(keys), "full_outer"
    )
    if len(checked) == 1:
        guard = _no_rows_or_error(old if checked == ["old"] else new, keys, checked[0])
        pairs = pairs.unionByName(guard, allowMissingColumns=True)
    same = reduce(
        lambda a, b: a & b,
        (F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in (values if compare is None else compare)),
        F.lit(True),
    )
    label = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(same, "unchanged")
        .otherwise("update")
    )
    return pairs, values, label


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    unique: bool | str = False,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Every key of either version, labelled insert, update, delete or unchanged.

    Value columns hold the new row, or the old one for a delete. ``compare`` limits which columns
    make a row count as updated. Pass ``unique=True`` when both sides are known to hold one row
    per non-null key, as the result of a grouping does, or the name of the side ("old" or "new") that
    is; otherwise that is checked.
    """
    pairs, values, label = _pair(old, new, keys, unique, compare)
    shown = F.coalesce("new", "old")
    return pairs.select(*keys, *(shown[c].alias(c) for c in values), label.alias(CHANGE_TYPE))


def snapshot_apply(
    current: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    unique: bool = False,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Type 1 target after a full snapshot: new keys in, changed rows replaced, missing keys out.

    A row whose compared columns did not change keeps its stored values, so columns left out of
    ``compare`` (an ingest time, a generated id) stay stable from run to run.
    """
    values = [c for c in snapshot.columns if c not in keys]
    if current is None or compare is None:
        rows = _one_row_per_key(snapshot, keys, values, unique, "new")
        return rows.select(*keys, *(F.col("new")[c].alias(c) for c in values))
    pairs, values, label = _pair(current, snapshot, keys, unique, compare)
    kept = F.when(label == "unchanged", F.col("old")).otherwise(F.col("new"))
    return pairs.where(F.col("new").isNotNull()).select(*keys, *(kept[c].alias(c) for c in values))


def change_feed(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    version: int | Column,
    timestamp: Column,
    unique: bool = False,
) -> DataFrame:
    """Row-level changes that turn ``old`` into ``new``; an update gives its pre and post image."""
    pairs, values, label = _pair(old, new, keys, unique, None)
    version = F.lit(version) if isinstance(version, int) else version
    return change_images(pairs.withColumn("label", label), keys, values, version, timestamp)


def change_images(
    pairs: DataFrame, keys: Sequence[str], values: Sequence[str], version: Column, timestamp: Column
) -> DataFrame:
    """Change rows of (keys, old, new, label): structs of the values, and what became of the key."""

    def image(side: str, kind: str) -> Column:
        return F.struct(F.col(side).alias("row"), F.lit(kind).alias("kind"))

    images = (
        F.when(F.col("label") == "insert", F.array(image("new", "insert")))
        .when(F.col("label") == "delete", F.array(image("old", "delete")))
        .otherwise(F.array(image("old", "update_preimage"), image("new", "update_postimage")))
    )
    return (
        pairs.where(F.col("label") != "unchanged")
        .select(*keys, version.cast("bigint").alias(COMMIT_VERSION), timestamp.alias(COMMIT_TIMESTAMP), F.explode(images).alias("image"))
        .select(
            *keys,
            *(F.col("image.row")[c].alias(c) for c in values),
            F.col("image.kind").alias(CHANGE_TYPE),
            COMMIT_VERSION,
            COMMIT_TIMESTAMP,
        )
    )


def collapse_change_feed(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current state of a change feed: the last image per key, without the deleted keys.

    Within one commit a delete loses against an insert or post image of the same key.
    """
    values = [c for c in feed.columns if c not in keys and c not in CHANGE_COLUMNS]
    survives = F.col(CHANGE_TYPE) != "delete"
    last = (
        feed.where(F.col(CHANGE_TYPE) != "update_preimage")
        .groupBy(*keys)
        .agg(
            F.max_by(
                F.struct(survives.alias("alive"), _row(values).alias("row")),
                F.struct(COMMIT_VERSION, survives),
            ).alias("last")
        )
    )
    return last.where("last.alive").select(*keys, *(F.col("last.row")[c].alias(c) for c in values))
