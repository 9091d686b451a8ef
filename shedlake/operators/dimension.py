"""Insert-only dimension: each member once, with an id that never changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.contracts import PROCESSING_TIME


def members(feeds: Sequence[DataFrame], key: str = "FARM_NO") -> DataFrame:
    """Distinct non-null key values over all feeds.

    Only the key column is read, and the distinct combines before its one shuffle, so a key with
    most of the rows costs no more than any other.
    """
    stacked = reduce(DataFrame.unionByName, (f.select(key) for f in feeds))
    return stacked.where(F.col(key).isNotNull()).dropDuplicates([key])


def new_members(candidates: DataFrame, current: DataFrame | None, key: str = "FARM_NO") -> DataFrame:
    """Candidates the dimension does not hold yet; all of them when there is no dimension yet."""
    return candidates if current is None else candidates.join(current.select(key), key, "left_anti")


def member_id(key: str, kind: str) -> Column:
    """Id that depends on the key alone, so a retried task or a second run gives the same one."""
    return F.md5(F.concat_ws("|", F.lit(kind), F.col(key).cast("string")))


def added_members(
    current: DataFrame | None,
    feeds: Sequence[DataFrame],
    key: str = "FARM_NO",
    kind: str = "farm",
    processing_time: Column | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """The members that the dimension does not hold yet, with their ids."""
    when = F.current_timestamp() if processing_time is None else processing_time
    ident = F.expr("uuid()") if random_ids else member_id(key, kind)
    return new_members(members(feeds, key), current, key).select(
        key, ident.alias("ID"), when.alias(PROCESSING_TIME)
    )


def maintain_dimension(
    current: DataFrame | None,
    feeds: Sequence[DataFrame],
    key: str = "FARM_NO",
    kind: str = "farm",
    processing_time: Column | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """The dimension with unseen members added; existing rows and ids are carried over as they are.

    ``random_ids`` draws ids instead of hashing them. Such a frame must be written before use:
    evaluating it twice gives different ids.
    """
    added = added_members(current, feeds, key, kind, processing_time, random_ids)
    return added if current is None else current.unionByName(added)
