"""SimHash near-dedup: fingerprints of word shingles, linked within a Hamming radius by BK-trees.

Two fingerprints that differ in at most ``radius`` bits agree in at least one of ``radius + 1``
blocks of bits, so each block's value makes a bucket and all links lie inside buckets. A bucket is a
shard: its fingerprints form a BK-tree, whose children are keyed by their integer Hamming distance
to the parent, and a search follows only the edges within the radius. A bucket that is too large
for one shard is split by the blocks of the bits that its fingerprints don't share; what is still
too large is dealt into shards, and each pair of shards is searched by one task, tree against
fingerprints. No shard is broadcast to the whole cluster, because their number grows with the data:
each goes to the tasks that search it. A task returns the links of a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import stored
from shedlake.llm.components import components

SHINGLE = 3  # words
RADIUS = 3  # bits
SEED = 42  # fixed value: the seed of the shingle hash
SHARD = 4096  # fingerprints in one tree
CHUNK = 1 << 16  # shingles whose bits are counted at once

_BITS = 64


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The majority bits of the hashes of all shingles, repeats included; no words give zero."""
    words = (text or "").encode().lower().split()  # both know ASCII only: A-Z, and white space
    if not words:
        return 0
    total, count = np.zeros(_BITS, np.int64), max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, count, CHUNK):
        part = words[start : start + CHUNK + shingle - 1]
        rows = zip(*(part[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
        hashes = np.array([digest(join(row), SEED) for row in rows], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * total > count))


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long; a null text has no words."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint_of(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return of(text)


class BKTree:
    """Fingerprints by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def near(self, value: int, radius: int) -> list[int]:
        """All members within the radius, found along the edges that can lead to one."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            member, children = open_nodes.pop()
            distance = (member ^ value).bit_count()
            if distance <= radius:
                found.append(member)
            if children:
                for edge in range(max(1, distance - radius), distance + radius + 1):
                    child = children.get(edge)
                    if child is not None:
                        open_nodes.append(child)
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        member, children = self.root
        while distance := (member ^ value).bit_count():
            child = children.get(distance)
            if child is None:
                children[distance] = (value, {})
                return
            member, children = child


def _spanning_links(own: list[int], others: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A forest that connects what the radius connects, in one shard or between two."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    tree = BKTree()
    for value in own:
        if not others:
            for near in tree.near(value, radius):
                if (a := root(near)) != (b := root(value)):
                    parent[b] = a
                    yield near, value
        tree.add(value)
    for value in others:
        for near in tree.near(value, radius):
            if (a := root(near)) != (b := root(value)):
                parent[b] = a
                yield near, value


def _search(radius: int):
    """Search shards that arrive as rows (task, side, print), sorted; yields (a, b) links."""

    def flush(own: list[int], others: list[int], pair: bool) -> list[tuple[int, int]]:
        return [] if pair and not (own and others) else list(_spanning_links(own, others, radius))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, sides, found = None, {0: [], 1: [], 2: []}, []
        for batch in batches:
            for t, side, value in zip(batch["task"].tolist(), batch["side"].tolist(), batch["print"].tolist(), strict=True):
                if t != task:
                    found += flush(sides[0], [], False) if sides[0] else flush(sides[1], sides[2], True)
                    task, sides = t, {0: [], 1: [], 2: []}
                sides[side].append(value & (2**64 - 1))
            yield _links(found)
            found = []
        yield _links(found + (flush(sides[0], [], False) if sides[0] else flush(sides[1], sides[2], True)))

    return search


def _links(pairs: list[tuple[int, int]]) -> pd.DataFrame:
    signed = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": signed[:, 0], "b": signed[:, 1]})


def _block(bits: Column, block: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, block * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _without(bits: Column, block: int, width: int) -> Column:
    """The bits outside the block, moved together."""
    low = bits.bitwiseAND(F.lit((1 << block * width) - 1).cast("long"))
    if (block + 1) * width >= _BITS:
        return low
    return F.shiftleft(F.shiftrightunsigned(bits, (block + 1) * width), block * width).bitwiseOR(low)


def _sized(rows: DataFrame, shard: int) -> tuple[DataFrame, DataFrame]:
    """Rows of buckets that fit one shard, and of those that don't, with the bucket's size.

    Buckets of one fingerprint hold no link and go.
    """
    sizes = rows.groupBy("task").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sized = stored(rows.join(sizes, "task"), "simhash-buckets")
    return sized.where(F.col("size") <= shard).drop("size"), sized.where(F.col("size") > shard)


def near_links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``radius`` bits of each other.

    ``prints`` has one row per distinct fingerprint (column ``print``). What is connected is exact;
    of the links among fingerprints that are connected anyway only a spanning part is returned.
    """
    blocks = radius + 1
    width = -(-_BITS // blocks)
    value = F.col("print")
    first = prints.select(
        value,
        F.posexplode(F.array(*[_block(value, b, width) for b in range(blocks)])).alias("block", "key"),
    ).select(value, "block", F.concat_ws("-", F.col("block"), F.col("key")).alias("task"))
    fits, large = _sized(first, shard)
    # Large buckets: the block's bits agree, so the radius must be met within the others.
    inner_width = -(-(_BITS - width) // blocks)
    inner = F.lit(None).cast("array<bigint>")
    for b in range(blocks):
        rest = _without(value, b, width)
        inner = F.when(F.col("block") == b, F.array(*[_block(rest, i, inner_width) for i in range(blocks)])).otherwise(inner)
    second = large.select(value, "task", F.posexplode(inner).alias("inner", "inner_key")).select(
        value, F.concat_ws("-", "task", F.col("inner"), F.col("inner_key")).alias("task")
    )
    fits_inner, dense = _sized(second, shard)
    # What is still large is dealt into shards; each pair of shards is a task.
    shards = F.ceil(F.col("size") / shard)
    own = F.pmod(F.xxhash64(value, "task"), shards)
    pairs = (
        dense.select(value, "task", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("other"))
        .select(
            value,
            F.concat_ws("-", "task", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        )
    )
    single = fits.select(value, "task", F.lit(0).alias("side")).unionByName(
        fits_inner.select(value, "task", F.lit(0).alias("side"))
    )
    tasks = single.unionByName(pairs)
    return (
        tasks.repartition("task")
        .sortWithinPartitions("task", "side", "print")
        .select("task", "side", "print")
        .mapInPandas(_search(radius), "a long, b long")
    )


def print_rows(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ``row`` (digest of the text) and ``print`` of every row, written once."""
    text = F.coalesce("text", F.lit(""))
    return stored(
        documents.select(
            "doc_id", F.md5(text.cast("binary")).alias("row"), fingerprint(F.col("text"), shingle).alias("print")
        ),
        "simhash-rows",
    )


def print_groups(rows: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """The group of each distinct fingerprint: ``print``, ``group_print``, ``component_id``.

    component_id is the smallest doc_id of the group, group_print the fingerprint that stands for it.
    """
    holders = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-prints")
    grouped = components(near_links(holders.select("print"), radius, shard))
    labelled = holders.join(grouped.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("group_print")
    )
    least = labelled.groupBy("group_print").agg(F.min("least").alias("component_id"))
    least = stored(least, "simhash-components")  # read back, so that the join below can be split at a large group
    return labelled.join(least, "group_print").select("print", "group_print", "component_id")


def simhash_dedup(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row of ``documents``.

    component_id is the smallest doc_id reachable over links, null where a group has no doc_id at
    all. Null and empty texts have fingerprint zero. Repeated rows come back repeated; further
    columns are ignored.
    """
    rows = print_rows(documents, shingle)
    return rows.join(print_groups(rows, radius, shard), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with all its columns.

    Rows that share that doc_id in one group are one document: of different texts the one with the
    smallest digest stays, of equal rows one. A group without any doc_id keeps one of its rows.
    """
    rows = print_rows(documents, shingle)
    kept = (
        rows.join(print_groups(rows, radius, shard), "print")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("group_print", F.col("doc_id").alias("kept_id"))
        .agg(F.min("row").alias("kept_row"))
        .select("kept_id", "kept_row")
    )
    source = documents.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"))
    keyed = source.select(
        F.col("doc_id").alias("own_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("own_row"), "whole"
    )
    chosen = keyed.join(
        kept, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_row") == F.col("kept_row"))
    ).dropDuplicates(["own_id", "own_row"])
    return chosen.select("whole.*")
