"""Mixing sources to target weights: fixed-length blocks, drawn per output shard, joined by index.

The words of a source are one stream, cut into blocks of ``block`` words whatever the document
boundaries. A source's slots run through its blocks in epochs, each in the order of a pseudorandom
permutation of block indices, keyed by source and epoch; the last epoch stops when the target is
reached. How many slots each source has in an output shard is a multinomial draw, given the totals: all
shards are halved again and again, and each half's counts are drawn from those of the whole, with
random numbers that only the half decides. So the counts vary per shard, their sums do not miss the
targets, and a task finds the counts of its shards, and which of the sources' slots they are, from the
totals alone. The slots of a shard are filled with the sources' next blocks, joined by index, in an order
that a permutation per shard gives. Nothing but row counts and sums is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shedlake.llm.common import stored

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3  # a source fills at most so many times its own size
BLOCK = 256  # words
SHARD_SLOTS = 1024  # blocks of an output shard
LANE = 4_000  # documents that one task numbers one after the other, on average
SEED = 11
MOST_SOURCES = 100_000  # a task holds a few numbers for each source while it draws
_EXACT = 10**9  # totals up to here are drawn by numpy, which takes no larger ones

_ROUNDS = 4


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, the same way each time."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Where a keyed permutation of 0 .. size - 1 takes each index; ``back`` undoes it.

    A balanced Feistel network over the next even number of bits, applied again to what falls
    outside the size: a permutation in constant memory, at most four times as large as needed.
    """
    index, size, key = (np.asarray(x).astype(np.uint64) for x in (index, size, key))
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(float))) + 1) // 2).astype(np.uint64)
    bits += (size > (np.uint64(1) << (np.uint64(2) * bits))).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    value, todo = index.copy(), np.arange(len(index))
    while len(todo):
        b, m, k = bits[todo], mask[todo], key[todo]
        left, right = value[todo] >> b, value[todo] & m
        for n in range(_ROUNDS):
            turn = np.uint64((_ROUNDS - 1 - n if back else n) * 0x9E3779B97F4A7C15 % 2**64)
            if back:
                left, right = right ^ (_mixed(left ^ _mixed(k ^ turn)) & m), left
            else:
                left, right = right, left ^ (_mixed(right ^ _mixed(k ^ turn)) & m)
        value[todo] = (left << b) | right
        todo = todo[value[todo] >= size[todo]]
    return value.astype(np.int64)


def _permutation(index: Column, size: Column, key: Column, back: bool = False) -> Column:
    @F.pandas_udf("long")
    def of(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), size.to_numpy(), key.to_numpy(), back))

    return of(index.cast("long"), size.cast("long"), key.cast("long"))


def word_count(text: Column) -> Column:
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:  # bytes know ASCII white space only
            yield pd.Series([0 if t is None else len(t.encode().split()) for t in texts], dtype="int64")

    return count(text)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """One row per source: number, size, documents and target in words.

    Sources take the weights in turn, in code point order, null last. All sizes are shared by weight;
    a target stops at ``most_times`` its source's size, and what is above goes to the others by weight.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_documents"))
        .withColumn("number", F.row_number().over(everything) - 1)
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("number") % len(weights)))
        .withColumn("most", F.col("source_size") * float(most_times))
        .withColumn("full_at", F.col("most") / F.col("weight"))
    )
    # The share per weight rises until all is dealt out; sources fill up in the order of full_at.
    order = Window.orderBy("full_at", "number")
    levels = (
        sources.withColumn("place", F.row_number().over(order))
        .withColumn("filled", F.sum("most").over(order) - F.col("most"))
        .withColumn("open_weight", F.sum("weight").over(Window.orderBy(F.desc("full_at"), F.desc("number"))))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") - F.col("filled")) / F.col("open_weight"))
    )
    first_open = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("place", "level"))).over(Window.partitionBy())
    return levels.withColumn("share", first_open["level"]).select(
        "source",
        "number",
        "source_size",
        "n_documents",
        F.coalesce(F.least(F.col("most"), F.col("share") * F.col("weight")), F.col("most")).alias("target"),
    )


def _planned(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Blocks, epochs and slots of each source, and where its slots begin among all."""
    key = F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull(), F.col("epochs"))
    last = F.col("blocks") - 1
    # Words of the last epoch before slot t: block * t, less what the short last block lacks once it is past.
    lacks = F.col("blocks") * block - F.col("source_size")
    plain = F.ceil(F.col("rest") / block)
    return (
        sources.where("source_size > 0")
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("epochs", F.expr("words div source_size"))
        .withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
        .withColumn("short_at", _permutation(last, F.col("blocks"), key, back=True))
        .withColumn("lacks", lacks)
        .withColumn("tail", F.when(F.col("short_at") < plain, F.ceil((F.col("rest") + lacks) / block)).otherwise(plain))
        .withColumn("slots", F.col("epochs") * F.col("blocks") + F.col("tail"))
    )


def _drawn(random: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` slots, drawn from ``good`` and ``bad`` ones without replacement, are good.

    Beyond ``_EXACT`` slots by the normal distribution with the same mean and variance.
    """
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    total = good + bad
    if total < _EXACT:
        return int(random.hypergeometric(good, bad, sample))
    share = good / total
    spread = (sample * share * (1 - share) * ((total - sample) / (total - 1))) ** 0.5
    return min(high, max(low, round(random.normal(sample * share, spread))))


class ShardDraw:
    """Slots of each source in each output shard: a multinomial draw given the totals."""

    def __init__(self, totals: list[int], shard_slots: int, seed: int) -> None:
        self.totals, self.shard_slots, self.seed = totals, shard_slots, seed
        self.slots = sum(totals)
        self.shards = -(-self.slots // shard_slots)
        self.known: dict[tuple[int, int], tuple[list[int], list[int]]] = {}

    def _half(self, low: int, high: int, counts: list[int]) -> list[int]:
        """The counts of the first half of the shards from ``low`` to ``high``."""
        random = np.random.default_rng([self.seed, low, high])
        middle = (low + high) // 2
        sample, rest, out = (middle - low) * self.shard_slots, sum(counts), []
        for count in counts:
            rest -= count
            out.append(_drawn(random, count, rest, sample))
            sample -= out[-1]
        return out

    def of(self, shard: int) -> tuple[list[int], list[int]]:
        """For each source, the first of its slots in the shard and how many they are."""
        low, high, first, counts = 0, self.shards, [0] * len(self.totals), self.totals
        while high - low > 1:
            middle = (low + high) // 2
            half = self.known.get((low, high))
            if half is None:
                if len(self.known) * len(counts) > 1_000_000:
                    self.known.clear()
                half = self.known[low, high] = self._half(low, high, counts)
            if shard < middle:
                high, counts = middle, half
            else:
                first = [f + h for f, h in zip(first, half, strict=True)]
                low, counts = middle, [c - h for c, h in zip(counts, half, strict=True)]
        return first, counts


def _slots(planned: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """(number, block, take, shard, slot): the first ``take`` words of a block go to an output slot."""
    sources = planned.select("number", "slots").orderBy("number").limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    numbers, totals = [r.number for r in sources], [r.slots for r in sources]
    spark = planned.sparkSession

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards, rows = ShardDraw(totals, shard_slots, seed), []
        for batch in batches:
            for shard in batch["id"].tolist():
                at, (first, counts) = 0, shards.of(shard)
                for number, start, count in zip(numbers, first, counts, strict=True):
                    if count:
                        rows.append((shard, number, start, count, at))
                        at += count
            yield pd.DataFrame(rows, columns=["shard", "n", "start", "count", "at"])
            rows = []

    drawn = spark.range(-(-sum(totals) // shard_slots)).mapInPandas(
        draw, "shard long, n int, start long, count long, at long"
    )
    filled = F.least(F.lit(shard_slots), F.lit(sum(totals)) - F.col("shard") * shard_slots)
    each = (
        drawn.select("*", filled.alias("filled"), F.posexplode(F.expr("sequence(start, start + count - 1)")).alias("nth", "t"))
        .join(F.broadcast(planned), F.col("n") == F.col("number"))  # MOST_SOURCES rows at most; the other side is large
        .withColumn("epoch", F.expr("t div blocks"))
        .withColumn("step", F.col("t") % F.col("blocks"))
    )
    key = F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull(), F.col("epoch"))
    before = F.col("step") * block - F.when(F.col("step") > F.col("short_at"), F.col("lacks")).otherwise(0)
    take = F.when(F.col("epoch") < F.col("epochs"), F.lit(block)).otherwise(
        F.least(F.lit(block), F.col("rest") - before)
    )
    return each.select(
        "number",
        _permutation(F.col("step"), F.col("blocks"), key).alias("block"),
        take.alias("take"),
        "shard",
        _permutation(F.col("at") + F.col("nth"), F.col("filled"), F.xxhash64(F.lit(seed), "shard")).alias("slot"),
    )


def _placed(sized: DataFrame, sources: DataFrame, lane: int) -> DataFrame:
    """Each document's first word in the stream of its source, without numbering a source in one task."""
    known = sources.withColumnRenamed("source", "of")
    laned = (
        sized.join(known, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("lane", F.pmod(F.xxhash64("doc_id", "row"), F.ceil(F.col("n_documents") / lane)))
    )
    ends = Window.partitionBy("number", "lane").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    within = laned.withColumn("start", F.sum("size").over(ends) - F.col("size"))
    lanes = laned.groupBy("number", "lane").agg(F.sum("size").alias("lane_size"))
    before = F.sum("lane_size").over(Window.partitionBy("number").orderBy("lane")) - F.col("lane_size")
    offsets = lanes.select("number", "lane", before.alias("lane_start"))
    return (
        within.join(offsets, ["number", "lane"])
        .withColumn("start", F.col("start") + F.col("lane_start"))
        .select("doc_id", "row", "source", "number", "size", "source_size", "target", "start")
    )


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    lane: int = LANE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents with size, source_size, target and start, and the mix as spans of their words.

    The second frame has a row for each piece of a document in a slot: shard, slot, ``at`` (its place
    in the slot), number and start (which name the document), first_word and n_words. Sizes count
    words between ASCII white space; null texts have none. A null source is a source of its own and
    the last. Repeated rows are documents of their own. Further columns are ignored; an empty table
    gives no rows. The same rows give the same mix.
    """
    sized = stored(
        documents.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("row"),
            word_count(F.col("text")).alias("size"),
        ),
        "mix-sizes",
    )
    sources = stored(source_targets(sized, weights, most_times), "mix-sources")
    placed = stored(_placed(sized, sources, lane), "mix-places")
    slots = _slots(stored(_planned(sources, block, seed), "mix-plan"), block, shard_slots, seed)
    pieces = (
        placed.where("size > 0")
        .select("number", "start", "size", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"))
        .withColumn("at", F.greatest(F.lit(0).cast("long"), F.col("start") - F.col("block") * block))
        .withColumn("until", F.least(F.lit(block).cast("long"), F.col("start") + F.col("size") - F.col("block") * block))
    )
    mix = (
        pieces.join(slots.hint("merge"), ["number", "block"])  # made from a tiny table, but as many as blocks
        .withColumn("n_words", F.least("until", "take") - F.col("at"))
        .where("n_words > 0")
        .select(
            "shard",
            "slot",
            "at",
            "number",
            "start",
            (F.col("block") * block + F.col("at") - F.col("start")).alias("first_word"),
            "n_words",
        )
    )
    return placed, mix


def slot_texts(documents: DataFrame, placed: DataFrame, mix: DataFrame) -> DataFrame:
    """(shard, slot, text): the words of each output slot, joined by one space."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, first: pd.Series, count: pd.Series) -> pd.Series:
        words = (t.encode().split()[f : f + n] for t, f, n in zip(texts, first, count, strict=True))
        return pd.Series([b" ".join(w).decode() for w in words], dtype="object")

    texts = documents.select(
        F.col("doc_id").alias("own_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("own_row"), "text"
    ).dropDuplicates(["own_id", "own_row"])
    named = mix.hint("merge").join(placed.where("size > 0").select("number", "start", "doc_id", "row"), ["number", "start"])
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("row") == F.col("own_row"))
    parts = named.join(texts, same).select("shard", "slot", "at", cut("text", "first_word", "n_words").alias("part"))
    joined = F.array_sort(F.collect_list(F.struct("at", "part")))
    return (
        parts.groupBy("shard", "slot")  # a block's words at most
        .agg(F.array_join(F.transform(joined, lambda p: p["part"]), " ").alias("text"))
    )


def mix_query(documents: DataFrame, **settings: int) -> DataFrame:
    """The contract's columns: what the mix takes of each document."""
    placed, mix = mix_sources(documents, **settings)
    taken = mix.groupBy(F.col("number").alias("n"), F.col("start").alias("s")).agg(F.sum("n_words").alias("taken"))
    same = (F.col("number") == F.col("n")) & (F.col("start") == F.col("s")) & (F.col("size") > 0)
    return placed.join(taken.hint("merge"), same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
