import random

import numpy as np
import pytest
from odd import none_of, odd_documents
from pyspark.sql import functions as F
from shedlake.llm import mixing


def plain_targets(sizes):
    """Water filling round by round, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > 3 * sizes[s] + 1e-9]
        if not above:
            return {**full, **share}
        full.update({s: 3.0 * sizes[s] for s in above})


def random_documents(spark, seed, sources=7, count=300):
    chosen = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(sources)), "é", "Z"]
    bias = [chosen.random() ** 3 for _ in names]
    rows = [(i, " ".join(["w"] * int(chosen.paretovariate(0.8) * 5 % 3000)), chosen.choices(names, bias)[0]) for i in range(count)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def check(documents, **settings):
    rows = mixing.mix_query(documents, **settings).collect()
    texts = documents.select("text", "source").collect()
    sizes = {}
    for r in texts:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    targets = plain_targets(sizes)
    placed = mixing.mix_sources(documents, **settings)[0].select("doc_id", "source", "size", "source_size", "target").collect()
    for r in placed:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], abs=1e-6)
    assert len(rows) == len(texts)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    taken = {}
    for r in rows:
        key = (r.source_size, round(r.target, 3))
        taken[key] = taken.get(key, 0) + r.taken
    wanted = {}
    for s, t in targets.items():
        key = (sizes[s], round(t, 3))
        wanted[key] = wanted.get(key, 0) + round(t)
    assert {k: v for k, v in taken.items()} == {k: v for k, v in wanted.items() if k in taken}
    return rows


@pytest.mark.parametrize("seed,block,lane", [(1, 256, 20_000), (2, 16, 10), (3, 7, 1)])
def test_targets_are_met_to_the_word(spark, seed, block, lane):
    check(random_documents(spark, seed), block=block, lane=lane)


def test_one_source_and_tiny_sources(spark):
    check(spark.createDataFrame([(1, "a b c", "x"), (2, "a", "x")], "doc_id long, text string, source string"))
    check(spark.createDataFrame([(1, "a b c " * 900, "x"), (2, "a", "y"), (3, "", "z")], "doc_id long, text string, source string"))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    check(docs, block=64)
    assert mixing.mix_query(none_of(docs)).count() == 0
    empty_texts = docs.withColumn("text", F.lit(None).cast("string"))
    assert {(r.size, r.taken, r.target) for r in mixing.mix_query(empty_texts).collect()} == {(0, 0, 0.0)}


def test_reruns_agree_whatever_the_partitions(spark):
    docs = random_documents(spark, 5)
    first = sorted(map(tuple, mixing.mix_query(docs, block=32).collect()))
    assert sorted(map(tuple, mixing.mix_query(docs.repartition(5, "text"), block=32).collect())) == first


def test_permutation_is_one_and_goes_back():
    for size in (1, 2, 3, 5, 16, 17, 1000, 4096, 5001):
        index, sizes, key = np.arange(size), np.full(size, size), np.full(size, 99)
        there = mixing.permuted(index, sizes, key)
        assert sorted(there) == list(range(size))
        assert (mixing.permuted(there, sizes, key, back=True) == index).all()
    a, b = (mixing.permuted(np.arange(500), np.full(500, 500), np.full(500, k)) for k in (1, 2))
    assert (a != b).mean() > 0.9


def test_slots_hold_blocks_and_shards_mix(spark):
    docs = random_documents(spark, 6)
    placed, mix = mixing.mix_sources(docs, block=32, shard_slots=20)
    texts = mixing.slot_texts(docs, placed, mix).collect()
    assert all(0 < len(r.text.split()) <= 32 for r in texts)
    assert len({(r.shard, r.slot) for r in texts}) == len(texts)
    assert sum(len(r.text.split()) for r in texts) == mix.agg(F.sum("n_words")).first()[0]
    shards = mix.select("shard", "slot", "number").distinct().groupBy("shard").agg(F.countDistinct("number").alias("n"))
    assert shards.agg(F.avg("n")).first()[0] > 1.5


@pytest.mark.parametrize("totals,size", [([5000, 300, 0, 17], 100), ([1], 7), ([1000, 1000, 1000], 1), ([10**7, 10**6], 999)])
def test_shard_counts_sum_to_the_totals(totals, size):
    draw = mixing.ShardDraw(totals, size, 3)
    shards = range(draw.shards) if draw.shards < 5000 else range(200)
    at = [0] * len(totals)
    for shard in shards:
        first, counts = draw.of(shard)
        assert first == at and sum(counts) == min(size, draw.slots - shard * size)
        at = [a + c for a, c in zip(at, counts, strict=True)]
    assert draw.shards >= 5000 or at == totals
    again = mixing.ShardDraw(totals, size, 3)
    assert again.of(draw.shards - 1) == draw.of(draw.shards - 1)  # a shard on its own


def test_shard_counts_are_a_multinomial_draw():
    """Mean and variance of a source's slots per shard, also where totals pass what numpy draws exactly."""
    for scale in (1, 10**8):
        draw = mixing.ShardDraw([300_000 * scale, 100_000 * scale], 400, 5)
        counts = np.array([draw.of(s)[1][0] for s in range(0, draw.shards, draw.shards // 900)])
        assert abs(counts.mean() - 300) < 1.5 and 60 < counts.var() < 90  # 400 * 0.75 * 0.25 = 75
    assert mixing.ShardDraw([5, 7], 4, 1).of(1) != mixing.ShardDraw([5000, 7000], 4000, 2).of(1)
