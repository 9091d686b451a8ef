"""Running checksums against zlib, and the draw against a plain restatement of the contract."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import none_of, odd_documents
from shedlake.llm.common import load
from shedlake.llm.importance import _bucketed, draw, resample, resample_query, shifted, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_runs(text, sizes):
    words = plain_words(text)
    return [" ".join(words[i : i + n]).encode() for n in range(sizes[0], sizes[1] + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, sizes=(1, 1), buckets=10_000, least=20, percent=10):
    source, goal = Counter(), Counter()
    for _, text in rows:
        source.update(zlib.crc32(r) % buckets for r in plain_runs(text, sizes))
    for text in target:
        goal.update(zlib.crc32(r) % buckets for r in plain_runs(text, sizes))
    S, T = source.total(), goal.total()
    out = []
    for doc_id, text in rows:
        runs = plain_runs(text, sizes)
        weight = 0
        for b in (zlib.crc32(r) % buckets for r in runs):
            weight += math.floor(1000 * math.log((goal[b] + 1) * (S + buckets) / ((source[b] + 1) * (T + buckets))))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(runs), weight, score, None, len(plain_words(text)) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for n, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in out), key=str)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_words(text):
    assert [w.decode() for w in words_of(text)] == plain_words(text)


@given(st.binary(max_size=40), st.binary(max_size=300))
@settings(max_examples=200, deadline=None)
def test_a_shift_cancels_what_is_before(a, b):
    before = np.array([zlib.crc32(a)], np.uint32)
    assert zlib.crc32(a + b) ^ int(shifted(before, np.array([len(b)]))[0]) == zlib.crc32(b)


@pytest.mark.parametrize("sizes", [(1, 1), (1, 3), (2, 2), (4, 5)])
def test_buckets_of_all_runs(sizes):
    texts = ["", "one", "a b c d e f", "x " * 50, "é 漢字 long-" + "z" * 5000 + " end", "one two"]
    found, counts = _bucketed([words_of(t) for t in texts], sizes, 997)
    ends = np.cumsum(counts)
    for text, a, z in zip(texts, ends - counts, ends, strict=True):
        assert found[a:z].tolist() == [zlib.crc32(r) % 997 for r in plain_runs(text, sizes)]


def test_odd_rows_follow_the_contract(spark, sf_dir):
    docs, bench = odd_documents(spark), load(spark, sf_dir, "benchmark")
    found = resample_query(docs, bench).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(pairs(docs), [r.text for r in bench.collect()])


def test_longer_runs_and_many_draws(spark, sf_dir):
    docs, bench = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    found = resample(docs, bench, words=(1, 3), buckets=500, percent=60).drop("n_words").collect()
    wanted = plain(pairs(docs), [r.text for r in bench.collect()], (1, 3), 500, percent=60)
    assert sorted((tuple(r) for r in found), key=str) == wanted


def test_ties_go_to_the_smaller_id_and_all_can_be_drawn(spark, sf_dir):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text)] * 3 + [(4, text)] * 2 + [(None, text)], "doc_id long, text string")
    target = spark.createDataFrame([("w1 w2",)], "text string")
    rows = resample(docs, target, percent=100).collect()
    assert sorted(r.rank for r in rows) == [1, 2, 3, 4, 5, 6]
    for a in rows:
        for b in rows:
            if a.rank < b.rank:
                assert (-a.score, a.doc_id is not None, a.doc_id or 0) <= (-b.score, b.doc_id is not None, b.doc_id or 0)


def test_empty_tables(spark, sf_dir):
    docs, bench = odd_documents(spark), load(spark, sf_dir, "benchmark")
    assert resample_query(none_of(docs), bench).count() == 0
    found = resample_query(docs, none_of(bench)).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(pairs(docs), [])


def test_drawn_rows_keep_their_columns(spark, sf_dir):
    docs, bench = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    drawn = draw(docs, bench)
    assert drawn.dtypes == docs.dtypes
    ranks = resample_query(docs, bench).where("rank IS NOT NULL")
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in ranks.collect()}
