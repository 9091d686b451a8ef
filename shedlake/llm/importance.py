"""Importance resampling towards a target text, with hashed n-grams from running checksums.

A text is normalised to its words with one space before each, and scanned once: what is kept is the
running CRC-32 after every word. The CRC of a run of words follows from two of these, since the one
before the run, shifted over the run's length, cancels out: crc(run) = crc(up to its end) xor
shift(crc(up to its start), length). The shift is linear over GF(2), so shifts by powers of two are
tables, and any other is the composition of those of its binary digits.

Each run falls into the bucket that its CRC names. Documents weigh more, the more their buckets are
those of the target; of the weights with Gumbel noise, the largest are a draw without replacement.
"""

from __future__ import annotations

import hashlib
import math
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import stored

BUCKETS = 10_000
WORDS = (1, 1)  # words in a run, from and to
SEED = 2024
PERCENT = 10  # of the documents that are long enough
LEAST_WORDS = 20  # that a document must have to be drawn
_BATCH_WORDS = 500_000  # words whose runs are worked out at once

_KEPT = frozenset((string.digits + string.ascii_lowercase).encode())
_FOLDED = bytes(
    c + 32 if chr(c) in string.ascii_uppercase else c if c in _KEPT or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, a-z (A-Z lower-cased) and all beyond ASCII, as UTF-8; null has none."""
    return (text or "").encode().translate(_FOLDED).split()


def _zero_byte() -> np.ndarray:
    """Table of the step by one zero byte: what each of a register's low bytes turns into."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


def _shift_tables() -> Iterator[np.ndarray]:
    """Images of the four bytes of a register under 1, 2, 4, ... zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    # One step takes the lowest byte to the table's entry, and moves the others down.
    tables = np.stack([_zero_byte(), *(values << np.uint32(8 * place - 8) for place in range(1, 4))])
    while True:
        yield tables
        tables = _through(tables, tables)


def _through(tables: np.ndarray, registers: np.ndarray) -> np.ndarray:
    out = tables[0][registers & 0xFF]
    for place in range(1, 4):
        out = out ^ tables[place][(registers >> np.uint32(8 * place)) & 0xFF]
    return out


def shifted(registers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The registers after as many zero bytes as ``lengths`` tells."""
    out = registers.copy()
    for power, tables in zip(range(int(lengths.max(initial=0)).bit_length()), _shift_tables()):
        bit = (lengths >> power) & 1 == 1
        out[bit] = _through(tables, out[bit])
    return out


def running_crcs(words: Iterable[bytes]) -> Iterator[int]:
    """CRC of the normalised text up to the end of each word."""
    crc, crc32 = 0, zlib.crc32
    for word in words:
        crc = crc32(word, crc32(b" ", crc))
        yield crc


def run_crcs(ends: np.ndarray, sizes: np.ndarray, first: np.ndarray, last: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """CRCs of the runs of words ``first`` to ``last``, joined by one space.

    ``ends`` are the running CRCs of the words and ``sizes`` their bytes; ``opens`` marks words that
    begin a text.
    """
    before = np.where(opens, np.uint32(0), np.concatenate([np.zeros(1, np.uint32), ends[:-1]]))
    # One more space: the step of a single byte, on the complement that CRC-32 keeps in its register.
    register = ~before
    starts = ~(_zero_byte()[(register ^ np.uint32(0x20)) & 0xFF] ^ (register >> np.uint32(8)))
    upto = np.concatenate([[0], np.cumsum(sizes + 1)])
    lengths = upto[last + 1] - upto[first] - 1
    return ends[last] ^ shifted(starts[first], lengths)


def _bucketed(texts: list[list[bytes]], words: tuple[int, int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of some texts, one text after the other, and how many each text has."""
    counts = np.array([len(t) for t in texts], np.int64)
    total = int(counts.sum())
    ends = np.fromiter((c for t in texts for c in running_crcs(t)), np.uint32, total)
    sizes = np.fromiter((len(w) for t in texts for w in t), np.int64, total)
    begin = np.cumsum(counts) - counts
    opens = np.zeros(total, bool)
    opens[begin[counts > 0]] = True
    left = np.repeat(begin + counts, counts) - np.arange(total)  # words from here to the text's end
    every = np.arange(total)
    found, owner = [], []
    text = np.repeat(np.arange(len(texts)), counts)
    for size in range(words[0], words[1] + 1):
        first = every[left >= size]
        crcs = run_crcs(ends, sizes, first, first + size - 1, opens)
        found.append((crcs % np.uint32(buckets)).astype(np.int32))
        owner.append(text[first])
    found, owner = np.concatenate(found), np.concatenate(owner)
    if words[0] < words[1]:
        found = found[np.argsort(owner, kind="stable")]
    return found, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def features(documents: DataFrame, words: tuple[int, int] = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all runs of each row's text, from one scan."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, count, from_row = [], 0, 0
            for row in range(batch.num_rows):
                held.append(words_of(batch.column(1)[row].as_py()))
                count += len(held[-1])
                if count >= _BATCH_WORDS or row == batch.num_rows - 1:
                    found, sizes = _bucketed(held, words, buckets)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0)[from_row : row + 1],
                            pa.array([len(t) for t in held], pa.int64()),
                            pa.array(sizes),
                            pa.ListArray.from_arrays(offsets, pa.array(found)),
                        ],
                        ["doc_id", "n_words", "n_features", "buckets"],
                    )
                    held, count, from_row = [], 0, row + 1

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        told, f"doc_id {kind}, n_words long, n_features long, buckets array<int>"
    )


def _totals(found: DataFrame, buckets: int) -> list[int]:
    """Features per bucket, over all rows."""
    rows = found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    totals = [0] * buckets
    for r in rows.collect():  # a row per bucket at most
        totals[r.bucket] = r.n
    return totals


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of target to source in each bucket, smoothed, rounded down."""
    total_s, total_t, buckets = sum(source), sum(target), len(source)
    return [
        math.floor(1000 * math.log(float((t + 1) * (total_s + buckets)) / float((s + 1) * (total_t + buckets))))
        for s, t in zip(source, target, strict=True)
    ]


def noise(seed: int, doc_id: object) -> int:
    """Thousandths of a Gumbel number that only the seed and the id decide, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(found: DataFrame, of_bucket: list[int], seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score."""
    table = np.array(of_bucket, np.int64)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            offsets = lists.offsets.to_numpy()
            sums = np.concatenate([[0], np.cumsum(table[lists.flatten().to_numpy()])])
            weight = sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]]
            score = weight + np.array([noise(seed, d) for d in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weight), pa.array(score)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(told, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def resample(
    documents: DataFrame,
    target: DataFrame,
    words: tuple[int, int] = WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_features, weight, score, rank (null: not drawn).

    A text's words are runs of digits, a-z (A-Z lower-cased) and all beyond ASCII; its features all
    runs of ``words[0]`` to ``words[1]`` words, repeats counted. ``weight`` sums the gains of their
    buckets over the whole of both tables, ``score`` adds the noise. Of the N rows with at least
    ``least_words`` words, floor(percent * N / 100) are drawn, the highest scores first, ties to the
    smaller doc_id. Null and empty texts have no features, weigh 0 and are not drawn where words are
    asked for; texts of any length are scanned whole. Rows that share a doc_id share its noise and are
    drawn each for itself, a null id reads as empty in the noise and comes first in ties. An empty
    target leaves the smoothing alone; an empty table gives no rows. Further columns are ignored.

    Ranks need no task that sees all rows: these are dealt by ranges of (score, doc_id), and each
    range counts on from the sizes of those before it.
    """
    found = stored(features(documents, words, buckets), "features")
    of_bucket = gains(_totals(found, buckets), _totals(features(target.withColumn("doc_id", F.lit(0)), words, buckets), buckets))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        _weighed(found, of_bucket, seed).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "scores",
    )
    long_enough = F.col("n_words") >= least_words
    sizes = {r.part: r.n for r in ranged.where(long_enough).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted, before, starts = percent * sum(sizes.values()) // 100, 0, []
    for part in sorted(sizes):
        if before < wanted:  # a row per range at most
            starts.append((part, before))
        before += sizes[part]
    spark = documents.sparkSession
    offsets = spark.createDataFrame(starts, "range_part int, offset long")
    from_part = max((part for part, _ in starts), default=-1)
    near = long_enough & (F.col("part") <= from_part)
    numbered = ranged.where(near).withColumn(
        "within", F.expr("row_number() OVER (PARTITION BY part ORDER BY score DESC, doc_id ASC NULLS FIRST)")
    )
    rank = (F.col("offset") + F.col("within")).cast("long")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = numbered.join(F.broadcast(offsets), F.col("part") == F.col("range_part")).select(
        *columns, F.when(rank <= wanted, rank).alias("rank")
    )
    return ranked.unionByName(ranged.where(~near).select(*columns, F.lit(None).cast("long").alias("rank")))


def draw(documents: DataFrame, target: DataFrame, **options: object) -> DataFrame:
    """The drawn documents with all their columns. Rows under one doc_id come if one of them is drawn."""
    chosen = resample(documents, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("own_id")).distinct()
    whole = documents.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"))
    return whole.join(chosen, F.col("id").eqNullSafe(F.col("own_id")), "left_semi").select("whole.*")


def resample_query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns; null and empty texts, repeats and ties are as in ``resample``."""
    return resample(documents, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
