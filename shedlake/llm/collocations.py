"""Phrase collocation mining with stripes.

A stripe belongs to a prefix of words and counts the words that follow it. Tasks gather the stripes
of their texts, block by block, and stripes of one prefix are merged elementwise. Merged stripes tell
all that is needed: the counts of extensions (a phrase is its prefix and a word), the totals of prefixes
(the entry of the prefix itself in a shorter one's stripe; the empty prefix has all single words), and,
by the greatest extension on either side, which phrases a longer one takes in whole.

The stripe of a word that is a thousandth of all words or more is dealt out in parts, by the word that
follows, so that it is not one task's. Pairs are counted only of words that may be frequent, and longer
phrases only where all their pairs may be, which bit tables of fixed size tell: they err on one side
only, and the counts stay exact.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import stored

MOST_WORDS = 5  # words of a phrase
LEAST_COUNT = 100  # times that a phrase must occur
FIRST = 2000  # phrases told of each language
TABLE_BITS = 1 << 24  # of the tables of frequent words and pairs, 2 MB each
BLOCK_WORDS = 4_000_000  # words whose stripes a task gathers before it hands them over
PARTS = 64  # parts of a frequent word's stripe; the empty prefix's has PARTS * PARTS
HOT_SHARE = 1000  # a prefix is dealt out in parts from this fraction of all words on, so there are no more such words
SALTS = 64  # tasks that look for a language's first phrases

_BITS_OF_BUCKET = 32_768  # fixed value: bits in a bucket of Spark's bitmap functions
_SEPARATORS = ".,;:!?\n\x0b\x0c\r"
_FOLDED = bytes.maketrans(
    (string.ascii_uppercase + "\t" + _SEPARATORS).encode(), (string.ascii_lowercase + " " + "\n" * len(_SEPARATORS)).encode()
)
_BREAK = 0  # number of the piece border among words

STRIPE = "lang string, size int, prefix string, part int, next array<string>, n array<bigint>"


def tokens_of(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased, with a line feed for each piece border; may hold empty words."""
    return (text or "").encode().translate(_FOLDED).replace(b"\n", b" \n ").split(b" ")


class _Block:
    """Words of some texts as numbers, with a break between pieces."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known = defaultdict(count(2).__next__, {b"\n": _BREAK, b"": 1})
        self.numbers: dict[str, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, text: str | None) -> None:
        tokens = tokens_of(text)
        tokens.append(b"\n")
        numbers = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        self.numbers[lang].append(numbers[numbers != 1])
        self.size += len(tokens)

    def words(self) -> list[str]:
        return [w.decode() for w in self._ordered()]

    def _ordered(self) -> list[bytes]:
        out = [b""] * (len(self.known) + 2)
        for word, number in self.known.items():
            out[number] = word
        return out

    def hashes(self) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(w) for w in self._ordered()], np.uint64)


def _pair_bits(lang: str, left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each pair of words, from the words' hashes."""
    mixed = (left ^ np.uint64(xxhash.xxh64_intdigest(lang, seed=1))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) + right
    mixed = mixed * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(bits)).astype(np.int64)


def _within(table: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _part(words: np.ndarray, parts: int) -> np.ndarray:
    return (words % np.uint64(parts)).astype(np.int32)


def _stripes(lang: str, size: int, prefixes: pa.Array, parts: np.ndarray, next_: pa.Array, n: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """Stripes of entries that come sorted by ``keys``, which tell prefix and part."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    offsets = pa.array(np.concatenate([starts, [len(keys)]]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(starts), pa.string()),
            pa.array(np.full(len(starts), size), pa.int32()),
            prefixes.take(pa.array(starts)),
            pa.array(parts[starts], pa.int32()),
            pa.ListArray.from_arrays(offsets, next_),
            pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64())),
        ],
        ["lang", "size", "prefix", "part", "next", "n"],
    )


def _single_stripes(block: _Block) -> Iterator[pa.RecordBatch]:
    """Stripes of the empty prefix."""
    names, hashes = pa.array(block.words(), pa.string()), block.hashes()
    for lang, pieces in block.numbers.items():
        numbers = np.concatenate(pieces)
        numbers = numbers[numbers != _BREAK]
        if not len(numbers):
            continue
        counts = np.bincount(numbers, minlength=len(names))
        found = np.flatnonzero(counts)
        part = _part(hashes[found], PARTS * PARTS)
        order = np.argsort(part, kind="stable")
        found, part = found[order], part[order]
        empty = pa.array([""], pa.string()).take(pa.array(np.zeros(len(found), np.int64)))
        yield _stripes(lang, 1, empty, part, names.take(pa.array(found)), counts[found], part)
        # All words of the block, as the entry without a word.
        nothing = pa.array([""], pa.string()), np.zeros(1, np.int32), pa.array([None], pa.string())
        yield _stripes(lang, 1, *nothing, np.array([len(numbers)]), np.zeros(1))


def _pair_stripes(block: _Block, table: np.ndarray, hot: set[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """Stripes of the prefixes of one word, of words that may be frequent."""
    plain, hashes = block.words(), block.hashes()
    names = pa.array(plain, pa.string())
    by_part = np.argsort(_part(hashes, PARTS), kind="stable")
    rank = np.empty(len(plain), np.int64)  # sorts by part and word at once
    rank[by_part] = np.arange(len(plain))
    for lang, pieces in block.numbers.items():
        numbers = np.concatenate(pieces)
        often = _within(table, _pair_bits(lang, hashes, np.zeros_like(hashes), len(table) * 8))
        often[_BREAK] = False
        fits = often[numbers]
        both = fits[:-1] & fits[1:]
        left, right = numbers[:-1][both], numbers[1:][both]
        if not len(left):
            continue
        pairs, n = np.unique(left * len(plain) + rank[right], return_counts=True, sorted=True)
        left, right = pairs // len(plain), by_part[pairs % len(plain)]
        dealt = np.array([(lang, word) in hot for word in plain])
        part = np.where(dealt[left], _part(hashes[right], PARTS), 0).astype(np.int32)
        yield _stripes(lang, 2, names.take(pa.array(left)), part, names.take(pa.array(right)), n, left * PARTS + part)


def _long_stripes(block: _Block, most: int, table: np.ndarray, hot: set[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """Stripes of the prefixes of two words on, of phrases whose pairs are all in the table.

    Dealt out in parts are those of the pairs in ``hot``, and of what begins with one.
    """
    names, hashes, plain = None, block.hashes(), block.words()
    for lang, pieces in block.numbers.items():
        numbers = np.concatenate(pieces)
        if len(numbers) < 3:
            continue
        bit = _pair_bits(lang, hashes[numbers[:-1]], hashes[numbers[1:]], len(table) * 8)
        fits = _within(table, bit)
        fits &= (numbers[:-1] != _BREAK) & (numbers[1:] != _BREAK)
        names = names if names is not None else pa.array(plain, pa.string())
        prefix, at = numbers, np.arange(len(numbers))  # the number of the prefix at each place
        texts = plain
        for size in range(3, most + 1):
            at = at[at + size - 1 < len(numbers)]
            at = at[np.logical_and.reduce([fits[at + k] for k in range(size - 1)])]
            if not len(at):
                break
            # Prefixes of one word fewer get numbers: their own prefix's, and their last word's.
            keys = (prefix[at] if size > 3 else numbers[at]) * len(plain) + numbers[at + size - 2]
            distinct, inverse = np.unique(keys, return_inverse=True, sorted=True)
            before = distinct // len(plain)
            texts = [f"{texts[k]} {plain[w]}" for k, w in zip(before.tolist(), (distinct % len(plain)).tolist(), strict=True)]
            dealt = np.array([(lang, text) in hot for text in texts]) if size == 3 else dealt[before]
            last = numbers[at + size - 1]
            part = np.where(dealt[inverse], _part(hashes[last], PARTS), 0)
            entries, n = np.unique((inverse * PARTS + part) * len(plain) + last, return_counts=True, sorted=True)
            owner, last = entries // len(plain), entries % len(plain)
            prefixes = pa.array(texts, pa.string()).take(pa.array(owner // PARTS))
            yield _stripes(lang, size, prefixes, (owner % PARTS).astype(np.int32), names.take(pa.array(last)), n, owner)
            prefix = np.zeros(len(numbers), np.int64)
            prefix[at] = inverse


def _gathered(documents: DataFrame, told: object) -> DataFrame:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for row, lang in enumerate(langs):
                block.add(lang, batch.column(1)[row].as_py())
                if block.size >= BLOCK_WORDS:
                    yield from told(block)
                    block.clear()
        yield from told(block)

    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(gather, STRIPE)


def _merged(stripes: DataFrame, least_count: int) -> DataFrame:
    """(lang, size, prefix, next, n): merged elementwise, the frequent entries and those without a word."""
    parts = int(stripes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        stripes.repartition(parts, "lang", "size", "prefix", "part")
        .select("lang", "size", "prefix", "part", F.explode(F.arrays_zip("next", "n")).alias("e"))
        .groupBy("lang", "size", "prefix", "part", F.col("e.next").alias("next"))
        .agg(F.sum("e.n").alias("n"))
        .where((F.col("n") >= least_count) | F.col("next").isNull())
        .drop("part")
    )


def _bit_table(entries: DataFrame, bits: int) -> np.ndarray:
    """Bits of frequent words or pairs. The table has a fixed size, however many there are."""

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, prefix, next_ in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                words = (prefix, next_) if prefix else (next_, None)  # a word alone: paired with a hash of 0
                hashes = [np.array([0 if w is None else xxhash.xxh64_intdigest(w)], np.uint64) for w in words]
                out.append(int(_pair_bits(lang, *hashes, bits)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["bit"])

    found = entries.where("next IS NOT NULL").select("lang", "prefix", "next").mapInArrow(bits_of, "bit long")
    rows = found.groupBy(F.floor(F.col("bit") / _BITS_OF_BUCKET).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit") % _BITS_OF_BUCKET).alias("bits")
    )
    table = np.zeros(bits // 8, np.uint8)
    for r in rows.collect():  # bits / 32768 rows at most
        part = np.frombuffer(bytes(r.bits), np.uint8)
        table[r.bucket * len(part) : (r.bucket + 1) * len(part)] = part
    return table


def phrase_counts(
    documents: DataFrame, most_words: int = MOST_WORDS, least_count: int = LEAST_COUNT, table_bits: int = TABLE_BITS
) -> DataFrame:
    """(lang, size, prefix, next, n) of all phrases of up to ``most_words`` words that occur often enough.

    ``prefix`` is the phrase without its last word ``next``. A row with a null ``next`` has the count of
    all words of a language.
    """
    if table_bits % _BITS_OF_BUCKET:
        raise ValueError(f"table_bits must be a multiple of {_BITS_OF_BUCKET}")
    context = documents.sparkSession.sparkContext
    singles = stored(_merged(_gathered(documents, _single_stripes), least_count), "single-stripes")
    words = context.broadcast(_bit_table(singles, table_bits))
    total = singles.where("next IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("next").isNotNull() & (F.col("n") * HOT_SHARE >= total)
    # HOT_SHARE words at most, and as many pairs
    hot_words = {(r.lang, r.next) for r in singles.where(often).collect()}

    def pairs_told(block: _Block) -> Iterator[pa.RecordBatch]:
        return _pair_stripes(block, words.value, hot_words)

    pairs = stored(_merged(_gathered(documents, pairs_told), least_count), "pair-stripes")
    table = context.broadcast(_bit_table(pairs, table_bits))
    hot_pairs = {(r.lang, f"{r.prefix} {r.next}") for r in pairs.where(often).collect()}

    def longer_told(block: _Block) -> Iterator[pa.RecordBatch]:
        return _long_stripes(block, most_words, table.value, hot_pairs)

    longer = stored(_merged(_gathered(documents, longer_told), least_count), "long-stripes")
    return singles.unionByName(pairs).unionByName(longer)


def collocations(
    documents: DataFrame,
    most_words: int = MOST_WORDS,
    least_count: int = LEAST_COUNT,
    first: int | None = FIRST,
    table_bits: int = TABLE_BITS,
) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of 2 to ``most_words`` words that occur ``least_count`` times; the
    ``first`` of each language with their ``rank``, or all without one.

    Texts, A-Z lower-cased, fall into pieces at ``.,;:!?`` and line ends, and these into words at spaces
    and tabs. ``a`` counts a phrase within pieces, overlaps included, ``l`` and ``r`` its two parts at the cut
    that scores least (ties: the shortest first part), ``n`` all words of the language. The score is
    floor(1000 a n / (l r)), in decimals of 38 digits. A phrase inside a longer one that occurs as often
    is left out; it is enough to look at one more word on either side, as counts can't rise with length.
    A null lang is ``und``; null and empty texts have no words; repeated rows count repeatedly; texts of any
    length are read whole; an empty table gives no rows. Further columns are ignored.
    """
    found = stored(
        phrase_counts(documents, most_words, least_count, table_bits).select(
            "lang",
            "size",
            F.when(F.col("size") > 1, F.concat_ws(" ", "prefix", "next")).otherwise(F.col("next")).alias("phrase"),
            "n",
        ),
        "phrases",
    )
    totals = found.where("phrase IS NULL").select(F.col("lang").alias("of_lang"), F.col("n").alias("total"))
    counts = found.where("phrase IS NOT NULL")
    # The greatest extension of a phrase, to the right and to the left.
    words = F.split("phrase", " ")
    inner = F.explode(
        F.array(_joined(words, F.lit(1), F.col("size") - 1), _joined(words, F.lit(2), F.col("size") - 1))
    )
    extended = (
        counts.where("size > 2")
        .select("lang", inner.alias("inner"), "n")
        .groupBy(F.col("lang").alias("inner_lang"), "inner")
        .agg(F.max("n").alias("greatest"))
    )
    candidates = (
        counts.where("size > 1")
        .join(extended, (F.col("lang") == F.col("inner_lang")) & (F.col("phrase") == F.col("inner")), "left")
        .where(F.coalesce("greatest", F.lit(0)) < F.col("n"))
        .select("lang", "size", "phrase", F.col("n").alias("a"))
    )
    parts = counts.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("n").alias("of_part"))
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = cut.select("*", words.alias("w")).select(
        "lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), F.col("k")).alias("head"),
        _joined(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    for side, name in (("head", "l"), ("tail", "r")):
        sides = sides.join(parts, (F.col("lang") == F.col("part_lang")) & (F.col(side) == F.col("part"))).drop(
            "part_lang", "part", side
        ).withColumnRenamed("of_part", name)
    score = F.expr(
        "(CAST(a AS DECIMAL(18, 0)) * CAST(total AS DECIMAL(17, 0)) * 1000) div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))"
    )
    scored = (
        sides.join(totals, F.col("lang") == F.col("of_lang"))
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a", F.col("total").alias("n"))
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
        .select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score")
    )
    if first is None:
        return scored
    best = "ORDER BY score DESC, a DESC, phrase ASC"
    some = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn(
        "place", F.expr(f"row_number() OVER (PARTITION BY lang, salt {best})")
    )
    return (
        some.where(F.col("place") <= first)
        .withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {best})").cast("long"))
        .where(F.col("rank") <= first)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _joined(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")
