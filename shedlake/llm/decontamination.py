"""Benchmark decontamination by winnowing, on DataFrame functions alone.

A text becomes words, and every run of ``GRAM`` words a hash. Of each window of consecutive hashes,
which spans ``SPAN`` words, the least one is kept; neighbouring windows mostly keep the same, so few
are left. Equal spans of ``SPAN`` words keep equal hashes, so a join of the kept hashes of documents
and benchmark meets every shared span. Each hit is then extended to the spans whose least hash it
is, which are compared word by word. Benchmark items shorter than a span are single, shorter spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import ascii_lower, stored

SPAN = 10  # words
GRAM = 5  # words
BROADCAST_PRINTS = 1_000_000  # at most so many benchmark hashes are broadcast (16 bytes each)

# Fixed value: what separates words, all ASCII but digits and a-z.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN, -1), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def _up_to(count: Column) -> Column:
    """0 .. count - 1; empty if there are none."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _winnowed(hashes: Column, span: int, gram: int) -> Column:
    """Kept hashes as (span, hash, start, n): n spans from word ``start`` on keep this hash."""

    def runs(least: Column) -> Column:
        starts = F.filter(
            _up_to(F.size(least)),
            lambda i: (i == 0) | (F.get(least, i) != F.coalesce(F.get(least, i - 1), F.lit(0).cast("long"))),
        )
        return _let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, i: F.struct(
                    F.lit(span).alias("span"),
                    F.get(least, start).alias("hash"),
                    start.alias("start"),
                    (F.coalesce(F.get(s, i + 1), F.size(least)) - start).alias("n"),
                ),
            ),
        )

    def grams(words: Column) -> Column:
        return F.transform(_up_to(F.size(words) - (gram - 1)), lambda i: F.xxhash64(F.slice(words, i + 1, gram)))

    def least(prints: Column) -> Column:
        width = span - gram + 1
        return F.transform(_up_to(F.size(prints) - (width - 1)), lambda i: F.array_min(F.slice(prints, i + 1, width)))

    return _let(hashes, lambda words: _let(grams(words), lambda g: _let(least(g), runs)))


def _short(hashes: Column, length: int) -> Column:
    """All runs of ``length`` words, for benchmark items that are that short."""
    return _let(
        hashes,
        lambda words: F.transform(
            _up_to(F.size(words) - (length - 1)),
            lambda i: F.struct(
                F.lit(length).alias("span"),
                F.xxhash64(F.slice(words, i + 1, length)).alias("hash"),
                i.alias("start"),
                F.lit(1).alias("n"),
            ),
        ),
    )


def _prints(words: Column, span: int, gram: int, lengths: list[int]) -> Column:
    """Kept hashes of a word array: of full spans, and of the short lengths asked for."""
    kept = _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.concat(_winnowed(h, span, gram), *[_short(h, n) for n in lengths]),
    )
    return F.transform(
        kept,
        lambda p: F.struct(
            p["span"].alias("span"), p["hash"].alias("hash"), p["start"].alias("start"), p["n"].alias("n")
        ),
    )


def _span_text(words: Column, start: Column, span: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, span), " ")


def _benchmark_spans(benchmark: DataFrame, span: int) -> DataFrame:
    """(item, span, text) of every span of every item; an item with fewer words is one span."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    sized = items.withColumn("span", F.least(F.lit(span), F.size("words")))
    return (
        sized.select("item", "span", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("span"))).alias("start"))
        .select("item", "span", _span_text(F.col("words"), F.col("start"), F.col("span")).alias("text"))
        .distinct()
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    gram: int = GRAM,
    broadcast_prints: int = BROADCAST_PRINTS,
) -> DataFrame:
    """Per row of ``documents``: doc_id, row (digest of the text), n_words, n_hit, items, n_items, contaminated.

    Words are runs of digits, a-z (A-Z lower-cased) and all beyond ASCII. Every span of ``span``
    consecutive words of an item is looked for, of an item with fewer words all of it; items without
    words never occur. A word inside any occurrence is hit. ``items`` lists the item_ids that occur,
    as strings in order; a null item_id reads as the empty string, item rows with one id are one
    item. Null texts have no words; repeated rows come back repeated; an empty benchmark hits
    nothing. Further columns are ignored.
    """
    spans = stored(_benchmark_spans(benchmark, span), "benchmark-spans")
    lengths = [r.span for r in spans.where(F.col("span") < span).select("span").distinct().collect()]
    keys = (
        spans.select(F.explode(_prints(F.split("text", " "), span, gram, lengths)).alias("p"), F.col("span").alias("of"))
        .where("p.span = of")
        .select("p.span", "p.hash")
        .distinct()
    )
    # A row without a hash marks each document, so that one pass over the texts gives all.
    keys = stored(
        keys.unionByName(documents.sparkSession.sql("SELECT 0 AS span, 0L AS hash")), "benchmark-prints"
    )
    mark = F.array(
        F.struct(F.lit(0).alias("span"), F.lit(0).cast("long").alias("hash"), F.lit(0).alias("start"), F.lit(1).alias("n"))
    )
    worded = documents.select(
        "doc_id",
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("row"),
        words_of(F.col("text")).alias("words"),
    )
    printed = worded.select(
        "doc_id",
        "row",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.inline(_let(F.col("words"), lambda w: F.concat(mark, _prints(w, span, gram, lengths)))),
    )
    if keys.count() <= broadcast_prints:
        met = printed.join(F.broadcast(keys), ["span", "hash"], "left_semi")
    else:  # only hashes are shuffled; the words of documents with a hit join them again
        bare = stored(printed.drop("words").join(keys, ["span", "hash"], "left_semi"), "met-prints")
        again = worded.dropDuplicates(["doc_id", "row"]).select(
            F.col("doc_id").alias("own_id"), F.col("row").alias("own_row"), "words"
        )
        same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("row") == F.col("own_row")) & (F.col("span") > 0)
        met = bare.join(again, same, "left").drop("own_id", "own_row")
    found = stored(
        met.select("doc_id", "row", "n_words", "span", "words", F.explode(F.expr("sequence(start, start + n - 1)")).alias("start"))
        .select(
            "doc_id",
            "row",
            "n_words",
            "span",
            "start",
            F.when(F.col("span") > 0, _span_text(F.col("words"), F.col("start"), F.col("span"))).alias("text"),
        ),
        "met-spans",
    )
    # Items that share a set of spans are told apart once, not once per document and span.
    marked = spans.groupBy("text").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("item").cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64("item", F.lit(1)).cast("decimal(38,0)")).alias("b"),
    ).select("text", F.struct("n", "a", "b").alias("holders"))
    hits = stored(
        found.where("span > 0").select("doc_id", "row", "span", "start", "text").join(marked, "text").drop("text"),
        "span-hits",
    )
    items_of = spans.join(marked, "text").select("holders", "item").distinct()
    items = (
        hits.select("doc_id", "row", "holders")
        .distinct()
        .join(items_of, "holders")
        .groupBy("doc_id", "row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n")),
        lambda seen, s: F.struct(
            F.greatest(seen["until"], s["start"] + s["span"]).alias("until"),
            (seen["n"] + F.greatest(F.lit(0), s["start"] + s["span"] - F.greatest(s["start"], seen["until"]))).alias("n"),
        ),
        lambda seen: seen["n"],
    )
    reach = (
        hits.groupBy("doc_id", "row")
        .agg(F.collect_set(F.struct("start", "span")).alias("spans"))
        .select("doc_id", "row", covered.alias("n_hit"))
    )
    told = reach.join(items.withColumnsRenamed({"doc_id": "i", "row": "r"}), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("row") == F.col("r"))).select(
        F.col("doc_id").alias("hit_id"), F.col("row").alias("hit_row"), "n_hit", "items"
    )
    return (
        found.where("span = 0")
        .select("doc_id", "row", "n_words")
        .join(told, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row") == F.col("hit_row")), "left")
        .select(
            "doc_id",
            "row",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def contamination_query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, with a digest for the list of items."""
    return contamination(documents, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit word, with all their columns."""
    bad = contamination(documents, benchmark).where("contaminated").select(
        F.col("doc_id").alias("hit_id"), F.col("row").alias("hit_row")
    ).distinct()
    whole = documents.select(
        F.col("doc_id").alias("own_id"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("own_row"),
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"),
    )
    same = F.col("own_id").eqNullSafe(F.col("hit_id")) & (F.col("own_row") == F.col("hit_row"))
    return whole.join(bad, same, "left_anti").select("whole.*")
