"""Line dedup: levelled sorted runs of line hashes, on DataFrame functions alone.

Documents arrive in batches, the largest ids first. The index of lines seen is a set of *runs*:
tables of line hashes, sorted by hash. Each batch is merge-anti-joined with the runs; hashes that no
run has are first seen here and the batch's largest doc_id is their keeper, the others only add to
a count. What the batch found becomes a run of level 0, and two runs of a level are merged into one
of the next, so that the number of runs grows with the logarithm of the number of batches. A line
goes where its hash is in enough documents and the document isn't the hash's keeper.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import ascii_lower, stored

LEAST_POINTS = 40  # shorter keys are never dropped
LEAST_DOCUMENTS = 5
BATCHES = 4

# The white space that a key loses at its ends, as a Java pattern and as characters.
_ENDS = " \t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(_ENDS)))


@dataclass
class LineRuns:
    """The index: runs of (hash, n_documents, keeper) by level. A hash has one keeper in all runs."""

    runs: list[tuple[int, DataFrame]] = field(default_factory=list)

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-join a batch (hash, n_documents, keeper) with the runs and add it as a run."""
        fresh, again = batch, None
        for _, run in self.runs:
            seen = run.where("keeper IS NOT NULL").select("hash").hint("merge")
            held = fresh.join(seen, "hash", "left_semi")
            again = held if again is None else again.unionByName(held)
            fresh = fresh.join(seen, "hash", "left_anti")
        if again is not None:
            fresh = fresh.unionByName(again.withColumn("keeper", F.lit(None).cast(batch.schema["keeper"].dataType)))
        self.runs.append((0, _sorted_run(fresh)))
        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            (level, left), (_, right) = self.runs.pop(), self.runs.pop()
            self.runs.append((level + 1, _sorted_run(_merged(left.unionByName(right)))))

    def totals(self) -> DataFrame:
        """All hashes with their number of documents and keeper."""
        runs = [run for _, run in self.runs]
        if len(runs) == 1:
            return runs[0]
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return _merged(rows)


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hash").agg(F.sum("n_documents").alias("n_documents"), F.max("keeper").alias("keeper"))


def _sorted_run(rows: DataFrame) -> DataFrame:
    return stored(rows.sortWithinPartitions("hash"), "line-run")


def _occurrences(documents: DataFrame, least_points: int) -> DataFrame:
    """(doc_id, row, position, hash) of every line that is long enough to be dropped.

    ``row`` tells apart texts that share a doc_id; rows repeated as a whole are one.
    """
    rows = documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("row"), lines_of(F.col("text")).alias("lines"))
    return (
        rows.select("doc_id", "row", F.posexplode("lines").alias("position", "line"))
        .select("doc_id", "row", "position", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= least_points)
        .select("doc_id", "row", "position", F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash"))
    )


def _batch_of(occurrences: DataFrame, batches: int) -> DataFrame:
    """Number the batches by ranges of doc_id, the largest ids in batch 0; null ids come last."""
    low, high = occurrences.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return occurrences.withColumn("batch", F.lit(batches - 1))
    width = max(1, -(-(int(high) - int(low) + 1) // batches))
    # Compared with each border, as differences of ids may not fit a long nor their quotients a double.
    borders = [border for n in range(1, batches) if (border := int(high) - n * width) >= int(low)]
    number = sum(((F.col("doc_id") <= F.lit(border).cast("long")).cast("int") for border in borders), F.lit(0))
    number = F.when(F.col("doc_id").isNotNull(), number)
    return occurrences.withColumn("batch", F.coalesce(number, F.lit(batches - 1)))


def dedup_lines(
    documents: DataFrame,
    least_points: int = LEAST_POINTS,
    least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES,
    carry: str | None = None,
) -> DataFrame:
    """doc_id, text, n_lines, n_dropped and kept_text of every row of ``documents``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
    least ``least_points`` code points found in at least ``least_documents`` documents lose all
    their lines except in the largest doc_id that has them. A null or empty text is one empty line
    and stays empty. Rows that share a doc_id are one document; a null doc_id is one document below
    all others. Further columns are ignored, but for the one named ``carry``.
    """
    carried = [carry] if carry else []
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    found = stored(_occurrences(source, least_points), "line-occurrences")
    numbered = _batch_of(found, batches)
    index = LineRuns()
    for number in range(batches):
        batch = (
            numbered.where(F.col("batch") == number)
            .groupBy("hash", "doc_id")
            .agg(F.lit(1).alias("one"))
            .groupBy("hash")
            .agg(F.count(F.lit(1)).alias("n_documents"), F.max(F.coalesce("doc_id", _below())).alias("keeper"))
        )
        index.add(batch)
    often = index.totals().where(F.col("n_documents") >= least_documents).select("hash", "keeper")
    drops = (
        found.join(often, "hash")
        .where(F.coalesce("doc_id", _below()) < F.col("keeper"))
        .groupBy(F.col("doc_id").alias("drop_id"), F.col("row").alias("drop_row"))
        .agg(F.collect_set("position").alias("drops"))
    )
    rows = source.withColumn("row", F.md5(F.col("text").cast("binary"))).join(
        drops, F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("row") == F.col("drop_row")), "left"
    )
    lines = lines_of(F.col("text"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(staying, lambda i: F.get("lines", i)), "\n")
    )
    return rows.select("doc_id", "text", "drops", lines.alias("lines"), *carried).select(
        "doc_id",
        "text",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
        *carried,
    )


def without_repeated_lines(documents: DataFrame, **limits: int) -> DataFrame:
    """The documents with their kept lines as ``text`` and its length as ``n_chars``, all other columns as before.

    A null text stays null.
    """
    rest = [c for c in documents.columns if c not in ("doc_id", "text")]
    whole = documents.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("rest"))
    kept = dedup_lines(whole, **limits, carry="rest").withColumn(
        "text", F.when(F.col("text").isNotNull(), F.col("kept_text"))
    )
    columns = []
    for c in documents.columns:
        if c == "n_chars":
            kind = documents.schema[c].dataType
            columns.append(F.when(F.col("text").isNotNull(), F.char_length("text")).cast(kind).alias(c))
        else:
            columns.append(F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`"))
    return kept.select(*columns)


def _below() -> Column:
    """Stands for a null doc_id where ids are compared: less than any other."""
    return F.lit(-(2**63)).cast("long")


def dedup_query(documents: DataFrame) -> DataFrame:
    """The contract's digest of the kept lines, one row per document."""
    return dedup_lines(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
