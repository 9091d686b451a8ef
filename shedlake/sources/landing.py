"""Incremental ingest of a landing folder of CSV files.

The stream carries the *names* of new files, which the checkpoint hands out exactly once; each
micro-batch then reads those files as one ordinary batch. This is what lets every file bring its
own header: a streaming CSV scan would map columns by position.
"""

from __future__ import annotations

import csv
import json
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import OPERATIONAL, FeedContract
from shedlake.functions.columns import fitted, quoted, stamp_operational
from shedlake.functions.headers import sanitize_headers
from shedlake.functions.rescue import CORRUPT, rescue
from shedlake.session import scratch_dir
from shedlake.sources.paths import first_line, glob, literal, put_text

FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"
# The file source forgets files that are this much older than the newest one, and then ignores them;
# a restored backup or a copy that keeps times must not be lost. The price is that the stream's log
# keeps the name of every file it has seen.
NEVER_TOO_OLD = "36500d"
IN_FILE = "_in_file"
OPEN_FILES = 16  # files whose first lines are read at once
# Candidate types of a column, the narrowest first, each a bit of a cell's mask; text is what is left.
INFERRED_TYPES = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean")
BIT = {kind: 1 << i for i, kind in enumerate(INFERRED_TYPES)}
WHOLE_NUMBER = r"^\s*[+-]?\d{1,38}\s*$"
PLAIN_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
# What a cell must look like for a cast to succeed; the cast itself decides. Spark trims the first set
# of characters around whole numbers and times, and the second one around doubles.
_TRIMMED, _BLANK = r"[\x00-\x20\x7f]*+", r"[\x00-\x20]*+"
LIKE_LONG = rf"^{_TRIMMED}[+-]?0*\d{{1,19}}{_TRIMMED}$"
LIKE_DOUBLE = (
    rf"^{_BLANK}[+-]?(?:(?:\d++(?:\.\d*+)?|\.\d++)(?:[eE][+-]?\d++)?[fFdD]?"
    rf"|0[xX][0-9a-fA-F]*+(?:\.[0-9a-fA-F]*+)?[pP][+-]?\d++[fFdD]?|(?i:inf|infinity|nan)){_BLANK}$"
)
LIKE_TIME = rf"^(?:{_TRIMMED}(?:[+-]?(?:\d{{4,5}}|[0-2]\d{{5}})(?:-|{_TRIMMED}$)|\d{{1,2}}:)|T\d)"
# Numbers whose types follow from their looks alone.
PLAIN_WHOLE = r"^\d{1,18}\z"
PLAIN_FRACTION = r"^\d+\.\d+\z"


def new_files_stream(
    spark: SparkSession,
    directory: str,
    glob: str,
    max_files: int = 5,
    clean_source: bool = False,
) -> DataFrame:
    """Stream of (path, length) of the files that match ``glob``, at most ``max_files`` per batch.

    Folders below ``directory`` are searched too. The file content is never read: only the
    selected columns of the listing are. A file counts as new by its name, however old it is. With ``clean_source`` Spark deletes the files of a batch
    once a later batch has been committed.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", NEVER_TOO_OLD)
    )
    if clean_source:
        reader = reader.option("cleanSource", "delete")
    return reader.load(directory).select("path", "length")


def header_groups(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header. Of each file only its first line is read, and no job is run.

    Files without a line are in no group. The paths are those of one batch, so there are not many.
    """
    groups = defaultdict(list)
    with ThreadPoolExecutor(OPEN_FILES) as pool:
        for path, line in zip(paths, pool.map(lambda p: first_line(spark, p), paths), strict=True):
            if line is not None:
                groups[header_names(line)].append(path)
    return dict(sorted(groups.items(), key=lambda group: group[1]))


class HeaderBook:
    """Headers that the files of a stream have come under, kept beside it.

    As long as there has been one header only, the next batch is read under it with header checking
    on, and no file is looked at beforehand. Once there are several, the first lines of a batch's files
    are read, as they are where the check fails.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        kept = (first_line(spark, path) for path in glob(spark, f"{folder}/*.json"))
        self.known = {tuple(header) for line in kept for header in json.loads(line)}

    def learn(self, headers: Iterable[tuple[str, ...]], batch_id: int) -> None:
        fresh = sorted(set(headers) - self.known)
        if fresh:
            put_text(self.spark, self.folder, f"{batch_id}.json", json.dumps(fresh))
            self.known.update(fresh)

    def expected(self) -> tuple[str, ...] | None:
        """The one header so far, if Spark's check takes it as it stands in the files."""
        if len(self.known) != 1:
            return None
        (header,) = self.known
        as_is = all(c == c.strip() and c.lower() not in (*OPERATIONAL, CORRUPT) for c in header)
        return header if as_is else None


def header_mismatch(error: Exception) -> bool:
    """Whether Spark's check of CSV headers has failed, in whatever task or write."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if "CSV header" in cause.toString():
            return True
        cause = cause.getCause()
    return "CSV header" in str(error)


def header_names(line: str) -> tuple[str, ...]:
    """Column names of a header line: unnamed ones get their position, and so do repeated ones."""
    cells = [c.strip() for c in next(csv.reader([line.removeprefix("\ufeff")], skipinitialspace=True), [])]
    lower = [c.lower() for c in cells]
    return tuple(
        f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)
    )


def _set_apart(header: Sequence[str]) -> list[str]:
    return [c + IN_FILE if c.lower() in (*OPERATIONAL, CORRUPT) else c for c in header]


def column_names(spark: SparkSession, header: Sequence[str]) -> list[str]:
    """The names that ``read_csv_group`` gives to the columns of a header."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _set_apart(header)])
    return sanitize_headers(spark.createDataFrame([], schema)).columns


def read_csv_group(
    spark: SparkSession, header: Sequence[str], paths: Sequence[str], checked: bool = False
) -> DataFrame:
    """All values of files that share one header, as text, with cleaned column names.

    If ``checked``, reading fails on a file with another header, letter case aside (``header_mismatch``).

    Records with more fields than the header keep their whole line in an extra column; a record
    with fewer fields has nulls and loses nothing. A header that is the name of an operational
    column, or of that extra one, is set apart from it. Files stay splittable, so one large file is
    read by many tasks.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*_set_apart(header), CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("enforceSchema", not checked)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv([literal(p) for p in paths])
    )
    too_long = F.size(F.split(F.col(CORRUPT), ",")) > len(header)
    return sanitize_headers(rows).withColumn(CORRUPT, F.when(too_long, F.col(CORRUPT)))


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    contract: FeedContract,
    processing_time: Column | None = None,
    groups: Mapping[tuple[str, ...], Sequence[str]] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Bronze rows of the given files, in the bronze schema of the contract.

    One scan per distinct header, however many files there are. ``groups`` has the files by header
    where that is known already.
    """
    found = header_groups(spark, paths) if groups is None else groups
    frames = [
        rescue(stamp_operational(read_csv_group(spark, header, files, checked), processing_time), contract)
        for header, files in found.items()
    ]
    if not frames:
        return spark.createDataFrame([], contract.bronze_schema())
    return reduce(DataFrame.unionByName, frames)


def _bits(fits: Mapping[str, Column]) -> Column:
    return reduce(Column.__add__, (F.when(fits[kind], F.lit(BIT[kind])).otherwise(F.lit(0)) for kind in fits))


def _fitting_types(value: Column) -> Column:
    """A bit for each of the types that a cell fits. Cells are folded by AND, in any order.

    A cast that fails raises inside Spark, at many times the price of one that succeeds, and every cell
    misfits most types. So a cell is cast to a type only if it looks like one of its values. Patterns are
    what remains dear: plain numbers and words, which most cells are, are told by one and the first
    character, and only the types that are open then are looked at.
    """

    def cast(looks: str, kind: T.DataType) -> Column:
        return fitted(F.when(value.rlike(looks), value), kind)

    first = F.ascii(value)
    whole = cast(LIKE_LONG, T.LongType())
    double = cast(LIKE_DOUBLE, T.DoubleType()).isNotNull()
    time = cast(LIKE_TIME, T.TimestampType()).isNotNull()
    boolean = fitted(value, T.BooleanType()).isNotNull()
    plain_whole = {
        "int": F.when(F.length(value) < 10, F.lit(True)).otherwise(value.try_cast("bigint") < 1 << 31),
        "timestamp": F.length(value).between(4, 6) & time,
        "boolean": value.isin("0", "1"),
    }
    word = {
        "double": first.isin(*map(ord, "IiNn")) & double,
        "timestamp": (first == ord("T")) & time,
        "boolean": boolean,
    }
    any_other = {
        "int": F.coalesce(whole.between(-(1 << 31), (1 << 31) - 1), F.lit(False)),
        "bigint": whole.isNotNull(),
        "decimal": value.rlike(WHOLE_NUMBER),
        "double": double,
        "date": F.when(value.rlike(PLAIN_DATE), value).try_cast("date").isNotNull(),
        "timestamp": time,
        "boolean": boolean,
    }
    digit = first.between(ord("0"), ord("9"))
    return (
        F.when(first.between(ord("A"), ord("~")) | (first > 0x7F), _bits(word))
        .when(digit & value.rlike(PLAIN_FRACTION), F.lit(BIT["double"]))
        .when(digit & value.rlike(PLAIN_WHOLE), _bits(plain_whole) + BIT["bigint"] + BIT["decimal"] + BIT["double"])
        .when(value.isNotNull(), _bits(any_other))
    )


def _header_lines(spark: SparkSession, reader_options: Mapping[str, object], directory: str) -> DataFrame:
    """(path, line): the first line of each file that is not blank, found by the tasks that read the files."""
    lines = spark.read.options(**reader_options).text(directory)
    numbered = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    top = numbered.where((F.col("start") == 0) & F.col("line").rlike(r"\S"))
    return top.groupBy("path").agg(F.min_by("line", "place").alias("line"))


def infer_feed_schema(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    """Discovery helper: type and number of filled values of every column found in a landing folder.

    A column is counted under its own name wherever it stands in a file; its type is the narrowest that
    all its values fit, in all files: whole numbers too long for bigint are decimals, dates without a time
    are dates, and a column without values is text. Columns are in the order of the files' paths and of
    their headers.

    One scan finds the headers, which are stored, and one folds the cells by file and place, with a bit mask
    of types that combines on the map side. No path comes to the driver, only the headers that differ do.
    """
    options = {"pathGlobFilter": glob, "recursiveFileLookup": True}
    kept = scratch_dir(spark, "headers")
    _header_lines(spark, options, directory).write.parquet(kept)
    headers = spark.read.schema("path string, line string").parquet(kept)
    distinct = headers.groupBy("line").agg(F.min("path").alias("least")).orderBy("least").collect()
    columns, order = [], {}
    for line in (r.line for r in distinct):
        for place, name in enumerate(column_names(spark, header_names(line))):
            columns.append((line, place, order.setdefault(name, len(order)), name))
    if not columns:
        return spark.createDataFrame([], "position int, column_name string, inferred_type string, filled bigint")
    named = spark.createDataFrame(columns, "line string, place int, position int, column_name string")
    width = 1 + max(place for _, place, _, _ in columns)
    rows = (
        spark.read.schema(T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)]))
        .options(**options)
        .option("header", True)
        .option("sep", ",")
        .csv(directory)
    )
    cells = rows.select(
        F.col("_metadata.file_path").alias("path"),
        F.posexplode(F.array(*rows.columns)).alias("place", "value"),
    ).withColumn("types", _fitting_types(F.col("value")))
    leads = F.ascii("value").between(ord("1"), ord("9"))
    digits = F.length(F.when(leads, F.trim("value")).otherwise(F.regexp_replace(F.trim("value"), "^[+-]?0*", "")))
    folded = cells.groupBy("path", "place").agg(
        F.count("value").alias("filled"),
        F.bit_and("types").alias("types"),
        F.max(F.when(F.col("types").bitwiseAND(BIT["decimal"]) != 0, digits)).alias("digits"),
    )
    found = (
        headers.join(named, "line")
        .join(folded, ["path", "place"], "left")
        .groupBy("position", "column_name")
        .agg(
            F.coalesce(F.sum("filled"), F.lit(0)).alias("filled"),
            F.bit_and("types").alias("types"),
            F.max("digits").alias("digits"),
        )
    )
    spelled = {"decimal": F.concat(F.lit("decimal("), F.col("digits"), F.lit(",0)"))}
    kind = F.coalesce(
        *(
            F.when(F.col("types").bitwiseAND(BIT[kind]) != 0, spelled.get(kind, F.lit(kind)))
            for kind in INFERRED_TYPES
        ),
        F.lit("string"),
    )
    return found.select("position", "column_name", kind.alias("inferred_type"), F.col("filled").cast("long"))
