"""Operational columns, contract casts and keys taken from file names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import OPERATIONAL, PROCESSING_TIME, SOURCE_FILE, FeedContract


def plausible(text: Column, kind: T.DataType) -> Column:
    """False for text that cannot be cast to ``kind`` by its looks alone.

    Casting a misfit raises and catches an exception inside Spark, at some twenty times the price
    of a good cast, so a column full of words would slow down its whole batch. No whole or decimal
    number starts with a letter, and every boolean is one of a few short words. Other types are left
    to the cast: a double may be NaN, and text is always text.
    """
    if isinstance(kind, T.BooleanType):
        return text.rlike(r"^[\x00-\x20\x7f]*(?i:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7f]*$")
    if not isinstance(kind, (T.IntegralType, T.DecimalType)):
        return F.lit(True)
    first = F.ascii(text)
    return (first < ord(":")) | (first > ord("~"))


def quoted(column: str) -> str:
    """A column name as a reference, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def fitted(text: Column, kind: T.DataType) -> Column:
    """Text as another type, or null where it does not fit."""
    return F.when(plausible(text, kind), text).try_cast(kind)


def fit(df: DataFrame, column: str, kind: T.DataType) -> Column:
    """``column`` as another type, or null where it does not fit."""
    value = F.col(quoted(column))
    return fitted(value, kind) if isinstance(df.schema[column].dataType, T.StringType) else value.try_cast(kind)


def stamp_operational(df: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Add the ingest time and the name of the file each row was read from.

    ``df`` must still sit on its file scan: the file name comes from the hidden ``_metadata`` column.
    """
    when = F.current_timestamp() if processing_time is None else processing_time
    return df.withColumns({PROCESSING_TIME: when, SOURCE_FILE: F.col("_metadata.file_name")})


def _must_fit(df: DataFrame, column: str, kind: T.DataType) -> Column:
    value, fitted = F.col(quoted(column)), fit(df, column, kind)
    complaint = F.concat(F.lit(f"{column} is not a {kind.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & fitted.isNull(), F.raise_error(complaint)).otherwise(fitted)


def cast_contract(
    df: DataFrame, contract: FeedContract, keep_source_columns: bool = False, strict: bool = False
) -> DataFrame:
    """Contract columns in their contract types, followed by the columns that pass through.

    A value that does not fit its type becomes null (``rescue`` has kept its text), or fails the
    query when ``strict``. A column that the input lacks is null. ``keep_source_columns`` also
    retains every column outside the contract and the sources of renamed columns.
    """
    cast = _must_fit if strict else fit
    names = df.columns
    casts, consumed = [], set()
    for rule in contract.columns:
        source = rule.pick(names)
        if source is None:
            casts.append(F.lit(None).cast(rule.type).alias(rule.name))
            continue
        casts.append(cast(df, source, rule.type).alias(rule.name))
        if not (keep_source_columns and source.lower() != rule.name.lower()):
            consumed.add(source)
    allowed = None if keep_source_columns else {*OPERATIONAL, *contract.pass_through, *contract.key_patterns}
    rest = [F.col(quoted(c)) for c in names if c not in consumed and (allowed is None or c in allowed)]
    return df.select(*casts, *rest)


def derive_keys(df: DataFrame, patterns: Mapping[str, str], source: str = SOURCE_FILE) -> DataFrame:
    """Integer keys from the first match of each pattern; null where the name has no match."""
    return df.withColumns(
        {
            key: F.nullif(F.regexp_extract(source, pattern, 1), F.lit("")).try_cast("int")
            for key, pattern in patterns.items()
        }
    )


def standardize(df: DataFrame, contract: FeedContract, keep_source_columns: bool = False) -> DataFrame:
    """Bronze rows to silver shape: casts, then keys, in the column order of the contract."""
    rows = derive_keys(cast_contract(df, contract, keep_source_columns), contract.key_patterns)
    front = [*contract.key_patterns, *(c.name for c in contract.columns)]
    return rows.select(*front, *(quoted(c) for c in rows.columns if c not in front))


def incomplete_key(keys: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def split_quarantine(df: DataFrame, keys: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows in which some key column is null."""
    broken = incomplete_key(keys)
    return df.where(~broken), df.where(broken)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as a double, decided by the schema rather than by looking at values."""
    return df.select(
        *(
            F.col(quoted(f.name)).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        )
    )
