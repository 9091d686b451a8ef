"""Header sanitising for columns that storage formats reject."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

# How each forbidden header character is written.
HEADER_REPLACEMENTS = str.maketrans({"(": "_", ")": "", " ": "_"})


def clean_header(name: str) -> str:
    return name.translate(HEADER_REPLACEMENTS)


def sanitize_headers(df: DataFrame) -> DataFrame:
    """Rename every column to its clean spelling in one projection.

    Two headers that end up with one name would make the column ambiguous, so that raises.
    """
    names = [clean_header(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if clashes:
        raise ValueError(f"headers collide after cleaning: {', '.join(clashes)}")
    return df.toDF(*names)
