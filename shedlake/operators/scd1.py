"""Sequenced upserts, SCD type 1: one row per key, decided by the sequence alone.

The fold is a grouped aggregate, so Spark combines on the map side before it shuffles: a key
that holds a third of all rows leaves each task as a single row. With ``ignore_nulls`` every
column keeps its last non-null value.

To go on folding later, a state must remember how new each of its values is. A *lifted* frame
holds, in place of each value column, a mark: the position of the change in the sequence, and the
value. Folding lifted frames is a plain ``max`` per mark, hence associative, commutative and
idempotent: batches may come in any split and order, and may be replayed.

The sequence may be several columns, compared left to right; it should order all changes of a key,
and a single sequence column must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "__mark_"
AT = "__at_"


def _names(sequence: str | Sequence[str]) -> list[str]:
    return [sequence] if isinstance(sequence, str) else list(sequence)


def _values(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None, dropped: Sequence[str] = ()
) -> list[str]:
    chosen = df.columns if columns is None else columns
    return [c for c in chosen if c not in keys and c not in dropped]


def mark_order(column: str, sequence: str | Sequence[str]) -> list[str]:
    """What decides between two values of ``column``, before the values themselves do.

    For a column that is part of the sequence, whatever the sequence compares after it can no
    longer change which value wins, so only the columns before it count.
    """
    order = _names(sequence)
    return order[: order.index(column)] if column in order else order


def _marks(values: list[str], sequence: str | Sequence[str], ignore_nulls: bool) -> list[tuple[str, Column]]:
    def mark(column: str) -> Column:
        before = mark_order(column, sequence)
        position = [F.struct(*before).alias("position")] if before else []
        pair = F.struct(*position, F.col(column).alias("value"))
        return F.when(F.col(column).isNotNull(), pair) if ignore_nulls else pair

    return [(MARK + c, mark(c)) for c in values]


def scd1_fold(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    columns: Sequence[str] | None = None,
    ignore_nulls: bool = True,
    unique_sequence: bool = False,
) -> DataFrame:
    """Current state of a set of changes: keys and ``columns`` (default: all), one row per key.

    Of values with the same position the greatest wins, column by column, as in ``scd1_merge``,
    whatever the order of the rows. ``unique_sequence`` says that no two changes of a key share a
    position in a single sequence column, which saves a shuffle. With one fixed-width sequence column
    over fixed-width values Spark aggregates by hash. Whole rows under a composite sequence are folded as
    one struct, so that a column which is part of the sequence is not carried twice.
    """
    values, order = _values(df, keys, columns), _names(sequence)
    if unique_sequence and len(order) == 1:
        seq = F.col(order[0])
        return df.groupBy(*keys).agg(
            *(F.max_by(c, F.when(F.col(c).isNotNull(), seq) if ignore_nulls else seq).alias(c) for c in values)
        )
    if ignore_nulls or len(order) == 1:
        return publish(fold_changes(df, keys, order, values, ignore_nulls)).select(*keys, *(f"`{c}`" for c in values))
    row = F.struct(*order, *(c for c in values if c not in order))
    return df.groupBy(*keys).agg(F.max(row).alias("last")).select(*keys, *(f"last.`{c}`" for c in values))


def lift(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    columns: Sequence[str] | None = None,
    ignore_nulls: bool = True,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """Changes in the shape of a foldable state, not folded yet."""
    values = _values(df, keys, columns, except_columns)
    marks = _marks(values, sequence, ignore_nulls)
    return df.select(*keys, *(mark.alias(name) for name, mark in marks))


def fold_changes(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    columns: Sequence[str] | None = None,
    ignore_nulls: bool = True,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """``fold_lifted(lift(...))`` in one step.

    Under one sequence column, fixed-width values are aggregated by hash. Otherwise marks are built
    inside the aggregate, so what is sorted before the map-side combine is the plain change.
    """
    values, order = _values(df, keys, columns, except_columns), _names(sequence)
    if len(order) == 1:
        return _fold_by_hash(df, keys, order[0], values, ignore_nulls)
    marks = _marks(values, sequence, ignore_nulls)
    return df.groupBy(*keys).agg(*(F.max(mark).alias(name) for name, mark in marks))


def _fold_by_hash(
    df: DataFrame, keys: Sequence[str], sequence: str, values: list[str], ignore_nulls: bool
) -> DataFrame:
    """Marks under one sequence column: first the greatest value of each moment, then the last moment."""
    rest = [c for c in values if c != sequence]
    moments = df.groupBy(*keys, sequence).agg(*(F.max(c).alias(c) for c in rest))
    at = {c: F.when(F.col(c).isNotNull(), F.col(sequence)) if ignore_nulls else F.col(sequence) for c in rest}
    last = moments.groupBy(*keys).agg(
        F.max(sequence).alias(sequence),
        *(F.max(at[c]).alias(f"{AT}{c}") for c in rest),
        *(F.max_by(c, at[c]).alias(c) for c in rest),
    )

    def mark(column: str) -> Column:
        if column == sequence:
            return F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("value")))
        moment = F.col(f"{AT}{column}")
        pair = F.struct(F.struct(moment.alias(sequence)).alias("position"), F.col(column).alias("value"))
        return F.when(moment.isNotNull(), pair)

    return last.select(*keys, *(mark(c).alias(MARK + c) for c in values))


def fold_lifted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold lifted rows to one lifted row per key."""
    return df.groupBy(*keys).agg(*(F.max(c).alias(c) for c in df.columns if c.startswith(MARK)))


def publish(state: DataFrame) -> DataFrame:
    """The values of a lifted state, under their own names."""
    return state.select(
        *(F.col(f"{c}.value").alias(c.removeprefix(MARK)) if c.startswith(MARK) else F.col(c) for c in state.columns)
    )


def scd1_merge(
    current: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    ignore_nulls: bool = True,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """Next lifted state from the current one (``None`` at first) and a batch of changes."""
    if current is None:
        return fold_changes(changes, keys, sequence, ignore_nulls=ignore_nulls, except_columns=except_columns)
    lifted = lift(changes, keys, sequence, ignore_nulls=ignore_nulls, except_columns=except_columns)
    return fold_lifted(current.unionByName(lifted), keys)
