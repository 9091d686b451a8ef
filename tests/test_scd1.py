import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shedlake.operators.scd1 import fold_changes, fold_lifted, lift, publish, scd1_fold, scd1_merge

SCHEMA = "k int, seq int, file string, a int, b string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_hand(changes, order, ignore_nulls=True):
    """Last value per key and column, by sorting in plain Python."""
    result = {}
    for row in sorted(changes, key=order):
        kept = result.setdefault(row[0], [None, None])
        for i, value in enumerate(row[3:5]):
            if value is not None or not ignore_nulls:
                kept[i] = value
    return sorted(((k, *v) for k, v in result.items()), key=repr)


def total_order(row):
    return tuple((v is not None, v) for v in (row[1], row[2], row[3], row[4]))


ORDER = ["seq", "file", "a", "b"]


def test_highest_sequence_wins_and_null_keeps_the_stored_value(spark):
    changes = [(1, 1, "f", 10, "x"), (1, 3, "f", None, "z"), (1, 2, "f", 20, None), (2, 1, "f", None, None)]
    df = spark.createDataFrame(changes, SCHEMA)
    assert rows_of(scd1_fold(df, ["k"], "seq", ["a", "b"])) == [(1, 20, "z"), (2, None, None)]


def test_whole_rows_when_nulls_count(spark):
    changes = [(1, 1, "f", 10, "x"), (1, 3, "f", None, "z"), (2, 1, "f", 5, None)]
    df = spark.createDataFrame(changes, SCHEMA)
    expected = [(1, None, "z"), (2, 5, None)]
    assert rows_of(scd1_fold(df, ["k"], "seq", ["a", "b"], ignore_nulls=False)) == expected
    assert rows_of(scd1_fold(df, ["k"], ORDER, ["a", "b"], ignore_nulls=False)) == expected


def test_tie_goes_to_file_name_then_to_the_row(spark):
    changes = [(1, 1, "b", 1, "from b"), (1, 1, "a", 9, "from a"), (2, 1, "a", 3, "x"), (2, 1, "a", 4, "w")]
    df = spark.createDataFrame(changes, SCHEMA)
    expected = [(1, 1, "from b"), (2, 4, "w")]
    assert rows_of(scd1_fold(df, ["k"], ORDER, ["a", "b"])) == expected
    assert rows_of(scd1_fold(df, ["k"], ORDER, ["a", "b"], ignore_nulls=False)) == expected


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_value_and_null_may_arrive_in_any_order(spark, order):
    batches = [[(1, 1, "f", 7, "old")], [(1, 2, "f", None, "new")], [(1, 0, "f", 1, "oldest")]]
    state = None
    for i in order:
        changes = spark.createDataFrame(batches[i], SCHEMA)
        state = scd1_merge(state, changes, ["k"], "seq", except_columns=["seq", "file"])
    assert rows_of(publish(state)) == [(1, 7, "new")]


def test_merge_that_counts_nulls_replaces_whole_rows(spark):
    state = None
    for batch in ([(1, 2, "f", None, "new")], [(1, 1, "f", 7, "old")]):
        changes = spark.createDataFrame(batch, SCHEMA)
        state = scd1_merge(state, changes, ["k"], "seq", ignore_nulls=False, except_columns=["seq", "file"])
    assert rows_of(publish(state)) == [(1, None, "new")]


change = st.tuples(
    st.integers(0, 3),
    st.integers(0, 3),
    st.sampled_from(["f", "g"]),
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from(["x", "y"])),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=st.lists(change, min_size=1, max_size=25), seed=st.integers(0, 99))
def test_any_split_order_and_replay_gives_the_batch_fold(spark, changes, seed):
    expected = by_hand(changes, total_order)
    df = spark.createDataFrame(changes, SCHEMA)
    assert rows_of(scd1_fold(df, ["k"], ORDER, ["a", "b"])) == expected

    rng = random.Random(seed)
    shuffled = rng.sample(changes, len(changes))
    cut = rng.randint(0, len(shuffled))
    batches = [b for b in (shuffled[:cut], shuffled[cut:], shuffled[: cut // 2 + 1]) if b]
    state = None
    for batch in batches:
        part = spark.createDataFrame(batch, SCHEMA)
        state = scd1_merge(state, part, ["k"], ORDER, except_columns=["seq", "file"])
    assert rows_of(publish(state)) == expected


def test_fold_is_idempotent_and_one_step_equals_two(spark):
    changes = [(i % 3, i % 4, "f", None if i % 5 == 0 else i, None if i % 2 else str(i)) for i in range(40)]
    df = spark.createDataFrame(changes, SCHEMA)
    once = fold_changes(df, ["k"], ORDER, ["a", "b"])
    assert rows_of(fold_lifted(once, ["k"])) == rows_of(once)
    assert rows_of(fold_lifted(lift(df, ["k"], ORDER, ["a", "b"]), ["k"])) == rows_of(once)
    assert rows_of(fold_lifted(once.unionByName(once), ["k"])) == rows_of(once)


def test_one_key_with_most_rows(spark):
    df = spark.range(60_000).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS INT) AS k", "CAST(id AS INT) AS seq", "'f' AS file",
        "CAST(id AS INT) AS a", "CAST(NULL AS STRING) AS b",
    )
    folded = scd1_fold(df, ["k"], ORDER, ["a", "b"])
    assert folded.count() == 40_001
    assert folded.where("k = 0").collect()[0].a == 59_997


def test_ties_have_one_rule_whatever_the_order_of_rows(spark):
    """Of values with one position the greatest wins, in the fold and in the merge."""
    rows = [(1, 5, 30, 4), (1, 5, 10, 20), (1, 4, 99, 99), (2, 1, None, 7), (2, 1, 3, None)]
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "k int, s int, a int, b int").coalesce(1)
        folded = scd1_fold(df, ["k"], "s", ["a", "b"])
        merged = publish(scd1_merge(scd1_merge(None, df.limit(2), ["k"], "s"), df, ["k"], "s"))
        for found in (folded, merged):
            assert sorted((r.k, r.a, r.b) for r in found.collect()) == [(1, 30, 20), (2, 3, 7)]
        whole = scd1_fold(df, ["k"], "s", ["a"], ignore_nulls=False)
        assert sorted((r.k, r.a) for r in whole.collect()) == [(1, 30), (2, 3)]
