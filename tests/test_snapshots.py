import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shedlake.operators.snapshots import change_feed, collapse_change_feed, snapshot_apply, snapshot_diff
from shedlake.plans.queries import snapshots

SCHEMA = "k int, v string, at int"
OLD = [(1, "a", 1), (2, "b", 1), (3, None, 1), (4, "d", 1)]
NEW = [(1, "a", 2), (2, "B", 2), (3, None, 2), (5, "e", 2)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, old=OLD, new=NEW):
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def test_diff_labels_every_key_and_compares_null_safely(spark):
    diff = snapshot_diff(*frames(spark), ["k"], compare=["v"])
    assert rows_of(diff.select("k", "v", "_change_type")) == [
        (1, "a", "unchanged"), (2, "B", "update"), (3, None, "unchanged"), (4, "d", "delete"), (5, "e", "insert"),
    ]


def test_apply_makes_the_target_the_snapshot(spark):
    old, new = frames(spark)
    assert rows_of(snapshot_apply(old, new, ["k"])) == sorted(NEW, key=repr)
    assert rows_of(snapshot_apply(None, new, ["k"])) == sorted(NEW, key=repr)


def test_apply_keeps_stored_rows_that_did_not_change(spark):
    applied = snapshot_apply(*frames(spark), ["k"], compare=["v"])
    assert rows_of(applied) == [(1, "a", 1), (2, "B", 2), (3, None, 1), (5, "e", 2)]


@pytest.mark.parametrize("broken", [[(1, "a", 1), (1, "b", 1)], [(None, "a", 1)]])
def test_repeated_or_null_key_is_an_error(spark, broken):
    old, new = frames(spark, new=broken)
    with pytest.raises(PySparkException, match="null or repeated key"):
        snapshot_apply(old, new, ["k"]).collect()
    with pytest.raises(PySparkException, match="null or repeated key"):
        snapshot_diff(old, new, ["k"]).collect()


def test_change_feed_has_both_images_of_an_update(spark):
    feed = change_feed(*frames(spark, new=[(1, "a", 1), (2, "B", 1), (5, "e", 1)]), ["k"], 3, stamp())
    assert rows_of(feed.select("k", "v", "_change_type", "_commit_version")) == [
        (2, "B", "update_postimage", 3), (2, "b", "update_preimage", 3), (3, None, "delete", 3),
        (4, "d", "delete", 3), (5, "e", "insert", 3),
    ]


def test_delete_and_insert_in_one_commit_leave_the_insert(spark):
    feed = spark.createDataFrame(
        [(1, "old", "delete", 1), (1, "new", "insert", 1), (2, "x", "insert", 0), (2, "x", "delete", 1)],
        "k int, v string, _change_type string, _commit_version long",
    )
    assert rows_of(collapse_change_feed(feed, ["k"])) == [(1, "new")]


def test_tables_that_are_all_keys(spark):
    old, new = (spark.createDataFrame([(k,) for k in ks], "k int") for ks in ((1, 2), (2, 3)))
    assert rows_of(snapshot_diff(old, new, ["k"])) == [(1, "delete"), (2, "unchanged"), (3, "insert")]
    assert rows_of(snapshot_apply(old, new, ["k"])) == [(2,), (3,)]
    feed = change_feed(old.limit(0), old, ["k"], 0, stamp()).unionByName(change_feed(old, new, ["k"], 1, stamp()))
    assert rows_of(collapse_change_feed(feed, ["k"])) == [(2,), (3,)]


snapshot = st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.sampled_from("xyz")), max_size=7)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(versions=st.lists(snapshot, min_size=1, max_size=3))
def test_feed_of_all_versions_collapses_to_the_last(spark, versions):
    schema = "k int, v string"
    frames_ = [spark.createDataFrame([], schema)] + [spark.createDataFrame(list(v.items()), schema) for v in versions]
    feed = None
    for number, (old, new) in enumerate(zip(frames_, frames_[1:])):
        step = change_feed(old, new, ["k"], number, stamp())
        feed = step if feed is None else feed.unionByName(step)
    assert rows_of(collapse_change_feed(feed, ["k"])) == sorted(versions[-1].items(), key=repr)


@pytest.mark.parametrize("side", ["old", "new"])
@pytest.mark.parametrize("key", [None, 1])
def test_the_side_that_is_not_known_unique_is_checked_without_sorting_its_rows(spark, side, key):
    fine = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    bad = spark.createDataFrame([(1, "a"), (2, "b"), (key, "c")], "k int, v string")
    known = "new" if side == "old" else "old"
    pair = (bad, fine) if side == "old" else (fine, bad)
    with pytest.raises(PySparkException, match=f"{side} snapshot"):
        snapshot_diff(*pair, ["k"], unique=known).collect()
    good = snapshot_diff(fine, fine, ["k"], unique=known)
    assert {r._change_type for r in good.collect()} == {"unchanged"} and good.count() == 2
    assert "SortAggregate" not in good._jdf.queryExecution().executedPlan().toString()


def test_order_versions_are_dealt_by_their_rows(spark, scratch, monkeypatch):
    """Tasks of a bounded number of rows, however small their shuffled bytes; null and repeated keys of lines stay."""
    orders = spark.range(400).select(F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"))
    lines = spark.range(800).select(F.when(F.col("id") != 7, F.col("id") % 390).alias("l_orderkey"), F.lit("O").alias("l_linestatus"))
    orders.write.parquet(f"{scratch}/orders.parquet")
    lines.write.parquet(f"{scratch}/lineitem.parquet")
    monkeypatch.setattr(snapshots, "ROWS_PER_TASK", 20)
    recorded, shown = snapshots.order_versions(spark, scratch)
    assert recorded.rdd.getNumPartitions() == shown.rdd.getNumPartitions() == 60
    diff = snapshots.snapshot_diff_orders(spark, scratch)
    assert {(r._change_type, r.n) for r in diff.groupBy("_change_type").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        ("unchanged", 390), ("delete", 10), ("insert", 1),
    }
