import pytest
from pyspark.sql import functions as F

from shedlake.operators.dimension import maintain_dimension, members, new_members
from shedlake.operators.serving import chart_series, serve_table


def feed(spark, *farms):
    return spark.createDataFrame([(f, 0) for f in farms], "FARM_NO int, x int")


def at(moment):
    return F.lit(moment).cast("timestamp")


def test_members_are_distinct_and_never_null(spark):
    found = members([feed(spark, 1, 1, None), feed(spark, 2, 1)])
    assert sorted(r.FARM_NO for r in found.collect()) == [1, 2]


def test_everything_is_new_without_a_dimension(spark):
    assert new_members(feed(spark, 1, 2), None).count() == 2


def test_ids_and_times_of_existing_members_never_change(spark):
    first = maintain_dimension(None, [feed(spark, 1, 2)], processing_time=at("2024-01-01"))
    second = maintain_dimension(first, [feed(spark, 2, 3)], processing_time=at("2024-01-02"))
    third = maintain_dimension(second, [feed(spark, 1)], processing_time=at("2024-01-03"))
    before = {r.FARM_NO: tuple(r) for r in first.collect()}
    after = {r.FARM_NO: tuple(r) for r in third.collect()}
    assert sorted(after) == [1, 2, 3]
    assert all(after[k] == before[k] for k in before)
    assert len({r[1] for r in after.values()}) == 3


def test_run_without_new_members_empties_nothing(spark):
    first = maintain_dimension(None, [feed(spark, 1, 2)], processing_time=at("2024-01-01"))
    again = maintain_dimension(first, [feed(spark, 1, 2)], processing_time=at("2024-01-02"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))


def test_random_ids_are_unique(spark):
    ids = maintain_dimension(None, [feed(spark, 1, 2, 3)], random_ids=True).select("ID").collect()
    assert len({r.ID for r in ids}) == 3


@pytest.mark.parametrize("name", ["t; DROP TABLE t", "a.b.c.d", "", "1abc", "a b", "a.`b`"])
def test_only_plain_names_are_served(spark, name):
    with pytest.raises(ValueError):
        serve_table(spark, name)


def test_serve_orders_the_page(spark):
    feed(spark, 3, 1, 2).createOrReplaceTempView("served")
    assert [r.FARM_NO for r in serve_table(spark, "served", ["FARM_NO"]).collect()] == [1, 2, 3]


def test_chart_series_are_ordered_by_x(spark):
    rows = spark.createDataFrame([(2, 20, 200), (1, None, 100)], "t int, a int, b int")
    assert [tuple(r) for r in chart_series(rows, "t", ["a", "b"]).collect()] == [
        (1, "a", None), (1, "b", 100), (2, "a", 20), (2, "b", 200),
    ]
