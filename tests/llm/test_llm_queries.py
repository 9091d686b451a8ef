"""The registered queries against their SQL, or against the tables themselves."""

import pytest
from oracle import connect, differences
from shedlake.llm.queries import ORACLES, QUERIES

import __spark_entry__ as entry_points

ROWS_OF = {"op1_quality": "documents", "op2_html_extraction": "pages", "op6_simhash_dedup": "documents", "op8_toxicity": "documents", "op10_source_mix": "documents", "op12_token_counts": "documents"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_OF))
def test_query_has_a_row_for_each_row(spark, sf_dir, duck, name):
    (count,) = duck.execute(f"SELECT count(*) FROM {ROWS_OF[name]}").fetchone()
    assert QUERIES[name](spark, sf_dir).count() == count
