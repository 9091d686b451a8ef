"""Each stage against a plain version of its own, on its own input."""

import pytest
from odd import none_of, odd_documents
from pyspark.sql import functions as F
from shedlake.llm import toxicity
from shedlake.llm.common import load, stored
from test_decontamination import plain as plain_contamination
from test_line_dedup import plain as plain_lines
from test_simhash import classes, plain_fingerprint

import corpus_pipeline as pipeline

OPERATORS = ["toxicity", "line dedup", "simhash near-dedup", "benchmark decontamination", "source mix"]


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == OPERATORS


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    steps = [docs]
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "step")
        steps.append(docs)
    return steps


def test_toxic_documents_go(spark, sf_dir, steps):
    scores = toxicity.score_documents(steps[0], load(spark, sf_dir, "labels")).collect()
    assert {r.doc_id for r in steps[1].collect()} == {r.doc_id for r in scores if r.predicted == 0}


def test_line_dedup_takes_effect(steps):
    import hashlib

    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    wanted = {r[0]: r[3] for r in plain_lines(rows)}
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in steps[2].collect()} == wanted


def test_one_of_each_group_stays(steps):
    prints = {r.doc_id: plain_fingerprint(r.text) for r in steps[2].collect()}
    of = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for doc_id, p in prints.items():
        least[of[p]] = min(least.get(of[p], doc_id), doc_id)
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(least.values())


def test_contaminated_documents_go(spark, sf_dir, steps):
    items = [tuple(r) for r in load(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    clean = {r[0] for r in plain_contamination(rows, items) if not r[5]}
    assert {r.doc_id for r in steps[4].collect()} == clean


def test_mix_has_all_that_is_left(steps):
    assert {r.doc_id for r in steps[5].collect()} == {r.doc_id for r in steps[4].collect()}


def test_run_gives_the_last_step(spark, sf_dir, steps):
    key = lambda r: tuple(r)
    assert sorted(pipeline.run(spark, sf_dir).collect(), key=key) == sorted(steps[5].collect(), key=key)
    for before, after in zip(steps[:-2], steps[1:-1], strict=True):
        assert after.columns == before.columns


@pytest.mark.parametrize("rows", [odd_documents, lambda spark: none_of(odd_documents(spark))])
def test_stages_stand_odd_rows(spark, sf_dir, rows):
    docs = rows(spark)
    for _, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "step")
    assert docs.where(F.col("taken") > 3 * F.col("size")).count() == 0
