import random
import zlib

import pytest
from odd import none_of, odd_documents
from pyspark.sql import functions as F
from shedlake.llm import quality, toxicity
from shedlake.llm.common import held_out, load

TESTDATA = "/root/testdata"


def labels_for(spark, docs, column):
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    rows = [(i, n % 2, n % 2, "x") for n, i in enumerate(ids)] + [(None, 1, 1, "x"), (10**9, 0, None, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_get_a_score(spark, module):
    docs = odd_documents(spark)
    found = module.score_documents(docs, labels_for(spark, docs, "toxic")).collect()
    assert len(found) == docs.count()
    threshold = 0.3 if module is quality else 0.5
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


@pytest.mark.parametrize("module,untrained", [(quality, 1.0), (toxicity, 0.0)])
def test_nothing_to_learn(spark, module, untrained):
    docs = odd_documents(spark)
    labels = none_of(labels_for(spark, docs, "toxic"))
    assert {r.score for r in module.score_documents(docs, labels).collect()} == {untrained}
    assert module.score_documents(none_of(docs), labels).count() == 0


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_documents_are_ranked(spark, module, label):
    """Area under the curve on documents that no training saw, and the same scores again."""
    docs, labels = (load(spark, f"{TESTDATA}/sf0.1", t) for t in ("documents", "labels"))
    some = docs.join(labels, "doc_id").where(held_out(F.col("doc_id"))).select(docs["*"])
    model = module.train(docs, labels)
    score = module.quality_score if module is quality else module.toxicity_score
    rows = some.join(labels, "doc_id").select(label, score(model, F.col("text")).alias("score")).collect()
    ones, zeros = ([r.score for r in rows if r[label] == v] for v in (1, 0))
    wins = sum(a > b for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert wins > (0.99 if module is quality else 0.85)


def test_a_word_form_never_seen_shares_subwords():
    chosen = random.Random(3)
    filler = [f"{a}{b}{c}" for a in "bdfgk" for b in ("ala", "emo", "uri") for c in ("ts", "nd", "rk")]
    ends = ["s", "ing", "ish", "ed", "er", "y"]
    rows = []
    for n in range(400):
        words = chosen.choices(filler, k=40)
        if n % 2:
            words[chosen.randrange(40)] = "vorgnax" + chosen.choice(ends)
        rows.append((" ".join(words), n % 2))
    score = toxicity.fit(rows).scorer()
    clean = " ".join(filler[:40])
    assert score(clean + " vorgnaxable") > 0.5 > score(clean)
    assert score(" ".join([clean] * 50) + " vorgnaxxen") > 0.5  # one insult in a long text


def test_attention_finds_the_passage_that_tells():
    chosen = random.Random(2)
    plain = lambda: " ".join("".join(chosen.choices("abcdefgh", k=5)) for _ in range(64))
    rows = []
    for n in range(200):
        parts = [plain() for _ in range(4)]
        if n % 2 == 0:
            parts[chosen.randrange(4)] = " ".join("$%&#" for _ in range(64))
        rows.append((" ".join(parts), n % 2))
    model, table = quality.fit(rows), quality._class_table()
    import numpy as np

    for text, label in rows[:40]:
        assert (model.score(quality.passages(text, table), np.array([0]))[0] >= 0.5) == bool(label)


def test_stage_keeps_clean_documents(spark):
    docs, labels = (load(spark, f"{TESTDATA}/sf0.01", t) for t in ("documents", "labels"))
    kept = toxicity.keep_clean(docs, labels)
    scored = toxicity.score_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.where("predicted = 0").collect()}
