import hashlib
import random

import pytest
from odd import none_of, odd_documents
from shedlake.llm.line_dedup import LineRuns, dedup_lines, dedup_query, without_repeated_lines

STRIPPED = " \t\n\x0b\f\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIPPED))


def plain(rows, points=40, documents=5):
    """The contract, line by line."""
    low = lambda d: -(2**63) if d is None else d
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= points:
                holders.setdefault(key_of(line), set()).add(low(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key_of(x), ())) >= documents and low(doc_id) < max(holders[key_of(x)]))]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_odd_rows_follow_the_contract(spark):
    docs = odd_documents(spark)
    assert result(dedup_query(docs)) == plain(pairs(docs))


def test_random_rows_whatever_the_batches(spark):
    chosen = random.Random(4)
    lines = [f"{'Line' if i % 3 else ' LINE '} number {i} which is long enough to be looked at" for i in range(12)] + ["short", ""]
    rows = [(chosen.randrange(10**6) - 500, "\n".join(chosen.choices(lines, k=chosen.randrange(1, 9)))) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3, 8):
        kept = dedup_lines(docs, batches=batches).collect()
        wanted = plain(rows)
        found = sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in kept), key=str)
        assert found == wanted


@pytest.mark.parametrize("low, high", [(0, 10**18), (0, 2**54 - 1), (0, 2**62), (-(2**62) - 9, 2**62 + 9), (1 - 2**63, 2**63 - 1), (5, 9)])
def test_ids_spread_over_any_range(spark, low, high):
    """The line is in five documents, the lowest and the highest id among them."""
    line = "a line that is long enough to be looked at here"
    ids = sorted({low, high, *(low + (high - low) * n // 4 for n in range(1, 4))})
    rows = [(i, f"{line}\nown {i}") for i in ids]
    assert len(rows) == 5
    assert result(dedup_query(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_runs_are_levelled_and_name_one_keeper(spark):
    index = LineRuns()
    for n in range(6):
        index.add(spark.createDataFrame([("a", 1, 10 - n), (f"only{n}", 1, 10 - n)], "hash string, n_documents long, keeper long"))
    assert [level for level, _ in index.runs] == [2, 1]
    totals = {r.hash: (r.n_documents, r.keeper) for r in index.totals().collect()}
    assert totals["a"] == (6, 10) and totals["only3"] == (1, 7) and len(totals) == 7


def test_empty_table(spark):
    assert dedup_query(none_of(odd_documents(spark))).count() == 0


def test_stage_keeps_columns_and_follows_text(spark):
    docs = odd_documents(spark)
    out = without_repeated_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert out.count() == docs.count()
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
