import hashlib
import random
import re

from odd import LONG, none_of, odd_documents
from shedlake.llm.decontamination import contamination, contamination_query, drop_contaminated


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(rows, items):
    """The contract, window by window."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        span = min(10, len(words))
        for i in range(len(words) - span + 1 if span else 0):
            windows.setdefault(tuple(words[i : i + span]), set()).add("" if item is None else str(item))
    spans = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words, hit, found = words_of(text), set(), set()
        for span in spans:
            for i in range(len(words) - span + 1):
                if (w := tuple(words[i : i + span])) in windows:
                    hit.update(range(i, i + span))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(df):
    return [tuple(r) for r in df.select(df.columns[0], "text").collect()]


def odd_benchmark(spark):
    rows = [
        (1, "Two words"),
        (2, None),
        (3, " .. "),
        (10, "that is copied from text to text and long enough to count as a line, of its own!"),
        (11, "passage that is copied from text to text and long enough to"),
        (10, "漢字"),
        (None, "a" * 5000),
        (7, " ".join(LONG.split()[40_000:40_200])),
        (7, " ".join(LONG.split()[40_000:40_200])),
        (8, "word word word word word word word word word word word"),
        (9, "the document never has these ten words in a row, not once"),
    ]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, words string")


def test_odd_rows_follow_the_contract(spark):
    docs, items = odd_documents(spark), odd_benchmark(spark)
    assert result(contamination_query(docs, items)) == plain(pairs(docs), pairs(items))


def random_rows():
    chosen = random.Random(8)
    vocabulary = [f"v{i}" for i in range(6)]
    items = [(i, " ".join(chosen.choices(vocabulary, k=chosen.choice([3, 9, 10, 11, 25])))) for i in range(30)]
    rows = []
    for i in range(80):
        words = chosen.choices(vocabulary, k=chosen.randrange(60))
        for _ in range(chosen.randrange(3)):
            at, item = chosen.randrange(len(words) + 1), chosen.choice(items)[1].split()
            start = chosen.randrange(len(item))
            words[at:at] = item[start:]
        rows.append((i, ", ".join(words)))
    return rows, items


def test_random_rows_with_and_without_broadcast(spark):
    rows, items = random_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = plain(rows, items)
    assert result(contamination_query(docs, benchmark)) == wanted
    shuffled = contamination(docs, benchmark, broadcast_prints=0)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in shuffled.collect()) == sorted(w[:4] for w in wanted)


def test_main_path_has_no_python(spark):
    plan = contamination_query(odd_documents(spark), odd_benchmark(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_tables(spark):
    docs, items = odd_documents(spark), odd_benchmark(spark)
    assert contamination_query(none_of(docs), items).count() == 0
    rows = contamination_query(docs, none_of(items)).collect()
    assert len(rows) == docs.count() and not any(r.contaminated for r in rows)


def test_stage_drops_what_is_hit(spark):
    docs, items = odd_documents(spark), odd_benchmark(spark)
    kept = drop_contaminated(docs, items)
    clean = [w[0] for w in plain(pairs(docs), pairs(items)) if not w[5]]
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, clean))
