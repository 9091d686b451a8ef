"""The transducers against the tokenizer's own library."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import none_of, odd_documents
from pyspark.sql import functions as F
from shedlake.llm import token_counts
from shedlake.llm.common import load
from shedlake.llm.token_counts import CLASSES, STATES, Counter, character_classes, count_tokens, piece_starts, piece_tables, read_tokenizer
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def classes():
    return character_classes()


@pytest.fixture(scope="module")
def counter(classes):
    with open(PATH, "rb") as file:
        return Counter(file.read(), classes)


@given(st.lists(st.text(max_size=60), max_size=4))
@settings(max_examples=300, deadline=None)
def test_any_text(counter, library, texts):
    assert counter.counts(texts) == library(texts)


@given(st.lists(st.text(alphabet="aeirstvldm'' \n\t1.é漢😀!R<|endoftx>", max_size=60), max_size=4))
@settings(max_examples=500, deadline=None)
def test_texts_on_the_borders_of_pieces(counter, library, texts):
    assert counter.counts(texts) == library(texts)


def test_texts_across_chunks_and_slices(counter, library, monkeypatch):
    chosen = random.Random(3)
    monkeypatch.setattr(token_counts, "SLICE", 1000)
    pieces = ["'re", "'r", " ", "  ", "\n", "word", "12", "<|endoftext|>", "!?", "é", "ab" * 400, " " * 300, "''"]
    texts = ["".join(chosen.choices(pieces, k=n)) for n in (0, 1, 5, 50, 400, 3000)]
    texts += ["a" * n for n in (1, 255, 256, 257, 999, 1000, 1001, 20_000)] + [" " * 5000, "\n" * 700 + "x", "'" * 513, "x'r" * 700]
    assert counter.counts(texts) == library(texts)
    assert [counter.counts([t])[0] for t in texts] == library(texts)


def test_a_worker_that_forgets(classes, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 3)
    monkeypatch.setattr(token_counts, "MEMO_STATES", 40)
    with open(PATH, "rb") as file:
        forgetful = Counter(file.read(), classes)
    chosen = random.Random(5)
    texts = ["".join(chosen.choices("abcdefghij tion 0123456789", k=200)) for _ in range(60)] + ["0a1b" * 500]
    assert forgetful.counts(texts) == library(texts)
    assert len(forgetful.machine.states) <= 41


def test_scan_is_the_walk(classes):
    """Chunk maps and their scan give the pieces that one walk over the text gives."""
    chosen = random.Random(1)
    step, told = piece_tables()
    assert step.shape == (STATES, CLASSES)
    for size in (0, 1, 31, 255, 256, 257, 5000):
        kinds = np.array(chosen.choices(range(CLASSES), k=size), np.uint8)
        state, wanted = 0, set()
        for at, kind in enumerate(kinds):
            marks = told[state, kind]
            wanted |= ({at} if marks & 1 else set()) | ({at - 1} if marks & 2 else set())
            state = step[state, kind]
        assert piece_starts(kinds, (step, told)).tolist() == sorted(wanted)


def test_character_classes_are_the_librarys(classes):
    before = Tokenizer.from_file(PATH).pre_tokenizer
    for point in [*range(0x800), *range(0x2000, 0x2100), *range(0xA7C0, 0xA800), *range(0x3000, 0xD800, 211), *range(0xE000, 0x110000, 997)]:
        alone = [len(before.pre_tokenize_str(c + chr(point))) == 1 for c in "a1!\n"]
        kind = classes[point]
        assert alone == [kind >= token_counts.LETTER, kind == token_counts.NUMBER, kind in (token_counts.SIGN, token_counts.QUOTE), kind in (token_counts.SPACE, token_counts.BLANK)]


def test_all_documents(spark, sf_dir, library):
    docs = load(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    wanted = {r.doc_id: (len(r.text.encode()), n, n > 512) for r, n in zip(rows, library([r.text for r in rows]), strict=True)}
    found = count_tokens(docs, PATH).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == wanted


def test_odd_rows(spark, library):
    docs = odd_documents(spark)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    wanted = sorted(((d, len(t.encode()), n) for (d, t), n in zip(texts, library([t for _, t in texts]), strict=True)), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(docs, PATH).collect()), key=str) == wanted
    assert count_tokens(none_of(docs), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with open(PATH, "rb") as file:
        good = json.load(file)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": {**good["pre_tokenizer"], "add_prefix_space": True}}, {"model": {**good["model"], "type": "Unigram"}}):
        with pytest.raises(ValueError):
            read_tokenizer(json.dumps({**good, **change}).encode())
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        read_tokenizer(file.read())
