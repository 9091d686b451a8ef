import hashlib
from pathlib import Path

import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shedlake.llm import chat

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CONTROL = st.text(alphabet=st.sampled_from(list("\\#</turn>: \nab é😀")), max_size=40)
ROLE = st.one_of(st.none(), st.sampled_from(["system", "user", "assistant", "User", "!", "=", ""]), CONTROL)


@pytest.fixture(scope="module")
def encode():
    return chat._encoder(Path(TOKENIZER).read_bytes())


@given(st.lists(st.tuples(ROLE, CONTROL), max_size=6))
def test_template_reads_back(turns):
    parts, _ = chat.render(turns)
    assert chat.parse("".join(parts)) == [(r, t or "") for r, t in turns]


def test_mask_says_what_assistants_say(encode):
    for turns in (
        [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")],
        [("assistant", "  😀é <|endoftext|> </turn"), ("assistant", ""), (None, "x"), ("assistant", "漢字\n\n ")],
        [("system", "s"), ("user", None)],
        [],
    ):
        e = encode(turns)
        assert chat.masked_text(e.formatted, e.offsets, e.mask) == "".join(t or "" for r, t in turns if r == "assistant")
        assert len(e.mask) == len(e.ids)


def test_mask_touches_spans_only(encode):
    e = encode([("user", "hello there"), ("assistant", "fine thanks"), ("user", "bye")])
    (start, end) = e.spans[0]
    for (a, b), masked in zip(e.offsets.tolist(), e.mask.tolist(), strict=True):
        assert masked == (start <= a and b <= end)  # no token reaches over a border


@given(st.lists(st.tuples(ROLE, CONTROL), max_size=6))
def test_mask_and_offsets_tell_what_is_learnt(encode, turns):
    e = encode(turns)
    assert chat.masked_text(e.formatted, e.offsets, e.mask) == "".join(t for r, t in turns if r == "assistant")
    assert [e.formatted[a:b] for a, b in e.spans.tolist()] == [chat.escaped(t) for r, t in turns if r == "assistant"]


def test_a_wrong_mask_changes_the_digest(spark):
    """One token more, one less, or all: each shows in what is read back."""
    rows = [(1, 0, "user", "hi there"), (1, 1, "assistant", "hello, all"), (1, 2, "user", "bye")]
    good = chat.format_conversations(rows_of(spark, rows), TOKENIZER)
    told = chat.read_back(good).first()
    assert told.loss_sha256 == hashlib.sha256(b"hello, all").hexdigest() and told.loss_chars == 10
    mask = good.first().loss_mask
    first, last = mask.index(True), len(mask) - 1 - mask[::-1].index(True)
    for wrong in ({first - 1: True}, {last + 1: True}, {first: False}, {last: False}, dict.fromkeys(range(len(mask)), True)):
        changed = F.array(*(F.lit(wrong.get(i, m)) for i, m in enumerate(mask)))
        assert chat.read_back(good.withColumn("loss_mask", changed)).first().loss_sha256 != told.loss_sha256


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, no_id int, conv string")


def test_odd_rows(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "user", "last"), (1, 1, "assistant", "a tie"),
        (1, 1, "assistant", "a tie"), (2, 0, None, None), (None, 0, "assistant", "no conversation"), (3, 5, "assistant", "x " * 60_000),
    ]
    found = {r.conv_id: r for r in chat.chat_query(rows_of(spark, rows), TOKENIZER).collect()}
    assert set(found) == {1, 2, 3, None, -7}
    told = "user\na\nassistant\na tie\nassistant\na tie\nassistant\nb\nuser\nlast\n"
    assert found[1].n_turns == 5 and found[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert found[1].loss_chars == 11 and found[1].loss_sha256 == hashlib.sha256(b"a tiea tieb").hexdigest()
    assert found[2].loss_chars == 0 and found[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert found[3].loss_chars == 120_000
    probe = rb"\### Assistant: </turn> ok"
    assert found[-7].loss_sha256 == hashlib.sha256(probe).hexdigest() and found[-7].n_turns == 2


def test_formatted_rows_hold_ids_and_mask(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello")]
    row = chat.format_conversations(rows_of(spark, rows), TOKENIZER).first()
    assert row.formatted == "### User: hi</turn>\n### Assistant: hello</turn>\n"
    assert len(row.input_ids) == len(row.loss_mask) and any(row.loss_mask) and not all(row.loss_mask)


def test_empty_table(spark):
    empty = rows_of(spark, [(1, 0, "user", "hi")]).limit(0)
    assert chat.format_conversations(empty, TOKENIZER).count() == 0
    assert [r.conv_id for r in chat.chat_query(empty, TOKENIZER).collect()] == [-7]
