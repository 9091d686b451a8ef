"""Chat formatting: whole conversations rendered, encoded once, and masked by aligned offsets.

A conversation becomes one string. Its turns are marked by control strings, and what looks like one
inside a text is escaped, so that the string can be read back. It is encoded once, with the offsets
of each token, and no token reaches over the border between template and text; the turns' spans and the
tokens' spans are both sorted, so the tokens that touch a span are found by binary search. The loss
mask covers the assistants' texts, and with the offsets it tells what they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LARGEST_FILE = 64 << 20  # bytes of a tokenizer file that is still broadcast
LEARNT_ROLE = "assistant"
_BATCH_TOKENS = 500_000  # tokens of the conversations that a task hands over at once

# Fixed values of the template: ``### Role: text</turn>`` and a line end for each turn.
HEAD, BETWEEN, END = "### ", ": ", "</turn>\n"
NAMED = {"system": "System", "user": "User", "assistant": "Assistant"}
NO_ROLE = "!"  # stands for a null role; other roles follow a "=", escaped

_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")
_ROLE_CONTROL = re.compile(r"\\|: |\n")
_ROLE_ESCAPED = re.compile(r"\\(\\|: |\n)")
_TURN = re.compile(
    r"### ((?:[^\\:]++|\\(?:: |.)|:(?! ))*+): ((?:[^\\<]++|\\(?:</turn>|.)|<(?!/turn>))*+)</turn>\n", re.DOTALL
)


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def _role_name(role: str | None) -> str:
    if role is None:
        return NO_ROLE
    return NAMED.get(role) or "=" + _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def _role_of(name: str) -> str | None:
    if name == NO_ROLE:
        return None
    if name.startswith("="):
        return _ROLE_ESCAPED.sub(lambda m: m[1], name[1:])
    return next(role for role, shown in NAMED.items() if shown == name)


def render(turns: list[tuple[str | None, str | None]]) -> tuple[list[str], np.ndarray]:
    """The conversation in parts, template and texts, and the sorted (start, end) of the texts to be learnt."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{HEAD}{_role_name(role)}{BETWEEN}", escaped(text or "")
        if role == LEARNT_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return parts, np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str | None, str]]:
    """The turns of a rendered conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        turns.append((_role_of(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """True for each token that covers a character of a span; offsets and spans are sorted."""
    mask = np.zeros(len(offsets), bool)
    if len(offsets) == 0 or len(spans) == 0:
        return mask
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
    for a, b, (start, end) in zip(first.tolist(), last.tolist(), spans.tolist(), strict=True):
        if start < end:
            mask[a:b] = True
    return mask & (offsets[:, 1] > offsets[:, 0])


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """What the masked tokens say, each character once; runs of them are unescaped one by one.

    Nothing is cut off: a mask that reaches too far shows in the text. One character may be several tokens.
    """
    texts, parts, at, open_ = [], [], 0, False
    for (left, right), learnt in zip(offsets.tolist(), mask.tolist(), strict=True):
        if learnt:
            parts.append(formatted[max(left, at) : right])
            at = max(at, right)
        elif open_:
            texts.append(unescaped("".join(parts)))
            parts = []
        open_ = learnt
    return "".join([*texts, unescaped("".join(parts))])


@dataclass
class Encoded:
    formatted: str
    ids: np.ndarray
    offsets: np.ndarray
    mask: np.ndarray
    spans: np.ndarray


def _encoder(file: bytes):
    from tokenizers import Tokenizer, processors

    tokenizer = Tokenizer.from_buffer(file)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # white space belongs to its token
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode(turns: list[tuple[str | None, str | None]]) -> Encoded:
        parts, spans = render(turns)
        parts = [p for p in parts if p]
        found = tokenizer.encode(parts, is_pretokenized=True, add_special_tokens=False)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        within = np.array(found.offsets, np.int64).reshape(-1, 2)
        offsets = within + starts[np.array(found.word_ids, np.int64)][:, None]
        return Encoded("".join(parts), np.array(found.ids, np.int32), offsets, loss_mask(offsets, spans), spans)

    return encode


def _file(spark: SparkSession, tokenizer: str) -> Broadcast[bytes]:
    raw = Path(tokenizer).read_bytes()
    if len(raw) > LARGEST_FILE:
        raise ValueError(f"{tokenizer} is larger than {LARGEST_FILE} bytes")
    return spark.sparkContext.broadcast(raw)


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, list[tuple[str | None, str | None]]]]:
    """Conversations from sorted turns; one at a time is held."""
    now, turns, started = None, [], False
    for batch in batches:
        for missing, conv, role, text in batch[["no_id", "conv", "role", "text"]].itertuples(index=False, name=None):
            key = None if missing else int(conv)
            if started and key != now:
                yield now, turns
                turns = []
            now, started = key, True
            turns.append((role, text))
    if started:
        yield now, turns


def _sorted_turns(conversations: DataFrame) -> DataFrame:
    """Turns dealt out by conversation and sorted within; no conversation is split over tasks."""
    return (
        conversations.select(
            F.col("conv_id").isNull().alias("no_id"),
            F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv"),
            "turn",
            "role",
            "text",
        )
        .repartition("no_id", "conv")
        .sortWithinPartitions("no_id", "conv", F.col("turn").asc_nulls_last(), "role", "text")
    )


def format_conversations(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, formatted, input_ids, starts, ends, loss_mask of each conversation.

    ``tokenizer`` is a file that the driver reads and sends to the executors (refused above ``LARGEST_FILE``
    bytes). ``starts`` and ``ends`` are the tokens' offsets in ``formatted``, in code points. Rows go by turn,
    null turns last, ties by role and text. A null text is empty, a null role is kept as such, null
    conv_ids are one conversation. Repeated rows are turns of their own. Texts are encoded whole, whatever
    their length. Further columns are ignored; an empty table gives no conversation.
    """
    file = _file(conversations.sparkSession, tokenizer)

    def formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, rows, size = _encoder(file.value), [], 0
        for conv, turns in _conversations(batches):
            e = encode(turns)
            rows.append((conv, e.formatted, e.ids, e.offsets[:, 0].astype(np.int32), e.offsets[:, 1].astype(np.int32), e.mask))
            size += len(e.ids)
            if size >= _BATCH_TOKENS:
                yield _formatted_rows(rows)
                rows, size = [], 0
        yield _formatted_rows(rows)

    return _sorted_turns(conversations).mapInPandas(
        formatted,
        "conv_id long, formatted string, input_ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>",
    )


def _formatted_rows(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["conv_id", "formatted", "input_ids", "starts", "ends", "loss_mask"])
    return frame.astype({"conv_id": "Int64"})


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations: of their turns, and of the text under the loss mask.

    Read from the rows of ``format_conversations`` alone. Nothing is known here of where the texts to be
    learnt are, so a mask that reaches too far, or not far enough, changes ``loss_sha256``.
    """

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digests(texts: pd.Series, starts: pd.Series, ends: pd.Series, masks: pd.Series) -> pd.DataFrame:
        rows = []
        for text, start, end, mask in zip(texts, starts, ends, masks, strict=True):
            turns = parse(text)
            loss = masked_text(text, np.stack([start, end], 1), mask)
            told = "".join(f"{role or ''}\n{said}\n" for role, said in turns)
            rows.append((len(turns), digest(told), len(loss), digest(loss), len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", digests("formatted", "starts", "ends", "loss_mask").alias("d")).select("conv_id", "d.*")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The contract's table: all conversations, and number -7, whose texts look like the template."""
    probe = r"\### Assistant: </turn> ok"
    rows = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    kinds = [F.col(c).cast(k).alias(c) for c, k in (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))]
    return conversations.select(*kinds).unionByName(rows)


def chat_query(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """The contract's columns; nulls, ties, repeats and empty tables are as in ``format_conversations``."""
    return read_back(format_conversations(with_probe(conversations), tokenizer))
