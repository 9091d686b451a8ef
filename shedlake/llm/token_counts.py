"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer's file.

Two deterministic transducers in a row take the tokenizer's place. The first reads classes of
characters and tells where pieces begin, the units that merges never cross. Its states are few, so a
chunk of text is a map from each state it may be entered in to the state it is left in; the maps of
many chunks are worked out side by side, and a parallel prefix scan over them tells in which state each
chunk is entered. The second reads a piece byte by byte, and each of its transitions is annotated with
the tokens that it emits, less those that the byte has merged away. Its states are made when a text
first needs them, as the whole machine would be far larger than the part that texts reach.

That part two can do without looking back rests on two properties of BPE: a piece's tokens without the
last one are those of the shorter text, and a sequence is the one that the merges give if each pair of
neighbours is. So the last token of a prefix is the one that goes with the last token of what is before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

LIMIT = 512  # tokens above which a text is marked
CHUNK = 256  # characters of a chunk
SLICE = 1_000_000  # characters whose chunks are worked out side by side
ENOUGH = 32  # last characters of a chunk, which mostly decide in which state it is left
MEMO = 600_000  # pieces that a worker remembers; beyond it starts anew
MEMO_STATES = 400_000  # states that it remembers
NEVER = 1 << 60  # above all ranks
LONG_PIECE = 64  # characters; longer pieces are not remembered
LARGEST_FILE = 64 << 20  # bytes of a tokenizer file that is still broadcast

# Classes of characters. END stands between texts.
END, SPACE, BLANK, NUMBER, QUOTE, SIGN, LETTER, SINGLE, R, V, E, L = range(12)
# States: what the piece is that is being read. ONE_, MANY_: white space, by its length and last character.
START, WORD, DIGITS, SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CLOSED, ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK = range(13)
STATES, CLASSES = 13, 12
HERE, BEFORE = 1, 2  # what a transition tells: a piece begins at this character, at the one before


def _fresh(kind: int) -> int:
    """The state after the first character of a piece."""
    if kind == END:
        return START
    if kind >= LETTER:
        return WORD
    return {SPACE: ONE_SPACE, BLANK: ONE_BLANK, NUMBER: DIGITS, QUOTE: QUOTED, SIGN: SIGNS}[kind]


def _transition(state: int, kind: int) -> tuple[int, int]:
    """Next state, and where pieces begin (HERE, BEFORE, both or 0)."""
    letter, white = kind >= LETTER, kind in (SPACE, BLANK)
    if kind == END:
        return START, HERE | (BEFORE if state in (QUOTED_R, QUOTED_V, QUOTED_L) else 0)
    if state == WORD and letter or state == DIGITS and kind == NUMBER or state == SIGNS and kind in (SIGN, QUOTE):
        return state, 0
    if state == QUOTED:
        after = {SINGLE: CLOSED, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L, SIGN: SIGNS, QUOTE: SIGNS}.get(kind)
        if after is not None:
            return after, 0
    if (state, kind) in ((QUOTED_R, E), (QUOTED_V, E), (QUOTED_L, L)):
        return CLOSED, 0
    if state in (QUOTED_R, QUOTED_V, QUOTED_L):  # the letter after the quote began a word after all
        return (WORD, BEFORE) if letter else (_fresh(kind), BEFORE | HERE)
    if state in (ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK):
        if white:
            return (MANY_SPACE if kind == SPACE else MANY_BLANK), 0
        if state in (ONE_SPACE, MANY_SPACE):  # the last space goes with what follows
            joined = SIGNS if kind == QUOTE else _fresh(kind)
            return joined, 0 if state == ONE_SPACE else BEFORE
        return _fresh(kind), HERE if state == ONE_BLANK else BEFORE | HERE
    return _fresh(kind), HERE


def piece_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next states and what is told, by state and class."""
    both = [[_transition(s, c) for c in range(CLASSES)] for s in range(STATES)]
    table = np.array(both, np.uint8)
    return np.ascontiguousarray(table[:, :, 0]), np.ascontiguousarray(table[:, :, 1])


def character_classes() -> np.ndarray:
    """The class of every code point, letters and numbers as the tokenizer's library has them."""
    every = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    points, text = np.array([ord(c) for c in every]), "".join(every)
    classes = np.full(0x110000, SIGN, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        inside = np.ones(len(every), bool)
        for _, (low, high) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(text):
            inside[low:high] = False
        classes[points[inside]] = kind
    singles = {" ": SPACE, "'": QUOTE, "r": R, "v": V, "e": E, "l": L, **dict.fromkeys("stmd", SINGLE)}
    for character, kind in singles.items():
        classes[ord(character)] = kind
    return classes


def _scanned(maps: np.ndarray) -> np.ndarray:
    """Compositions of the maps up to and with each, by doubling."""
    done, reach = maps, 1
    while reach < len(done):
        done = np.concatenate([done[:reach], np.take_along_axis(done[reach:], done[:-reach], axis=1)])
        reach *= 2
    return done


def _maps(columns: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The state that each chunk, one a column, is left in for each that it may be entered in."""
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (columns.shape[1], 1))
    for column in columns:
        maps = step[maps.astype(np.intp) * CLASSES + column[:, None]]
    return maps


def piece_marks(kinds: np.ndarray, state: int, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """What the first transducer tells at each character, and its state at the end."""
    step, told = tables[0].ravel(), tables[1].ravel()
    size = len(kinds)
    many = -(-size // CHUNK)
    padded = np.zeros(many * CHUNK, np.intp)
    padded[:size] = kinds
    columns = np.ascontiguousarray(padded.reshape(many, CHUNK).T)
    maps = _maps(columns[CHUNK - ENOUGH :, :-1], step)
    # Where the end of a chunk alone decides, what is before it need not be looked at.
    open_ = np.flatnonzero(maps.min(axis=1) != maps.max(axis=1))
    maps[open_] = _maps(columns[:, open_], step)
    entered = np.concatenate([[state], _scanned(maps)[:, state]]).astype(np.intp)
    marks = np.empty((CHUNK, many), np.uint8)
    left = state
    for at, column in enumerate(columns):
        index = entered * CLASSES + column
        marks[at] = told[index]
        entered = step[index].astype(np.intp)
        if at == (size - 1) % CHUNK:
            left = int(entered[-1])
    return marks.T.ravel()[:size], left


def piece_starts(classes: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Where pieces begin, by the classes of a text's characters, or of texts with END between them."""
    state, begins = START, np.zeros(len(classes) + 1, bool)  # the first place stands for the one before the text
    for low in range(0, len(classes), SLICE):
        marks, state = piece_marks(classes[low : low + SLICE], state, tables)
        begins[low + 1 : low + 1 + len(marks)] |= (marks & HERE) != 0
        begins[low : low + len(marks)] |= (marks & BEFORE) != 0
    return np.flatnonzero(begins[1:])


def _byte_letters() -> dict[str, int]:
    """Bytes by the characters that stand for them in a byte-level vocabulary: printable ones for
    themselves, the others, in order, for those from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def read_tokenizer(raw: bytes) -> dict:
    """Ranks of merges and added tokens of a tokenizer file; refuses what the transducers don't cover."""
    file = json.loads(raw)
    model, before = file["model"], file["pre_tokenizer"] or {}
    plain = ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or before.get("type") != "ByteLevel" or any(model.get(k) for k in plain):
        raise ValueError("only byte-level BPE files are covered")
    if file["normalizer"] or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("normalizers, prefix spaces and other patterns are not covered")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
        raise ValueError("added tokens that take in what is around them are not covered")
    letters = _byte_letters()
    ranks = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks[bytes(letters[c] for c in left), bytes(letters[c] for c in right)] = rank
    return {"ranks": ranks, "added": [t["content"] for t in file["added_tokens"]]}


class Machine:
    """The second transducer, made as far as it is used.

    A state is the longest end of the text that some token begins with, and for each place in it the
    last token before that place and the count of tokens up to there, less the count at the end.
    """

    def __init__(self, ranks: dict[tuple[bytes, bytes], int]) -> None:
        self.halves = {left + right: (left, right, rank) for (left, right), rank in ranks.items()}
        if len(self.halves) < len(ranks):
            raise ValueError("files in which two merges give one token are not covered")
        self.ranks: dict[bytes, dict[bytes, int]] = {}
        for (left, right), rank in ranks.items():
            self.ranks.setdefault(left, {})[right] = rank
        tokens = [bytes([b]) for b in range(256)] + list(self.halves)
        self.beginnings = {t[:n] for t in tokens for n in range(1, len(t) + 1)}
        self.comes_out: dict[bytes, bool] = {bytes([b]): True for b in range(256)}
        self.clear()

    def clear(self) -> None:
        first = (b"", ((b"", 0),))
        self.numbers: dict[tuple, int] = {first: 0}
        self.states: list[tuple] = [first]
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def _edge(self, token: bytes, side: int, until: int) -> list[tuple[bytes, int]]:
        """The parts that lie at a token's left (0) or right (1) end while it is made, the whole first,
        each with the rank of the merge that takes it up."""
        parts = []
        while True:
            parts.append((token, until))
            if token not in self.halves:
                return parts
            until = self.halves[token][2]
            token = self.halves[token][side]

    def _apart(self, left: bytes, right: bytes, until: int) -> bool:
        """Whether no merge up to rank ``until`` joins an end of ``left`` to one of ``right``.

        Merges go by rank, and among equals from the left: one across the border comes before one on
        its right with the same rank, and after one on its left.
        """
        right_parts = self._edge(right, 0, until)
        for part, taken in self._edge(left, 1, until):
            row = self.ranks.get(part)
            if row is not None:
                for other, other_taken in right_parts:
                    rank = row.get(other)
                    if rank is not None and rank < taken and rank <= other_taken and rank < until:
                        return False
        return True

    def _is_token(self, text: bytes) -> bool:
        """Whether the merges make one token of this text; not all tokens of a file ever come out."""
        known = self.comes_out.get(text)
        if known is None:
            known = text in self.halves
            if known:
                left, right, rank = self.halves[text]
                earlier = all(self.halves.get(x, (0, 0, -1))[2] < rank for x in (left, right))
                known = earlier and self._is_token(left) and self._is_token(right) and self._apart(left, right, rank)
                self.comes_out[text] = known
        return known

    def _made(self, state: int, byte: int) -> tuple[int, int]:
        tail, places = self.states[state]
        tail += bytes([byte])
        while tail not in self.beginnings:
            tail, places = tail[1:], places[1:]
        for skip in range(len(tail)):
            token = tail[skip:]
            if self._is_token(token) and (not places[skip][0] or self._apart(places[skip][0], token, NEVER)):
                last, emitted = token, places[skip][1] + 1
                break
        # Counts are relative to the end, so the states do not grow with the text.
        after = (tail, (*((t, n - emitted) for t, n in places), (last, 0)))
        number = self.numbers.get(after)
        if number is None:
            full = len(self.states) >= MEMO_STATES
            if full:
                self.clear()
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
            self.steps.append({})
            if full:
                return number, emitted
        self.steps[state][byte] = number, emitted
        return number, emitted

    def count(self, piece: bytes) -> int:
        """Tokens of a piece: the sum of what its transitions emit."""
        state = emitted = 0
        for byte in piece:
            state, more = self.steps[state].get(byte) or self._made(state, byte)
            emitted += more
        return emitted


class Counter:
    """Both transducers of a tokenizer."""

    def __init__(self, raw: bytes, classes: np.ndarray) -> None:
        file = read_tokenizer(raw)
        self.machine = Machine(file["ranks"])
        self.tables, self.classes = piece_tables(), classes
        added = sorted(file["added"], key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, special strings inside texts counting as the one token they stand for."""
        totals, owner, parts = np.zeros(len(texts), np.int64), [], []
        for at, text in enumerate(texts):
            inner = self.added.split(text) if self.added else [text]
            totals[at] = len(inner) - 1
            parts += inner
            owner += [at] * len(inner)
        joined = "\0".join(parts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.array([len(p) + 1 for p in parts], np.int64)) - 1
        kinds = self.classes[points]
        kinds[ends] = END
        starts = piece_starts(kinds, self.tables)
        starts, stops = starts[:-1], starts[1:]
        real = kinds[starts] != END
        starts, stops = starts[real], stops[real]
        pieces = [joined[a:z] for a, z in zip(starts.tolist(), stops.tolist(), strict=True)]
        found, long = list(map(self.known.get, pieces)), []
        for piece in {p for p, n in zip(pieces, found, strict=True) if n is None}:
            self.known[piece] = self.machine.count(piece.encode())
            long += [piece] if len(piece) > LONG_PIECE else []
        if None in found:
            found = list(map(self.known.__getitem__, pieces))
        for piece in long:
            del self.known[piece]
        if len(self.known) > MEMO:
            self.known.clear()
        text_of = np.array(owner, np.int64)[np.searchsorted(ends, starts)]
        totals += np.bincount(text_of, weights=found, minlength=len(texts)).astype(np.int64) if found else 0
        return totals.tolist()


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``documents``: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is a byte-level BPE file, readable by the driver, which sends it to the executors
    (it is refused above ``LARGEST_FILE`` bytes). Counts are those of the file's library over the whole
    text, without begin or end tokens, special strings inside texts being special. Null and empty
    texts have 0 bytes and tokens, repeated rows come back repeated, an empty table gives no rows,
    further columns are ignored. Texts of any length are worked through in slices of ``SLICE`` characters, and a piece of any
    length in one run of its bytes.
    """
    raw = Path(tokenizer).read_bytes()
    if len(raw) > LARGEST_FILE:
        raise ValueError(f"{tokenizer} is larger than {LARGEST_FILE} bytes")
    read_tokenizer(raw)
    # Bounded: the file, and a byte per code point. A worker keeps what it has compiled beside them.
    file = documents.sparkSession.sparkContext.broadcast({"raw": raw, "classes": character_classes()})

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held_here = file.value
        if "counter" not in held_here:
            held_here["counter"] = Counter(held_here["raw"], held_here["classes"])
        counter = held_here["counter"]
        for texts in batches:
            out, held, size = [], [], 0
            for text in texts:
                held.append(text)
                size += len(text)
                if size >= SLICE:
                    out += counter.counts(held)
                    held, size = [], 0
            if held:
                out += counter.counts(held)
            yield pd.Series(out, dtype="int64")

    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), counted(text).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
