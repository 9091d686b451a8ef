"""Rows that operators must stand: nulls, empty and long texts, ties, repeats, clashing columns."""

CLASHING = ["size", "row", "number", "hash", "key", "words", "n_words", "score", "print", "start", "component_id", "n", "whole"]

COPY = "one passage that is copied from text to text and long enough to count as a line of its own"
LONG = " ".join(f"word{i % 977} w{i}" for i in range(30_000))

TEXTS = [
    None,
    "",
    "   \n\n \t",
    "word",
    "Two Words",
    COPY,
    COPY,
    COPY.upper(),
    f"{COPY}\nand a second line, which is different here",
    f"  {COPY}  \n{COPY}\nlast",
    LONG,
    LONG + " end",
    "é 漢字 😀 mixed scripts\r\nand odd\x0bwhite\x0cspace \x85   here",
    "a" * 5000,
    "\n".join(["same line again and again, long enough to be counted"] * 50),
]


def odd_documents(spark, repeat=True):
    """doc_id, text, lang, source, n_chars and columns whose names operators use inside."""
    rows = [(i * 3, t, "en", None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    rows += [(None, COPY, None, "s1", None), (None, None, None, None, None), (999, COPY, "de", "s0", 1)]
    if repeat:
        rows += [rows[5], rows[5], rows[0], rows[-1]]
    rows = [r + tuple(str(n) for n, _ in enumerate(CLASHING)) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


def none_of(df):
    return df.limit(0)
