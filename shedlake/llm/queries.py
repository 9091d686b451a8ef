"""The queries of the operators, each over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shedlake.llm import (
    chat,
    collocations,
    decontamination,
    extraction,
    importance,
    line_dedup,
    mixing,
    near_vectors,
    quality,
    simhash,
    substrings,
    token_counts,
    toxicity,
)
from shedlake.llm.common import load


def _byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document. Odd rows and empty tables are as in ``quality.score_documents``."""
    return quality.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; null and empty pages give an empty one, as in ``extraction.extract_pages``."""
    return extraction.extract_pages(load(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the benchmark has; nulls, repeats and empty tables are as in ``contamination``."""
    return decontamination.contamination_query(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector; unusable vectors link with nothing, as in ``dedup_vectors``."""
    return near_vectors.dedup_vectors(load(spark, sf_dir, "embeddings"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation and of the probe; an empty table leaves the probe alone."""
    return chat.chat_query(load(spark, sf_dir, "conversations"), _byte_bpe())


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words have fingerprint zero, as in ``simhash_dedup``."""
    return simhash.simhash_dedup(load(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document keeps; a null or empty text is one empty line, as in ``dedup_lines``."""
    return line_dedup.dedup_query(load(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document. Odd rows and empty tables are as in ``toxicity.score_documents``."""
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a repeated passage, a row each; null and empty texts have none, as in ``repeated_passages``."""
    return substrings.substring_query(load(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; a null source is one of its own, as in ``mix_sources``."""
    return mixing.mix_query(load(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language; an empty table gives none, as in ``collocations.collocations``."""
    return collocations.collocations(load(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; null and empty texts have 0, as in ``count_tokens``."""
    return token_counts.count_tokens(load(spark, sf_dir, "documents"), _byte_bpe())


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document; texts without words weigh 0, as in ``resample``."""
    return importance.resample_query(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_AHEAD = ", ".join(f"lead(word, {i}) OVER o" for i in range(1, 10))
DECONTAMINATION_SQL = f"""
WITH worded AS (
    SELECT doc_id, {_WORDS} AS words FROM documents
), items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS words FROM benchmark
), sized AS (
    SELECT *, least(len(words), 10) AS span FROM items WHERE len(words) > 0
), spans AS (
    SELECT DISTINCT item, span, array_to_string(words[start:start + span - 1], ' ') AS text
    FROM (SELECT *, unnest(range(1, len(words) - span + 2)) AS start FROM sized)
), tokens AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM worded
), ahead AS (
    SELECT doc_id, p, [word, {_AHEAD}] AS words FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), runs AS (
    SELECT doc_id, p, span, array_to_string(words[1:span], ' ') AS text
    FROM ahead, (SELECT DISTINCT span FROM spans) WHERE words[span] IS NOT NULL
), hits AS (
    SELECT doc_id, p, span, item FROM runs JOIN spans USING (span, text)
), covered AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + span)) AS spot FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list
    FROM hits GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reach.vec_id, linked.b FROM reach JOIN linked ON reach.other = linked.a
), least AS (
    SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), degree AS (
    SELECT a AS vec_id, count(*) AS n_links FROM linked GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN degree USING (vec_id)
"""

CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(14 + CASE WHEN role IS NULL THEN 1 WHEN role IN ('system', 'user', 'assistant') THEN length(role)
                ELSE 1 + length(regexp_replace(role, '(\\|: |\n)', '\\\1', 'g')) END
           + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

LINE_DEDUP_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), often AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT doc_id, line, position, coalesce(doc_id < keeper, false) AS dropped FROM keyed LEFT JOIN often USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), runs AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM worded, range(1, 6) AS t(k) WHERE len(w) >= k
), counts AS (
    SELECT lang, k, phrase, count(*) AS n FROM runs GROUP BY lang, k, phrase HAVING count(*) >= 100
), often AS (
    SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1
), inside AS (
    SELECT lang, part, max(a) AS most FROM (
        SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda size: list_transform(
            range(1, k - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))))) AS part
        FROM often
    ) GROUP BY lang, part
), cuts AS (
    SELECT often.*, unnest(range(1, k)) AS cut FROM often LEFT JOIN inside ON often.lang = inside.lang AND phrase = part
    WHERE coalesce(100 * most, 0) < 100 * a
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r, t.n,
           ((1000::HUGEINT * c.a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
    FROM cuts c JOIN totals t ON c.lang = t.lang
    JOIN counts x ON c.lang = x.lang AND array_to_string(c.w[1:c.cut], ' ') = x.phrase
    JOIN counts y ON c.lang = y.lang AND array_to_string(c.w[c.cut + 1:], ' ') = y.phrase
), least AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM least QUALIFY rank <= 2000
"""

# The checksum of each distinct word, byte by byte; the table of single bytes follows from its polynomial.
IMPORTANCE_SQL = f"""
WITH bits AS (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
               lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS t(i)
), stepped AS (
    SELECT list(c ORDER BY i) AS step FROM bits
), worded AS (
    SELECT doc_id, {_WORDS} AS words FROM documents
), goal AS (
    SELECT {_WORDS} AS words FROM benchmark
), distinct_words AS (
    SELECT DISTINCT word, hex(encode(word)) AS h
    FROM (SELECT unnest(words) AS word FROM worded UNION ALL SELECT unnest(words) FROM goal)
), bucketed AS (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(step[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM distinct_words, stepped
), s AS (
    SELECT bucket, count(*) AS s FROM (SELECT unnest(words) AS word FROM worded) JOIN bucketed USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS t FROM (SELECT unnest(words) AS word FROM goal) JOIN bucketed USING (word) GROUP BY bucket
), sums AS (
    SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS all_s, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS all_t
), gain AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), sums
), weighed AS (
    SELECT doc_id, sum(gain)::BIGINT AS weight
    FROM (SELECT doc_id, unnest(words) AS word FROM worded) JOIN bucketed USING (word) JOIN gain USING (bucket)
    GROUP BY doc_id
), scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
    FROM worded LEFT JOIN weighed USING (doc_id)
), placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_html_extraction": op2_html_extraction,
    "op3_decontamination": op3_decontamination,
    "op4_near_vectors": op4_near_vectors,
    "op5_chat_format": op5_chat_format,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_source_mix": op10_source_mix,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_importance": op13_importance,
}

ORACLES: dict[str, str] = {
    "op3_decontamination": DECONTAMINATION_SQL,
    "op4_near_vectors": NEAR_VECTORS_SQL,
    "op5_chat_format": CHAT_SQL,
    "op7_line_dedup": LINE_DEDUP_SQL,
    "op11_collocations": COLLOCATIONS_SQL,
    "op13_importance": IMPORTANCE_SQL,
}
