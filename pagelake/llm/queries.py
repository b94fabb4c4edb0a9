"""Registered queries of the training-data operators, and DuckDB SQL where it can express them.

Each query applies its operator to the whole table and derives the contract's
digest columns from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelake.llm import (bpe, conversation_trie, decontaminate, language_id, line_dedup, pii, quality_model,
                          quality_rules, secrets, simhash, spelling, toxicity, warc)
from pagelake.llm.common import table


def vocabulary_path() -> str:
    """Where the byte-level vocabulary lies (a parameter of the operator, never part of the repository)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"), digests=True)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_stats(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"), digests=True)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), digests=True)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), damage=spelling.DAMAGE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_model": op1_quality_model,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_secrets": op5_secrets,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_bpe": op10_bpe,
    "op11_language_id": op11_language_id,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_spelling": op13_spelling,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------


def _quality_rules_sql() -> str:
    from pagelake.llm.quality_rules import (BOILERPLATE, BOILERPLATE_WORDS, MAX_LOST_PERCENT, MAX_REPEAT_PERCENT,
                                            MIN_WORDS, NAVIGATION_WORDS)

    white = r"[\x20\x09-\x0D]"
    phrases = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT row_id, list_filter(string_split_regex(text, '{white}+'), lambda x: x <> '') AS w FROM docs),
lines AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs),
judged AS (
  SELECT *, len(lw) AS n, len(list_filter(range(1, len(lw)), lambda i: lw[i] = lw[i + 1])) AS stutters
  FROM (SELECT row_id, line, pos, length(regexp_replace(line, '{white}', '', 'g')) AS chars,
         list_filter(string_split_regex(line, '{white}+'), lambda x: x <> '') AS lw,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
         length(regexp_replace(line, '[^!]', '', 'g')) AS shouts,
         right(regexp_replace(line, '{white}+$', ''), 1) AS last_char,
         translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         row_number() OVER (PARTITION BY row_id, line ORDER BY pos) AS copy
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]'))),
by_line AS (
  SELECT row_id, count(*) FILTER (copy > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (
      (symbols >= 3 AND 3 * symbols >= n) OR (shouts >= 3 AND 2 * shouts >= n)
      OR (stutters >= 3 AND 3 * stutters >= n)
      OR (n <= {NAVIGATION_WORDS} AND NOT contains('.!?:;"''”’»)]…', last_char))
      OR (n <= {BOILERPLATE_WORDS} AND ({phrases}))), 0) AS lost_chars
  FROM judged GROUP BY row_id),
grams AS (
  SELECT row_id, pos, w[pos:pos + 4] AS gram
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 3)) AS pos FROM words WHERE len(w) >= 5)),
repeated AS (
  SELECT row_id, count(DISTINCT pos + k) AS n_repeat_words
  FROM (SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, gram) AS n FROM grams), range(5) AS r(k)
  WHERE n > 1 GROUP BY row_id),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '{white}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
  FROM docs JOIN words USING (row_id) LEFT JOIN by_line USING (row_id) LEFT JOIN repeated USING (row_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
       AND 100 * lost_chars <= {MAX_LOST_PERCENT} * word_chars AS kept
FROM counted"""


_TRIE = """
WITH ids AS (
  SELECT conv_id, list_reduce([4294967295::UBIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
         lambda crc, byte: list_reduce([xor(crc, byte)] || list_transform(range(8), lambda x: x::UBIGINT),
                                       lambda v, bit: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))) AS crc
  FROM (SELECT DISTINCT conv_id::BIGINT AS conv_id FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS lead, xor(crc, 4294967295::UBIGINT) % 6 AS h FROM ids),
turns AS (
  SELECT conv_id, id, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos
  FROM (SELECT conv_id::BIGINT AS conv_id, turn, length(coalesce(text, '')) AS size,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS id
        FROM conversations WHERE conv_id IS NOT NULL)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, id, size FROM convs c JOIN turns t ON t.conv_id = c.lead AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, id, size FROM convs JOIN turns USING (conv_id) WHERE pos > h),
paths AS (
  SELECT conv_id, size, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
last AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ended AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
          FROM paths JOIN last USING (conv_id, depth) GROUP BY path),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size
          FROM paths GROUP BY path, depth),
kids AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
shaped AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.path = n.path),
under AS (
  SELECT left(path, 32 * d) AS path, count(*) FILTER (n_children = 0) AS n_leaves,
         CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM shaped) GROUP BY 1)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves, saved_tokens,
       coalesce(ends, sha256('')) AS ends_sha256
FROM shaped s JOIN under u ON u.path = s.path LEFT JOIN ended e ON e.path = s.path
LEFT JOIN nodes p ON s.depth > 0 AND p.path = left(s.path, 32 * (s.depth - 1))"""


ORACLES: dict[str, str] = {
    "op12_conversation_trie": _TRIE,
    "op8_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS d FROM pages),
led AS (SELECT *, CASE WHEN octet_length(b) >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS lead FROM p)
SELECT page_id, octet_length(b) AS payload_bytes, d AS payload_digest,
       CASE WHEN lead IS NULL OR lead IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN lead IS NOT NULL AND lead IS DISTINCT FROM page_id THEN lead END AS refers_to
FROM led""",
    "op6_quality_rules": _quality_rules_sql(),
}
