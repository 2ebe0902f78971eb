"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waybill.llm import chat, collocations, decontamination, fingerprints, html_extraction, minhash, packing, prefix_trie, quality_rules, secrets, sharding, substring_dedup, suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rules = quality_rules.fit(docs, table(spark, sf, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query
def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove(table(spark, sf, "documents")).drop("kept_text")


@query
def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf, "documents")).drop("kept_bytes")


@query
def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.check(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("spans", "items")


@query
def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.groups(table(spark, sf, "documents"))


@query
def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


@query
def op6_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf, "pages"))


@query
def op1_chat(spark: SparkSession, sf: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digests(chat.format_chats(rows))


@query
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf, "conversations"))


# CRC-32 of the decimal id bit by bit; prefixes are told apart by chained SHA-256.
ORACLE["op13_prefix_trie"] = """
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, digits, step, value) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 0, 4294967295::BIGINT FROM (SELECT DISTINCT conv_id FROM turns)
  UNION ALL
  SELECT conv_id, digits, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END
  FROM (SELECT conv_id, digits, step, CASE WHEN step % 8 = 0 THEN xor(value, ascii(digits[step // 8 + 1])::BIGINT) ELSE value END AS v FROM crc WHERE step < 8 * length(digits))),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(value, 4294967295::BIGINT) % 6 AS h FROM crc WHERE step = 8 * length(digits)),
rebuilt AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM (
    SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h)),
paths(conv_id, depth, node, parent, chars) AS (
  SELECT conv_id, 0::BIGINT, '', NULL::VARCHAR, 0::BIGINT FROM convs
  UNION ALL
  SELECT p.conv_id, r.depth, sha256(p.node || ':' || length(r.role) || ':' || r.role || r.text), p.node, length(r.text)
  FROM paths p JOIN rebuilt r ON r.conv_id = p.conv_id AND r.depth = p.depth + 1),
ending AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
  SELECT p.depth, p.node, any_value(p.parent) AS parent, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(p.chars) AS chars,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE e.depth = p.depth), '')) AS ends_sha256
  FROM paths p JOIN ending e USING (conv_id) GROUP BY p.depth, p.node),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.parent = n.node),
below AS (
  SELECT a.depth, a.node, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.chars) AS saved_tokens
  FROM paths a JOIN paths b ON b.conv_id = a.conv_id AND b.depth >= a.depth
  JOIN full_nodes d ON d.depth = b.depth AND d.node = b.node AND d.conv_id = b.conv_id GROUP BY a.depth, a.node)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON b.depth = n.depth AND b.node = n.node LEFT JOIN full_nodes up ON up.depth = n.depth - 1 AND up.node = n.parent
"""


@query
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


ORACLE["op11_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE f >= 100),
cuts AS (
  SELECT lang, phrase, k, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.f AS l, y.f AS r, s.n, (1000::HUGEINT * c.a * s.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN sizes s ON s.lang = c.lang
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
whole AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM frequent f WHERE f.lang = b.lang AND f.k > b.k AND 100 * f.f >= 100 * b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM whole QUALIFY rank <= 2000
"""


@query
def op12_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf, "documents"))
