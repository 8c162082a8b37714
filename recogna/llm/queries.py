"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recogna.llm import (
    conversation_trie, language, line_dedup, packing, pii, piece_lattice, quality, simhash, source_audit, token_records, topk_search, url_filter, vector_dedup,
)
from recogna.llm.common import known_to_workers, table

TOKENIZERS = {"bytes": "byte_bpe_50k.json", "words": "word_bpe_49k.json", "pieces": "piece_bpe_32k.model"}


def tokenizer_path(kind: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZERS[kind])


#: Stands for the secret that a production job takes from its own store.
PII_KEY = "recogna-surrogates"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path("bytes"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.encoded_documents(table(spark, sf_dir, "documents"), tokenizer_path("words"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and, from them, the text again: number and checksum of the ids, hash of the decoded text."""
    pieces = piece_lattice.Pieces.load(tokenizer_path("pieces"))
    out = piece_lattice.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip"))


URL_RULES = [
    url_filter.UrlRule("allow", "com", "/"),
    url_filter.UrlRule("block", "example.com", "/en/"),
    url_filter.UrlRule("allow", "www.example.com", "/en/"),
    url_filter.UrlRule("block", "net", "/es/"),
    url_filter.UrlRule("block", "net", "/fr/"),
]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audited(table(spark, sf_dir, "documents"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        known_to_workers(spark)
        return run(spark, sf_dir)

    return query


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_pii_surrogates, op2_line_dedup, op3_best_fit_packing, op4_simhash_near_dedup, op5_token_records,
        op6_sentencepiece, op7_url_filters, op8_quality_rules, op9_language_id, op10_embedding_near_dedup,
        op11_source_audit, op12_topk_search, op13_conversation_trie,
    )
}
#: White space of the word and line rules, and A-Z lower-cased, in DuckDB.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate(trim(line, {white}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format(white=_WHITE)

ORACLES: dict[str, str] = {
    "op2_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (SELECT *, {_LOWER} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY doc_id
""",
    "op8_quality_rules": f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: trim(l, {_WHITE}) <> '') AS ls
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM words WHERE len(ws) >= 3
), placed AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM placed WHERE n > 1) GROUP BY doc_id),
counted AS (
  SELECT w.doc_id, w.text, len(ls) AS n_lines, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND NOT n_symbols / greatest(n_words, 1) > 0.1
  AND NOT n_dup_lines / greatest(n_lines, 1) > 0.5
  AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 25
  AND NOT (length(text) - length(regexp_replace(text, '\\p{{Lu}}+', '', 'g'))) / greatest(word_chars, 1) > 0.5
  AND NOT (length(text) - length(replace(text, '!', ''))) / greatest(n_words, 1) > 0.5
  AND NOT (length(text) - length(regexp_replace(text, '\\p{{L}}+', '', 'g'))) / greatest(word_chars, 1) < 0.5 AS kept
FROM judged
""",
    "op11_source_audit": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS MATERIALIZED (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grid AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term) AS n_lang, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS total_lang, v
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k ON g.lang = k.lang JOIN sizes s ON g.lang = s.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (total + 5 * v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (n_lang + 5)) // (total_lang + 5 * v) AS q
  FROM grid
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""",
    "op12_topk_search": """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.r AS q, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op13_conversation_trie": """
WITH own AS MATERIALIZED (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s,
    list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda t, z: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END),
      4294967295) AS crc
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), convs AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(b.s[1:xor(c.crc, 4294967295) % 6], []), c.s[xor(c.crc, 4294967295) % 6 + 1:]) AS s
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), nodes AS MATERIALIZED (
  SELECT s[1:d] AS seq, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = d) AS ids
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM convs) GROUP BY s[1:d], d
), valued AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, (n.n_convs - 1) * coalesce(length(n.seq[n.d].t), 0) AS saved,
    (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.seq[1:n.d] = n.seq) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.seq = n.seq[1:n.d - 1]
), below AS (
  SELECT seq[1:a] AS seq, a AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT seq, saved, n_children, unnest(range(d + 1)) AS a FROM valued) GROUP BY seq[1:a], a
)
SELECT v.conv_id, v.d AS depth, v.parent_conv_id, v.n_convs, v.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(coalesce(v.ids, '')) AS ends_sha256
FROM valued v JOIN below b ON b.d = v.d AND b.seq = v.seq
""",
}
