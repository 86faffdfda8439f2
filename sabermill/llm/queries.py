"""The registered queries of the operators, and SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sabermill.llm.chat import digests, format_chats, log_of
from sabermill.llm.decontaminate import decontaminate
from sabermill.llm.embeddings import link_embeddings
from sabermill.llm.extraction import extract
from sabermill.llm.hard_negatives import hard_negatives
from sabermill.llm.near_duplicates import near_duplicates
from sabermill.llm.pieces import decode_documents, encode_documents
from sabermill.llm.quality import classify
from sabermill.llm.recipes import exact_duplicates
from sabermill.llm.substrings import remove_repeats
from sabermill.llm.tables import table
from sabermill.llm.token_counts import count_tokens
from sabermill.llm.token_files import read_tokens, write_tokens
from sabermill.llm.whitening import whiten
from sabermill.session import fresh_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark found in each document."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that a window of 20 repeats from earlier on."""
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    spaced = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce(spaced, F.lit("")), 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = fresh_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, BYTE_BPE, special_tokens=True)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    done = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "held_out", "score", "predicted")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return link_embeddings(table(spark, sf_dir, "embeddings"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    done = decode_documents(encode_documents(table(spark, sf_dir, "documents"), PIECES), PIECES)
    given = F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))
    ids = F.xxhash64("piece_ids").alias("ids_hash")
    return done.select("doc_id", "n_pieces", ids, F.char_length("decoded").cast("long").alias("n_chars"), (F.col("decoded") == given).alias("round_trip"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, special_tokens=True)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_md5")


def op10_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and one that quotes control strings, from their logs to formatted text and back."""
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", quoting), (-7, 1, "assistant", quoting)], stored.schema)
    return digests(format_chats(log_of(stored.unionByName(planted))))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding and its positives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened values of all embeddings; a deviation beyond 64 bits is null."""
    done = whiten(table(spark, sf_dir, "embeddings"))
    return done.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substrings": op2_substrings,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_embeddings": op5_embeddings,
    "op6_pieces": op6_pieces,
    "op7_main_text": op7_main_text,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_chats": op10_chats,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_exact_duplicates": op13_exact_duplicates,
}

SQL = {
    "op11_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda c: floor(256 * c)) AS x, row_number() OVER () AS no
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.no AS anchor_no, a.vec_id AS anchor_id, c.no, c.vec_id, a.label = c.label AS same,
    CASE WHEN len(a.x) = 0 THEN 0 ELSE list_inner_product(a.x, c.x)::BIGINT END AS score
  FROM v a JOIN v c ON a.no <> c.no AND len(a.x) = len(c.x) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_no ORDER BY score DESC, vec_id NULLS LAST, no) <= 5
), found AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_no, p.no ORDER BY n.score DESC, n.vec_id NULLS LAST, n.no) AS rank
  FROM positives p JOIN scored n ON p.anchor_no = n.anchor_no AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 5
""",
    "op13_exact_duplicates": r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, sha256(text) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
WINDOW g AS (PARTITION BY text)
""",
    "op5_embeddings": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), smallest AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM smallest LEFT JOIN counted USING (vec_id)
""",
    "op10_chats": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, length('<|turn|><|text|><|end|>') + length(role) + length(replace(replace(replace(replace(replace(replace(text,
    '\', '\\'), '<|', '<\|'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) AS chars
  FROM rows
)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
""",
    "op2_substrings": r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), placed AS (
  SELECT doc_id, begins, sha256(array_to_string(words[begins:begins + 19], ' ')) AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS begins FROM w)
), later AS (
  SELECT doc_id, begins FROM placed
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, begins) > 1
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(begins, begins + 20)) AS nth FROM later
), kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.nth) AS words, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS nth FROM w) a
  ANTI JOIN removed USING (doc_id, nth) GROUP BY a.doc_id
)
SELECT doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op1_decontaminate": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), sized AS (
  SELECT item_id, words, least(10, len(words)) AS n FROM i WHERE len(words) > 0
), wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(words[begins:begins + n - 1], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS begins FROM sized)
), placed AS (
  SELECT doc_id, n, begins, array_to_string(words[begins:begins + n - 1], ' ') AS passage
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS begins
        FROM d CROSS JOIN (SELECT DISTINCT n FROM wanted) WHERE len(words) >= n)
), found AS (
  SELECT doc_id, item_id, n, begins FROM placed JOIN wanted USING (n, passage)
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(begins, begins + n)) AS word FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
