"""Registered queries of the training-data operators: each applies one operator,
with production parameters, to its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm import byte_bpe, chat, decontamination, embedding_dedup, hard_negatives, html_text, nearest_neighbours, ngram_join, sharding, spelling, substring_dedup, toxicity, warc
from procura.llm.common import read_table

#: Byte limit of a shard.
SHARD_BYTES = 16 << 20
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    sharded = sharding.extendible_shards(docs, "doc_id", F.col("n_bytes"), SHARD_BYTES)
    return sharded.select("doc_id", "n_bytes", "shard", "shard_depth", "shard_bytes", "shard_rows")


def op2_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.contaminated_pairs(docs, "doc_id", "text", items, "item_id", "text")


def learnable(key: str):
    """Labels that may be learned from: those whose key's CRC does not fall in the held-out third."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, read_table(spark, sf_dir, "labels"), "doc_id", F.col("text"), "toxic", learnable("doc_id"))


#: Least score of a document that counts as toxic.
TOXIC = 0.7


def op3_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), "text", toxicity_model(spark, docs, sf_dir))
    held_out = F.coalesce(~learnable("doc_id"), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "evidence")


def op4_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"), "html", ["page_id", "url"])


#: Least cosine of linked vectors.
NEAR_COSINE = 0.95


def op5_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", NEAR_COSINE)


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return cleaned.select("doc_id", "text", "n_sentences", "n_removed")


#: Words of a shingle and least similarity, in per cent, of linked documents.
JOIN_SHINGLE, JOIN_PERCENT = 3, 90


def op7_grouped_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(read_table(spark, sf_dir, "documents"), "doc_id", "text", JOIN_SHINGLE, JOIN_PERCENT)


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    path = warc.write_archives(pages, "page_id", "url", F.encode("html", "UTF-8"))
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url"
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return byte_bpe.encode_decode(docs, "text", public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ["doc_id"], digests=True)


def op10_typed_parts_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    formatted = chat.format_turns(turns.unionByName(probe), "conv_id", "turn", "role", chat.text_part(F.col("text")))
    return chat.read_conversations(formatted, "conv_id", "turn")


def op11_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, "vec_id", label, "embedding", F.col("vec_id") % 100 == 0)


def op12_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours.nearest(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


#: A run of letters loses a character where this divides its checksum.
MISWRITTEN = 199


def op13_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants_of_texts(read_table(spark, sf_dir, "documents"), "doc_id", "text", one_in=MISWRITTEN)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extendible_sharding": op1_extendible_sharding,
    "op2_simhash_windows": op2_simhash_windows,
    "op3_toxicity_neighbours": op3_toxicity_neighbours,
    "op4_tag_path_ratios": op4_tag_path_ratios,
    "op5_sorted_projections": op5_sorted_projections,
    "op6_sentence_spans": op6_sentence_spans,
    "op7_grouped_prefixes": op7_grouped_prefixes,
    "op8_warc_segments": op8_warc_segments,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_typed_parts_chat": op10_typed_parts_chat,
    "op11_threshold_negatives": op11_threshold_negatives,
    "op12_collision_neighbours": op12_collision_neighbours,
    "op13_permuterm_variants": op13_permuterm_variants,
}

OP1_SQL = f"""
WITH h AS (
  SELECT doc_id, COALESCE(strlen(text), 0) AS n_bytes,
         lpad(bin(('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), chr(0))), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
n AS (
  SELECT substr(bits, 1, d) AS node, d, SUM(n_bytes) AS node_bytes
  FROM h, range(0, 40) AS r(d) GROUP BY 1, 2),
depths AS (
  SELECT h.doc_id, h.n_bytes, h.bits, COUNT(n.node) AS shard_depth
  FROM h LEFT JOIN n ON n.node = substr(h.bits, 1, n.d) AND n.node_bytes > {SHARD_BYTES}
  GROUP BY ALL),
shards AS (SELECT *, substr(bits, 1, shard_depth) AS shard FROM depths)
SELECT doc_id, n_bytes, shard, CAST(shard_depth AS INTEGER) AS shard_depth,
       CAST(SUM(n_bytes) OVER (PARTITION BY shard) AS BIGINT) AS shard_bytes,
       COUNT(*) OVER (PARTITION BY shard) AS shard_rows
FROM shards
"""

OP11_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""

#: CRC-32 by a table of its 256 single-byte remainders; near pairs by masked words and left-out characters.
OP13_SQL = f"""
WITH RECURSIVE remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS of_byte),
runs AS (
  SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS k,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{00C0}}-\\x{{00FF}}]{{6,}}')) AS run
  FROM documents),
counted AS (SELECT k, run, COUNT(*) AS c, hex(encode(k || ':' || run)) AS digits FROM runs GROUP BY k, run),
checked AS (
  SELECT run, c, xor(list_reduce(list_transform(range(CAST(length(digits) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(digits, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
                                 lambda h, b: xor(h >> 8, of_byte[(xor(h, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM counted, remainders),
written AS (
  SELECT CASE WHEN h % {MISWRITTEN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM checked),
words AS (SELECT word, CAST(SUM(c) AS BIGINT) AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING SUM(c) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
edits AS (SELECT word, n, i, substr(word, 1, i) AS before, substr(word, i + 2) AS behind FROM places),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM edits a JOIN edits b USING (i, before, behind) WHERE a.word <> b.word
  UNION SELECT e.word, w.word, w.n FROM edits e JOIN words w ON w.word = e.before || e.behind
  UNION SELECT w.word, e.word, e.n FROM edits e JOIN words w ON w.word = e.before || e.behind),
best AS (
  SELECT word, COUNT(*) AS n_near, arg_min(other, {{'less': -other_n, 'other': other}}) AS near, MAX(other_n) AS near_n FROM pairs GROUP BY word),
told AS (
  SELECT w.word, w.n, COALESCE(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS root FROM told
  UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.root WHERE t.form IS NOT NULL)
SELECT t.word, t.form, c.root, t.n, t.n_near, t.form_n
FROM told t JOIN chain c ON c.word = t.word JOIN told e ON e.word = c.root AND e.form IS NULL
"""

LLM_SQL: dict[str, str] = {"op1_extendible_sharding": OP1_SQL, "op11_threshold_negatives": OP11_SQL, "op13_permuterm_variants": OP13_SQL}
