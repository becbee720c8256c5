"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.llm import (bpe, conversation_repair, embedding_dedup, exact_dedup, importance_resampling, packing, quality, secret_scan, sharding, simhash,
                          token_records, toxicity, url_filter)
from hirewire.llm.common import shared_path, table
from hirewire.llm.tokens import public_path

END_ID = 2


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept")


OP2_SQL = r"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls FROM documents),
place AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
gram AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS n FROM place),
step AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS s FROM gram WHERE n > 1),
rep AS (SELECT doc_id, sum(s)::BIGINT AS n FROM step GROUP BY doc_id),
base AS (SELECT w.doc_id, source, substr(md5(t), 1, 16) AS doc, len(ws) AS n_words,
    length(regexp_replace(t, '[ \t-\r]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
    FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
line AS (SELECT doc_id, source, substr(md5(t), 1, 16) AS doc, unnest(ls) AS x FROM w),
hashed AS (SELECT doc_id, source, doc,
    substr(md5(trim(regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '[ \t-\r]+', ' ', 'g'))), 1, 16) AS line,
    len(list_filter(regexp_split_to_array(x, '[ \t-\r]+'), lambda y: y <> '')) AS n FROM line),
keys AS (SELECT doc_id, substr(md5(array_to_string(list_sort(list_distinct(list(line))), '')), 1, 16) AS key FROM hashed GROUP BY doc_id),
keyed AS (SELECT h.*, key FROM hashed h JOIN keys k ON k.doc_id = h.doc_id),
common AS (SELECT source, line, min(doc) AS first FROM keyed GROUP BY source, line HAVING count(DISTINCT key) > 20),
gone AS (SELECT k.doc_id, sum(k.n)::BIGINT AS removed FROM keyed k JOIN common c
    ON k.source IS NOT DISTINCT FROM c.source AND k.line = c.line AND k.doc <> c.first GROUP BY k.doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, coalesce(removed, 0) AS n_removed_words,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * coalesce(removed, 0) <= 80 * n_words AS kept
FROM base b LEFT JOIN gone ON gone.doc_id = b.doc_id
"""


URL_RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
             url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, URL_RULES, url_filter.train(pages))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2, seed=42)


def op5_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.reshard(table(spark, sf_dir, "documents"), shared_path(spark, "reshard"), old_shards=32, new_shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                       F.col("old").alias("old_shard"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), min_cosine=0.98)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(documents, model, threshold=0.3)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", F.size("spans").alias("n_toxic_tokens"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "token-records")
    manifest = token_records.write_records(table(spark, sf_dir, "documents"), folder, public_path("word_bpe_49k.json"), END_ID)
    return token_records.read_records(manifest, folder, digest=True)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secret_scan.digest(secret_scan.scan(documents, secret_scan.train(documents)))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), END_ID, size=1024)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), fraction_percent=10, least_words=20, seed=2024)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit_and_digest(damaged, gone=F.col("lost"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"), keep="largest")


OP13_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


QUERIES = {
    "op1_bpe_codec": (op1_bpe_codec, None),
    "op2_quality_rules": (op2_quality_rules, OP2_SQL),
    "op3_url_filter": (op3_url_filter, None),
    "op4_simhash_dedup": (op4_simhash_dedup, None),
    "op5_reshard": (op5_reshard, None),
    "op6_embedding_dedup": (op6_embedding_dedup, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_token_records": (op8_token_records, None),
    "op9_secret_scan": (op9_secret_scan, None),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_importance_resampling": (op11_importance_resampling, None),
    "op12_conversation_repair": (op12_conversation_repair, None),
    "op13_exact_dedup": (op13_exact_dedup, OP13_SQL),
}
