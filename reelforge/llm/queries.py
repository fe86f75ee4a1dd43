"""Queries of the training-data operators and, where SQL can say it, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.llm.common import crc_of_id, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.suffix import dedup

    return dedup(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm import packing

    def encoder():
        import public_tokenizers

        return packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))

    return packing.pack(table(spark, sf_dir, "documents"), encoder)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    held = crc_of_id(F.col("doc_id")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm import quality

    held = crc_of_id(F.col("doc_id")) % 4 == 2
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.secrets import scan

    found = scan(table(spark, sf_dir, "documents"))
    bits = F.coalesce(F.array_max(F.transform("values", lambda v: v.bits)), F.lit(0.0))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", F.size("values").cast("long").alias("n_values"), bits.alias("most_bits"))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.media import text_media

    m = text_media(table(spark, sf_dir, "documents"))
    return m.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", F.length("pcm").cast("long").alias("pcm_bytes"), F.sha2("pcm", 256).alias("pcm_sha256"),
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.licenses import scan

    found = scan(table(spark, sf_dir, "documents"))
    parts = F.transform("spans", lambda s: F.concat_ws(":", s.license, s.start, s.end, s.wording, s["diff"]))
    return found.select("doc_id", "n_blocks", "n_found", "licenses", F.concat_ws(",", parts).alias("spans"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelforge.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s
), n AS (
  SELECT *, source_size * (10 // weight) AS need, (sum(source_size) OVER ())::BIGINT AS total FROM w
), p AS (
  SELECT *,
    (3 * total - 4 * coalesce(sum(source_size) OVER (ORDER BY need, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS pool,
    (sum(weight) OVER (ORDER BY need, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest
  FROM n
), q AS (SELECT *, 4 * source_size::HUGEINT * rest < weight * pool AS stops FROM p),
f AS (SELECT pool AS fpool, rest AS frest FROM q WHERE NOT stops ORDER BY need, source IS NULL, source LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN stops THEN (2 * source_size)::DOUBLE ELSE (weight * fpool)::DOUBLE / (2 * frest)::DOUBLE END AS target
  FROM q LEFT JOIN f ON true
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + CASE WHEN draw::DOUBLE < (rate - floor(rate)) * 4294967296.0 THEN 1 ELSE 0 END) AS taken
FROM r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op8_source_mixing": OP8_SQL}
