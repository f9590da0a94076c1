"""The ``opN_*`` queries: each operator on its whole table, with its contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, decontaminate, language_id, mixing, ngram_join, spelling, url_filter, vector_codes, warc
from .common import table
from .licenses import license_columns, scan_licenses
from .token_counts import count_tokens
from .token_store import store_digests

END_ID = 2
MAX_TOKENS = 4096


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), END_ID)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_columns(scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select(F.col("doc").alias("doc_id"), "n_tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)], "rate",
                        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), language_id.train(docs))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(F.col("doc").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ngram_join.jaccard_groups(table(spark, sf_dir, "documents"))
    return got.select(F.col("doc").alias("doc_id"), "class_id", "n_links")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digests(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_license_scan": op2_license_scan,
    "op3_mixing": op3_mixing,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_ngram_join": op9_ngram_join,
    "op10_nearest": op10_nearest,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE: dict[str, str] = {"op5_decontaminate": decontaminate.ORACLE, "op6_warc": warc.ORACLE, "op11_spelling_variants": spelling.ORACLE,
                          "op13_vector_codes": vector_codes.ORACLE}
