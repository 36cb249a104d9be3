"""Registered queries of the numbered operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.llm.common import table


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from segmint.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def q_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from segmint.llm.pieces import encode_pieces

    return encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)


def q_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.fm_index import dedup_words

    return dedup_words(table(spark, sf_dir, "documents"), digest=True)


def q_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.suffix_buckets import dedup_bytes

    return dedup_bytes(table(spark, sf_dir, "documents"), digest=True)


def q_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def q_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.metric_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def q_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.hnsw import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.toxicity import score_documents, train

    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.pii import digest, find_personal

    return digest(find_personal(table(spark, sf_dir, "documents")))


def q_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.url_trust import judge_pages

    return judge_pages(table(spark, sf_dir, "pages"))


def q_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


def q_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.merkle import build_manifest, check_manifest, leaf_digest

    # every seventh document, by its id's checksum, is presented with one character more
    more = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.try_add(F.col("n_chars"), F.lit(1)), F.col("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more).alias("tampered")
    return check_manifest(build_manifest(table(spark, sf_dir, "documents"), keep=[tampered]), F.col("tampered"))


def q_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segmint.llm.filter_audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_pii_boosting": q_pii,
    "op2_url_trust": q_url,
    "op3_toxicity_bigru": q_toxicity,
    "op4_best_fit_packing": q_packing,
    "op5_ngram_jaccard": q_ngram,
    "op6_substring_fm_index": q_substring,
    "op7_metric_range_join": q_metric,
    "op8_hnsw": q_hnsw,
    "op9_suffix_buckets": q_suffix,
    "op10_sentencepiece": q_pieces,
    "op11_exact_dedup": q_exact,
    "op12_merkle_manifest": q_merkle,
    "op13_filter_audit": q_audit,
}
