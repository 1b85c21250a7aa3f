"""Registered queries of the pipeline operators: thin contracts over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavflow.llm import (collocations, exact_dedup, hard_negatives, katz, language_id, line_dedup, mixing, packing, quality,
                         simhash, substring_dedup, url_filter, vector_join)
from eavflow.llm.language_id import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.words(F.col("text")).alias("n_words"))
    return mixing.mix(docs, F.col("n_words")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("norm", exact_dedup.normalised(F.col("text")))
    docs = docs.select("doc_id", "norm", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                       F.coalesce(F.length("text"), F.lit(0)).alias("points"))
    return exact_dedup.exact_dedup(docs, "norm", F.col("points"), keep=["doc_id", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_katz_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    return katz.score(docs, ~out, keep=["doc_id"]).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = packing.pieces(docs, tokenizer_path()).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_quality_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 3, 1)
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~out))
    return quality.classify(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.where(~out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score")


def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "removed", "text")


def op8_embedding_dedup(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_join.near_dedup(vectors).select("vec_id", "n_links", "component_id", "kept")


def op9_simhash_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_dedup(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")


#: Fixed values of the contract: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op10_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_hard_negatives(spark, sf_dir):
    id_, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.hard_negatives(vectors, id_ % 100 == 0)


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_katz_score": op3_katz_score,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_score": op5_quality_score,
    "op6_language_id": op6_language_id,
    "op7_line_dedup": op7_line_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
