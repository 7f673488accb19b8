"""One query per operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvagrid.llm import decontaminate, divergence, language, licenses, linededup, lm, media, neardup, packing, pages, quality, resample, shards
from silvagrid.llm.common import id_crc, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHARDS = 24


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe() -> str:
    """The public tokenizer's file; it is installed with the library that holds it, on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_media_png(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = media.encode_media(docs).drop("text")
    return media.media_features(stored, ["doc_id", "n_bytes"]).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        F.lower(F.hex("cosine")).alias("feature"),
    )


@query
def op2_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op3_bidirectional_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_language(docs)
    held = (F.pmod(id_crc(), F.lit(5)) == 0).alias("held_out")
    return language.identify(docs.select("doc_id", "text", held), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return shards.assign_shards(docs, [1.0] * SHARDS, [1.0] * (SHARDS + 1)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


@query
def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op7_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(id_crc(), F.lit(5)) == 1
    model = lm.fit(docs.where(~held))
    scored = lm.score(docs.select("doc_id", "text", held.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query
def op9_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    held = (F.pmod(id_crc(), F.lit(4)) == 2).alias("held_out")
    scored = quality.score_quality(docs.select("doc_id", "text", held), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int")).select("doc_id", "held_out", "score", "predicted")


@query
def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the text that is left and what was taken out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_lines(docs, linededup.Chunking(any_line=True))


@query
def op11_positional_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op12_pattern_tree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


@query
def op13_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
