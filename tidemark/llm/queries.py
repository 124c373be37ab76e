"""The corpus queries over the test tables: (spark, folder) -> result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import license_scan, quality, toxicity
from tidemark.llm.ann_search import nearest_neighbours
from tidemark.llm.collocations import collocations
from tidemark.llm.common import held_out, table
from tidemark.llm.embedding_dedup import embedding_groups
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.lexical_search import ranked_search
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import near_duplicate_classes
from tidemark.llm.piece_bpe import encoding_digests
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_files import token_file_index

END_ID = 2


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _scored(docs: DataFrame, score: str, accepted: float) -> DataFrame:
    return docs.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= accepted).cast("int").alias("predicted"),
    )


def op1_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return _scored(quality.with_quality(docs, model, keep=["doc_id"]), "quality_score", quality.ACCEPTED)


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_induced_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op5_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_groups(table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return license_scan.scan_licenses(docs, license_scan.fit(docs))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_index(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), END_ID)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return _scored(toxicity.with_toxicity(docs, model, keep=["doc_id"]), "toxicity", toxicity.REJECTED)


def op10_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    groups = embedding_groups(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")
    return groups.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_stripe_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op12_ball_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_compression_quality": op1_compression_quality,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_induced_suffix_dedup": op3_induced_suffix_dedup,
    "op4_order_minhash": op4_order_minhash,
    "op5_poisson_mixing": op5_poisson_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_cover_tree": op10_cover_tree,
    "op11_stripe_collocations": op11_stripe_collocations,
    "op12_ball_tree_search": op12_ball_tree_search,
    "op13_collision_counting": op13_collision_counting,
}
