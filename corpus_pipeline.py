"""The corpus pipeline: documents through the stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a frame. All but the last
return the columns of ``documents``; the last adds ``token_ids`` and
``decoded``. After mixing a document can occur several times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.common import stage, table
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.piece_bpe import encode_documents
from tidemark.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the rejecting score stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_toxicity(docs, model)
    return scored.filter(F.col(scored.columns[-1]) < toxicity.REJECTED).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, the one with the largest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays, the one with the least id."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources thinned or repeated to their target weights, in the order of the mix."""
    return mix_sources(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text that they decode to."""
    return encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix),
    ("sentencepiece", encode),
]

# The classifier, the alignment and the merge agenda have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
