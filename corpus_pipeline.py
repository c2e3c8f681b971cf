"""From raw documents to an encodable training mix: five stages, each over all that its predecessor kept.

Every stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import bbit, bpe, gam, mixing, toxicity, treemerge
from framewright.llm.queries import TOKENIZER
from framewright.llm.store import forget, table
from framewright.session import spread

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.7 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, gam.fold(F.col("doc_id"), 3) != 1)
    return toxicity.keep_clean(docs, model, 0.7)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return treemerge.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest doc_id stays."""
    return bbit.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, stay or go as their source's target says."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as ids and as the text that they decode to, in digests."""
    return bpe.digests(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Learned scores, near-duplicate links and a tokenizer's merges have no SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage wrote is deleted once the next one has read it."""
    docs, before = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), []
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name)
        forget(spark, *before)
        before = [docs]
    return docs
