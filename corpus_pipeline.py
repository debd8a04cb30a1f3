"""A corpus made ready for training, in five stages: toxic documents go, exact and near
copies go, sources are mixed to their weights, texts become token ids.

Each stage reads all rows its predecessor kept, as Parquet. Copies of a document that
the mix takes more than once are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from ledgerloom.llm.common import free_name, pick, staged, table
from ledgerloom.llm.queries import ranks


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that score below one half."""
    labels = pick(table(spark, sf_dir, "labels"), ("doc_id", "long"), ("toxic", "int"))
    model = toxicity.train_model(pick(docs, ("doc_id", "long"), ("text", "string")), labels)
    score, passages = (free_name(n, docs.columns) for n in ("score", "passages"))
    scored = toxicity.score(docs, model, score=score, passages=passages)
    return scored.filter(F.col(f"`{score}`") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the most code points, then the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word n-grams, similarity 0.8 or more: keep the smallest id of each group."""
    return ngram_join.keep_one(docs, width=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents as the mix says."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the byte offsets the tokens end at."""
    encoded = bpe.encode(pick(docs, ("doc_id", "long"), ("text", "string")), ranks())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "token_ends")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: Models, seeded selection and connected components are not SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
