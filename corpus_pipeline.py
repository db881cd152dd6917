"""A training-text pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of documents; the last adds each row's token count, its rate in the mix and whole copies.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontamination, exact_dedup, mixing, ngram_join, toxicity
from tickforge.session import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below one half."""
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text, the one with the smallest identifier."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles, the first."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a positive rate in a mix that meets the target weights; mix_tokens, mix_rate and mix_copies beside them."""
    labelled = mixing.quality_domains(_table(spark, sf_dir, "labels"))
    rows = mixing.mixed(docs, labelled, mixing.TARGETS)
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return rows.select(*columns, F.col("n_tokens").alias("mix_tokens"), F.col("rate").alias("mix_rate"), F.col("copies").alias("mix_copies"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix),
]

#: The first, fourth and fifth stage fit models, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; the stages' tables go to the shared checkpoint folder."""
    folder = os.path.join(checkpoint_dir(spark), f"corpus-pipeline-{uuid.uuid4().hex}")
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        place = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
