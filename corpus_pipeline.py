"""The training-corpus pipeline: four stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept:

1. ``toxicity``: a machine trained on the labelled texts scores every text; toxic
   ones go.
2. ``near_duplicates``: n-gram Jaccard join (five words, 0.8); of each group of
   linked documents the one with the smallest id stays.
3. ``decontamination``: documents holding an item of ``benchmark`` go.
4. ``packing``: the documents left are packed into training sequences.

The first three return the columns of ``documents``, the last one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indicata.llm import decontam, jaccard, packing, toxicity
from indicata.llm.store import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train_model(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("packing", pack_documents),
]

# No SQL: the first stage is a trained model.  Tested against a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written and reread as the
    next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
