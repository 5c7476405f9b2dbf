"""The corpus pipeline: documents are filtered, deduplicated and packed.

Each stage takes what the stage before kept and returns rows with the columns of ``documents``;
the last returns the pieces of the packed sequences. Between stages the rows are written to the
shared folder, so a lost executor costs no more than the tasks it held.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import exact, neardup, packing, quality, toxicity
from barloom.llm.common import written
from barloom.llm.queries import not_held_out, table, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOXIC_FROM, GOOD_FROM = 0.5, 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not call toxic."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), not_held_out(5, 0), with_text=True)
    return scored.filter(scored["score"] < TOXIC_FROM).select(*docs.columns)


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network calls good."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), not_held_out(4, 2))
    scored = quality.score_quality(docs, model)
    return scored.filter(scored["score"] >= GOOD_FROM).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts."""
    return exact.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies."""
    return neardup.drop_near_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality classifier", of_good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("packing", packed),
]
#: The models of the first two stages cannot be expressed in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i}")
    return docs
