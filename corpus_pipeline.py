"""The corpus pipeline: documents through quality, near-dedup, passage dedup, decontamination, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept.  All but the
last return the columns of ``documents``.  ``run`` writes each stage's rows to the shared folder
and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoweave.llm import circulant_minhash, decontaminate, piece_codec, quality_fm, suffix_dedup
from chronoweave.llm.common import ship, table
from chronoweave.session import materialized


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_fm.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (5-word shingles, similarity 0.8) one document stays."""
    ship(spark)
    return circulant_minhash.representatives(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that stand anywhere else go from the texts."""
    ship(spark)
    return suffix_dedup.remove(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows go from the texts."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token ids, checked by decoding."""
    ship(spark)
    return piece_codec.stage(docs)


STAGES = [
    ("quality_fm", quality),
    ("circulant_minhash", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontaminate", benchmark_passages),
    ("piece_codec", pieces),
]

#: The classifier's scores and the pieces' ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
