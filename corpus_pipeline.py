"""From raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pulsekit  # noqa: E402
from pulsekit.llm import langid, mixing, packing, quality, simhash  # noqa: E402
from pulsekit.llm.common import settled, table  # noqa: E402

cloudpickle.register_pickle_by_value(pulsekit)


# Texts are long: tasks hand them to Python in batches of this many rows, unless the session says otherwise.
BATCH_ROWS = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCHES) == "10000":  # Spark's own default
        spark.conf.set(_BATCHES, str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined, by a model learned from all that carry one."""
    _batches(spark)
    return langid.accepted(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    _batches(spark)
    judged = quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return judged.where(f"{judged.columns[-1]}.kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over four-word shingles link at 4 or fewer differing bits."""
    _batches(spark)
    return simhash.keep_one(docs, distance=4, width=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    _batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packed),
]

# Trained models and a seeded schedule decide the rows; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
