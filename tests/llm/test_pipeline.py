from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pulsekit.llm import packing, queries
from pulsekit.llm.common import word_count

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(queries.SQL) <= set(names)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(k)))
        last, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert before >= counts[0] >= counts[1] >= counts[2] > 0
    kept = spark.read.parquet(str(tmp_path / "2"))
    assert kept.count() == kept.select("doc_id").distinct().count()
    words = kept.select(F.sum(word_count("text"))).first()[0]
    mixed = last.select(F.sum(word_count("text"))).first()[0]
    assert abs(mixed - 1.5 * words) <= 0.05 * words
    assert docs.select(F.sum("length")).first()[0] == packing.pack(last).select(F.sum("length")).first()[0]
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where(f"n > {packing.CAPACITY}").count() == 0


def test_stages_on_nothing_and_odd_rows(spark, odd, none):
    for frame in (none, odd):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            docs.count()
