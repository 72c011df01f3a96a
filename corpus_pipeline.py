"""Corpus pipeline: quality, toxicity, repeated passages, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.  The trained stages fit on the documents they are
given and the labels in ``sf_dir``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.llm import op04_quality, op09_toxicity, queries
from tessera.llm.op02_simhash import keep_one
from tessera.llm.op07_packing import pack
from tessera.llm.op10_lines import dedup_lines
from tessera.session import checkpoint_dir, ship_package, table


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    ship_package(spark)
    score = op04_quality.score_column(docs, table(spark, sf_dir, "labels"))
    return docs.where(score("text") >= 0.5)


def toxicity(spark, docs, sf_dir):
    """Documents that the toxicity classifier rejects go."""
    ship_package(spark)
    model = op09_toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(op09_toxicity.score_column(model, "text") < 0.5)


def repeated_passages(spark, docs, sf_dir):
    """Later copies of repeated passages go from the texts; every document stays."""
    out = dedup_lines(docs)
    changed = F.when(out.n_removed > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed.cast("long")).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group stays."""
    ship_package(spark)
    return keep_one(docs)


def packing(spark, docs, sf_dir):
    """Every token of the documents left, in sequences of 1,024."""
    ship_package(spark)
    return pack(docs, queries.tokenizer_path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("repeated_passages", repeated_passages),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

# Trained models, hashes and tokenizers have no SQL form: tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """STAGES applied to ``documents``, each written in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{base}/{i}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
