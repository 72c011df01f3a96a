"""Bounded samples of labelled documents for the trained operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, id_bucket, stored, text_key


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, per_class: int,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Checkpointed (doc_id, text, y): for each class the ``per_class`` labelled
    documents with the smallest hash of their id, among ids whose CRC-32 bucket
    is not ``held_out``.  Contradictory labels of an id and labels other than 0
    and 1 are left out, rows that repeat an id and text count once, and rows beyond
    ``per_class`` of a class (ids with several texts) go.  At most 2 * per_class ids are broadcast."""
    y = (columns(labels, doc_id=doc_id, y=label).where("doc_id is not null and y in (0, 1)")
         .where(id_bucket("doc_id", mod) != held_out)
         .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("high")).where("y = high"))
    chosen = reduce(DataFrame.unionByName, [
        y.where(F.col("y") == c).select("doc_id", F.col("y").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)])
    # in the order of hashes, so the bound holds for ids that repeat with many texts too
    found = columns(docs, doc_id=doc_id, text=text).join(F.broadcast(chosen), "doc_id")
    found = stored(found.withColumn("key", text_key("text")).dropDuplicates(["doc_id", "key"]))
    order = F.xxhash64("doc_id"), F.col("doc_id"), F.col("key")
    if not found.groupBy("y").count().where(F.col("count") > per_class).isEmpty():
        kept = reduce(DataFrame.unionByName, [found.where(F.col("y") == c).select("doc_id", "key").orderBy(*order)
                                              .limit(per_class) for c in (0, 1)])
        found = stored(found.join(F.broadcast(kept), ["doc_id", "key"]))
    return found.select("doc_id", "text", "y")
