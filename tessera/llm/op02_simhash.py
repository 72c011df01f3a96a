"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most three bits apart meet at a value one flip from
one of them and two flips from the other.  Of three differing bits two lie in
the same 32-bit half, so the two-flip variants can be kept to pairs inside a
half: a fingerprint emits itself and its 64 one-flip variants (inner) and 992
two-flip variants (outer).  At one variant, inner members differ from each
other by two bits at most and from outer ones by three, so every member is
linked to the least inner one: one row per member, never all pairs.
A variant has at most 1,057 distinct fingerprints around it, so no group grows
with the data.

Before that, the same idea on halves drops fingerprints that meet nobody: of
three differing bits at most one lies in one of the halves, so linked
fingerprints share a half up to one flip (33 variants of each half).
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tessera.llm.common import columns, connected_components, stored

RADIUS = 3
SEED = 42


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


INNER = [0] + [_signed(1 << i) for i in range(64)]
OUTER = [_signed(1 << h + i | 1 << h + j) for h in (0, 32) for i, j in combinations(range(32), 2)]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included: ASCII
    letters lower-cased, words split at ASCII white space, XXH64 with seed 42, a
    bit is 1 if set in over half the hashes.  Fewer words than a shingle: the
    whole sequence is the one shingle; none (or null): 0."""
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint_column(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def _candidates(fps: DataFrame) -> DataFrame:
    """Fingerprints that share a half, up to one flip, with another one."""
    # few bytes become many rows: spread them first over as many tasks as a shuffle has
    # (by another expression than the grouping, else Spark drops the step)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    half = fps.repartition(n, F.xxhash64("fp")).select("fp", F.explode(F.array(
        F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1 << 32)))).alias("half"))
    ball = half.select(F.explode(F.transform(
        F.lit([0] + [1 << i for i in range(32)]), lambda m: F.col("half").bitwiseXOR(m))).alias("half"))
    met = ball.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    return half.join(met, "half").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Edges ``(fp, center)`` whose components are those of all pairs of
    distinct fingerprints (column ``fp``) within RADIUS bits."""
    near = _candidates(fps)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ball = near.repartition(n, F.xxhash64("fp")).select("fp", F.explode(F.lit(INNER + OUTER)).alias("flip"))
    ball = ball.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"),
                       F.when(F.bit_count("flip") <= 1, F.col("fp")).alias("inner_fp"))
    at = Window.partitionBy("variant")
    met = ball.select("fp", F.min("inner_fp").over(at).alias("center")).where("center <> fp")
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("center"))) <= RADIUS).distinct()


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (signed fingerprint), component_id
    (smallest doc_id reachable over fingerprints three bits apart or less),
    component_fp (a key of the component).

    Null or empty texts and texts of white space alone have fingerprint 0 and
    are linked with each other.  Repeated rows share a component.  A component
    without any doc_id has a null component_id; an empty table gives no rows.
    """
    d = stored(columns(docs, doc_id=doc_id, text=text).select("doc_id", fingerprint_column("text").alias("fp")))
    fps = d.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    cc = connected_components(links(fps.select("fp")), "fp", "center")
    of = (fps.join(cc, fps.fp == cc.node, "left")
          .select("fp", "rep", F.coalesce("component", "fp").alias("component_fp")))
    low = of.groupBy("component_fp").agg(F.min("rep").alias("component_id"))
    of = of.join(low, "component_fp").select("fp", "component_fp", "component_id")
    return d.join(of, "fp").select("doc_id", "fp", "component_id", "component_fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, one per near-duplicate
    group: the one with the smallest (doc_id, text key); rows that repeat both
    are one document and one of them stays."""
    keyed = docs.withColumn("_sim_key", F.xxhash64(F.coalesce(docs[text], F.lit(""))))
    base = stored(columns(keyed, doc_id=doc_id, key="_sim_key", text=text)
                  .select("doc_id", "key", fingerprint_column("text").alias("fp")))
    fps = base.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "key")).alias("rep"))
    cc = connected_components(links(fps.select("fp")), "fp", "center")
    chosen = (fps.join(cc, fps.fp == cc.node, "left")
              .groupBy(F.coalesce("component", "fp").alias("c")).agg(F.min("rep").alias("rep"))
              .select(F.col("rep.doc_id").alias("_sim_id"), F.col("rep.key").alias("_sim_row")))
    same = keyed[doc_id].eqNullSafe(chosen["_sim_id"]) & (keyed["_sim_key"] == chosen["_sim_row"])
    return (keyed.join(chosen, same).dropDuplicates(["_sim_id", "_sim_row"])
            .drop("_sim_id", "_sim_row", "_sim_key"))


def hex_fingerprint(col: str):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
