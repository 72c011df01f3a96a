"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def columns(df: DataFrame, **named) -> DataFrame:
    """Only the given columns, under the given new names.  Names are matched
    as Spark matches them (case-insensitively), so a caller's extra columns
    never meet the operator's own."""
    return df.select(*[df[old].alias(new) for new, old in named.items()])


def id_bucket(col, mod: int):
    """CRC-32 of the id's decimal text modulo ``mod`` (null id: text '')."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def text_key(col):
    """64-bit key of a text; null and empty text share one."""
    return F.xxhash64(F.coalesce(col, F.lit("")))


def stored(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: an intermediate that several
    later plans read is computed once and survives lost executors."""
    return cut_lineage(df)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _edge_state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``(node, component)`` for every node with an edge; the component is the
    smallest node reachable.

    Alternating large-star and small-star steps (each a map-side combined
    minimum and one equi-join), so a component of any size is never gathered
    in one task: its star grows by rows, and the join on a hot node is one that
    adaptive execution splits.  The edge table is checkpointed each round and
    the loop ends when a round leaves it unchanged.
    """
    e = columns(edges, a=src, b=dst).where("a is not null and b is not null and a <> b")
    e = stored(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _edge_state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                 F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
        e = stored(large.join(low, "u").select(pair.alias("p")).select("p.u", "p.v")
                   .where("u <> v").distinct())
        now = _edge_state(e)
        if now == state:
            break
        state = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
