"""Document fingerprints by SpotSigs, in DataFrame functions only.

A spot is a common word (``ANCHORS``); its signature is the chain of the word
and the two content words that follow it among the next ``LOOK`` words, common
words skipped.  In a stretch of more than ``GAP`` words without a common word
(tables, other languages) each further word is a spot too.  The sorted distinct
64-bit hashes of a text's signatures are its fingerprint; a text without any has
the hash of the whole text.  A text's words never leave its row.

Fingerprints are compared by the Jaccard index of their signatures.  Pairs whose
set lengths alone keep the index below a threshold are not compared:
``near_pairs`` divides the sets by length into partitions of which only
neighbours can match, joins them on the rarest signatures and verifies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, stored

# The twenty most common words of English, French, Spanish and German.
ANCHORS = tuple(dict.fromkeys((
    "the of and to a in is that it for was on with as be by this at are from "
    "de la le et les des en un du une que est pour qui au dans par sur pas avec "
    "de la que el en los se del y un por las con una no su lo para es al "
    "der und die in zu den von das mit sich des für auf ist im nicht dem ein als eine").split()))
CHAIN, LOOK, GAP = 2, 8, 8
WORD = r"[\p{L}\p{N}\p{M}]+"
SIMILAR = 0.8


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def common_places(of: Column, anchors=ANCHORS) -> Column:
    """Places of the common words in an array of words, and its length."""
    return F.concat(F.array_compact(F.transform(of, lambda w, i: F.when(w.isin(*anchors), i))), F.array(F.size(of)))


def spots(ends: Column, gap: int = GAP) -> Column:
    """The common words' places and those ``gap`` or more after the last one.
    ``ends`` is a stored :func:`common_places` column: the lambda reads it at every place."""
    # each common word (or the start) with the next one (or the end)
    bare = F.transform(ends, lambda at, k: F.when(
        at - F.when(k == 0, -gap).otherwise(F.get(ends, k - 1)) > gap,
        F.sequence(F.when(k == 0, 0).otherwise(F.get(ends, k - 1) + gap), at - 1)))
    return F.concat(F.slice(ends, F.lit(1), F.size(ends) - 1), F.flatten(F.array_compact(bare)))


def signatures(of: Column, at: Column, whole: Column, anchors=ANCHORS, chain: int = CHAIN, look: int = LOOK) -> Column:
    """Sorted distinct signature hashes of an array of words with spots ``at``."""
    def signature(i):
        after = F.filter(F.slice(of, i + 2, look), lambda w: ~w.isin(*anchors))
        return F.transform(F.array(after), lambda c: F.when(
            F.size(c) >= chain, F.xxhash64(F.get(of, i), *[F.get(c, F.lit(k)) for k in range(chain)])))

    found = F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.transform(at, signature)))))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.xxhash64(whole)))


def with_signatures(df: DataFrame, text: str, name: str, anchors=ANCHORS) -> DataFrame:
    """``df`` with the signature set of a text column as ``name``."""
    own, ends, at = f"_{name}_words", f"_{name}_ends", f"_{name}_spots"
    return (df.withColumn(own, words(F.col(text))).withColumn(ends, common_places(F.col(own), anchors))
            .withColumn(at, spots(F.col(ends)))
            .withColumn(name, signatures(F.col(own), F.col(at), F.col(text), anchors)).drop(own, ends, at))


def fingerprint(sigs: Column) -> Column:
    """Signature hashes as one string, sixteen hexadecimal digits each."""
    return F.array_join(F.transform(sigs, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard index of two sets; 0 if their lengths alone keep it below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(small < F.lit(least) * large, 0.0).when(a == b, 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def length_partition(size: Column, threshold: float) -> Column:
    """Sets at least ``threshold`` alike lie in one partition or in neighbours."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int")


def near_pairs(sets: DataFrame, key: str = "key", sigs: str = "sigs", threshold: float = SIMILAR) -> DataFrame:
    """(a, b, similarity), a < b: pairs of keys whose sets are at least
    ``threshold`` alike.  Equal sets are compared once, as the smallest key among
    them, so give one key a set (``classes``) where many are equal.

    Keys are unique and not null.  Signatures in the rarest ``size - ceil(threshold * size)
    + 1`` of a set meet; a signature of every third set is among them only in sets of little else.
    """
    s = stored(columns(sets, key=key, sigs=sigs).withColumn("size", F.size("sigs")))
    each = s.select("key", "size", F.explode("sigs").alias("sig"))
    common = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    met = each.join(common, "sig")  # a signature of one set alone meets nobody
    alone = F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("key"))
    rarest = F.row_number().over(Window.partitionBy("key").orderBy("df", "sig")) + alone
    least = F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9))
    prefix = (met.withColumn("place", rarest).where(F.col("place") <= F.col("size") - least + 1)
              .withColumn("part", length_partition(F.col("size"), threshold)))
    a = prefix.select(F.col("key").alias("a"), F.col("size").alias("a_size"), F.col("place").alias("a_place"), "part", "sig")
    b = prefix.select(F.col("key").alias("b"), F.col("size").alias("b_size"), F.col("place").alias("b_place"), "sig",
                      F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    need = F.ceil((F.col("a_size") + F.col("b_size")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9))
    left = 1 + F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    # b the smaller set: in a's partition or the one below
    found = (a.join(b, ["part", "sig"]).where(
        ((F.col("a_size") > F.col("b_size")) | ((F.col("a_size") == F.col("b_size")) & (F.col("a") < F.col("b"))))
        & (F.col("b_size") >= F.lit(threshold) * F.col("a_size") - F.lit(1e-9)) & (left >= need)).select("a", "b").distinct())
    x, y = (s.select(F.col("key").alias(n), F.col("sigs").alias(f"{n}_sigs")) for n in "ab")
    exact = found.join(x, "a").join(y, "b").withColumn("similarity", jaccard(F.col("a_sigs"), F.col("b_sigs"), threshold))
    return exact.where(F.col("similarity") >= threshold - 1e-12).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchors=ANCHORS) -> tuple[DataFrame, DataFrame]:
    """(class_id, sigs), one row per different signature set, and (doc_id,
    class_id) for every document; class_id is a 64-bit hash of the set."""
    d = columns(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = stored(with_signatures(d, "text", "sigs", anchors).select("doc_id", "sigs", F.xxhash64("sigs").alias("class_id")))
    return d.groupBy("class_id").agg(F.first("sigs").alias("sigs")), d.select("doc_id", "class_id")


def in_order(docs: DataFrame, tasks: int) -> DataFrame:
    """(doc_id, text, bucket, ghost) dealt by range of doc_id, so that each bucket
    can be read by itself in descending order: its last rows are ghosts of the
    row that follows, the first of the next bucket that has rows (after the last, of the first).

    Texts are moved once.  The bounds are quantiles of doc_id, as many as there
    are buckets; null ids come last, in the bucket of the smallest.
    """
    n = 4 * tasks
    quantiles = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("q")).first().q
    bounds = F.array(*[F.lit(q).cast("long") for q in sorted(set(quantiles or []))]).cast("array<long>")
    bucket = F.size(F.filter(bounds, lambda b: b < F.coalesce("doc_id", F.lit(-2**63))))
    dealt = docs.select("doc_id", "text", bucket.alias("bucket"), F.lit(False).alias("ghost"))
    # ids of the first row of each bucket: one row a bucket
    heads = dealt.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).orderBy(F.desc("bucket")).collect()
    if not heads:
        return dealt
    follows = docs.sparkSession.createDataFrame(
        [(last.bucket, first.doc_id) for last, first in zip(heads, heads[1:] + heads[:1])], "bucket int, head long")
    first = F.min_by("text", F.xxhash64("text"))
    ghosts = (docs.join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("bucket")
              .agg(F.max("doc_id").alias("doc_id"), first.alias("text"))
              .select("doc_id", "text", "bucket", F.lit(True).alias("ghost")))
    return dealt.unionByName(ghosts)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchors=ANCHORS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller doc_id (after the last:
    the first); rows of one id follow each other in the order of their texts'
    hashes, null ids come last.  A row alone is its own next.  Null and empty texts
    are ''.  doc_id is an integer.  An empty table gives no rows.
    """
    d = columns(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    tasks = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_signatures(in_order(d, tasks).repartition(tasks, "bucket"), "text", "sigs", anchors)
    at = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), "hash")
    rows = (rows.withColumn("hash", F.xxhash64("text"))
            .select("*", F.lead("sigs").over(at).alias("next_sigs"), F.lead("text").over(at).alias("next_text"))
            .where(~F.col("ghost")).withColumn("half", F.floor(F.length("text") / 2).cast("int")))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("half")),
                                              F.substring("next_text", F.lit(1), F.col("half"))))
    rows = with_signatures(rows, "edited", "edited_sigs", anchors)
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
