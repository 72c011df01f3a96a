"""Line de-duplication by winnowing over line hashes, in DataFrame functions only.

A passage is a run of consecutive lines with words (lines without are passed
over).  The window of a line is the shortest run from it that holds
``min_words`` words.  The least line hash of each window is its fingerprint: two
copies of a run of that many words hold a window in common and so select the same line.

Fingerprints join on their hash over the corpus; windows whose fingerprint was
selected in one place only are not read on.  The others are keyed by the hash of
the whole window and joined to its first occurrence (order: doc_id, text key,
line).  From there the match is extended both ways in the same earlier document
at the same distance, and the lines of the extended run are deleted.  To the
left every further line begins a window of the run that is matched itself; to the
right lines are compared one by one as far as fewer than ``min_words`` words
follow the window's first line, for beyond them the next window decides.

A first occurrence is never deleted, so every deleted line keeps its first copy,
and lines that never stood together elsewhere stay.  An occurrence is matched
with the first one only, never with all: the work is linear in the lines.  First
occurrences are map-side combined minima; the join back on a hot window is one
that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, stored, text_key

MIN_WORDS = 50
WORDS = r"[^\x20\x09-\x0D]+"


DOC = ["doc_id", "doc_key"]


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, doc_key, line, words, h) of every line with a word; lines split at
    \\n, h a 64-bit hash of the whole line and its length (lines are equal if it is)."""
    d = columns(docs, doc_id=doc_id, text=text).where("text is not null")
    d = d.select("doc_id", text_key("text").alias("doc_key"), F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    return (d.select("doc_id", "doc_key", "line", F.regexp_count("s", F.lit(WORDS)).alias("words"),
                     F.xxhash64("s", F.length("s")).alias("h")).where("words > 0"))


def windows(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, doc_key, at, h, until, last, room, least, least_at, key) of every
    line with words: its place among those of its document, the words up to its
    end and, if enough words follow, the window's last place, the lines after it that may
    matter, its least line hash with its place, and the hash of it all."""
    per_doc = Window.partitionBy(*DOC)
    in_order = per_doc.orderBy("line")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # rows that repeat a document repeat its lines; all below keeps the partitioning by document
    placed = (lines.repartition(*DOC).distinct()
              .select("*", F.sum("words").over(so_far).alias("until"), (F.row_number().over(in_order) - 1).alias("at"))
              .withColumn("start", F.col("until") - F.col("words"))
              .withColumn("total", F.sum("words").over(per_doc)))
    window = per_doc.orderBy("start").rangeBetween(Window.currentRow, min_words - 1)
    seen = placed.select(*DOC, "at", "h", "until", "words", (F.col("total") - F.col("start") >= min_words).alias("full"),
                         F.max(F.struct("at", "until")).over(window).alias("end"),
                         F.min(F.struct("h", "at")).over(window).alias("low"), F.collect_list("h").over(window).alias("all"))
    room = F.greatest(F.lit(0), min_words - 1 - (F.col("end.until") - F.col("until"))).cast("int")
    only = {"last": F.col("end.at"), "room": room, "least": F.col("low.h"), "least_at": F.col("low.at"), "key": F.xxhash64("all")}
    return seen.select(*DOC, "at", "h", "until", *[F.when(F.col("full"), c).alias(n) for n, c in only.items()])


def matches(found: DataFrame) -> DataFrame:
    """(doc_id, doc_key, at, until, last, room, f_id, f_key, shift): windows with
    an earlier first occurrence, which lies ``shift`` places on in document (f_id, f_key)."""
    full = found.where("key is not null")
    # windows next to each other often select one place: it counts once
    before = F.lag("least_at").over(Window.partitionBy(*DOC).orderBy("at"))
    prints = (full.select("least", before.eqNullSafe(F.col("least_at")).alias("again")).where(~F.col("again"))
              .groupBy("least").agg(F.count(F.lit(1)).alias("places")).where("places > 1").select("least"))
    shared = full.join(prints, "least")
    place = F.struct(F.col("doc_id").isNull().alias("nil"), *DOC, "at")
    first = shared.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (shared.join(first.select("key", "first"), "key")
            .select(*DOC, "at", "until", "last", "room", F.col("first.doc_id").alias("f_id"),
                    F.col("first.doc_key").alias("f_key"), (F.col("first.at") - F.col("at")).alias("shift"))
            .where(~(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("doc_key") == F.col("f_key")) & (F.col("shift") == 0))))


def repeated_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, doc_key, at) of lines to delete, ``at`` counting lines with words from 0."""
    found = stored(windows(lines, min_words))
    met = stored(matches(found))
    # a later window ends later: each adds the lines that the one before leaves
    before = F.lag("last").over(Window.partitionBy(*DOC).orderBy("at"))
    own = met.select(*DOC, F.greatest("at", F.coalesce(before + 1, F.lit(0))).alias("from"), "last").where(F.col("from") <= F.col("last"))
    inside = own.select(*DOC, F.explode(F.sequence("from", "last")).alias("at"))

    # ends of runs: the next line's window is not matched at the same distance
    run = Window.partitionBy(*DOC, "f_id", "f_key", "shift").orderBy("at")
    ends = met.withColumn("next", F.lead("at").over(run)).where("(next is null or next <> at + 1) and room > 0")
    ahead = ends.select(F.col("doc_id").alias("e_id"), F.col("doc_key").alias("e_key"), F.col("until").alias("e_until"),
                        F.col("last").alias("e_last"), "f_id", "f_key", "shift", F.explode(F.expr("sequence(last + 1, last + room)")).alias("e_at"))
    after = found.join(ahead, F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("doc_key") == F.col("e_key"))
                       & (F.col("at") == F.col("e_at"))).where(F.col("until") - F.col("e_until") < min_words)
    after = after.select(*DOC, "at", "h", "e_last", "f_id", "f_key", "shift", (F.col("at") + F.col("shift")).alias("f_at"))
    there = found.select(F.col("doc_id").alias("t_id"), F.col("doc_key").alias("t_key"), F.col("at").alias("t_at"), F.col("h").alias("t_h"))
    compared = after.join(there, F.col("f_id").eqNullSafe(F.col("t_id")) & (F.col("f_key") == F.col("t_key"))
                          & (F.col("f_at") == F.col("t_at")), "left")
    differs = F.min(F.when(~F.col("h").eqNullSafe(F.col("t_h")), F.col("at"))).over(
        Window.partitionBy(*DOC, "e_last", "f_id", "f_key", "shift"))
    tail = compared.select(*DOC, "at", differs.alias("stop")).where("stop is null or at < stop").select(*DOC, "at")
    return inside.unionByName(tail).distinct()


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with all its columns and rows, repeated passages deleted from the
    text, and ``n_removed`` (lines deleted).

    Null texts stay null, empty ones empty; a text whose every line is deleted
    becomes ''.  Lines without a word are never deleted.  Rows that repeat a doc_id and
    text are one document and change alike.  An empty table gives no rows.
    """
    gone = (repeated_lines(lines_of(docs, doc_id, text), min_words)
            .groupBy(*DOC).agg(F.collect_list("at").alias("_gone"))
            .select(F.col("doc_id").alias("_line_id"), F.col("doc_key").alias("_line_key"), "_gone"))
    keyed = docs.withColumn("_text_key", text_key(docs[text]))
    same = keyed[doc_id].eqNullSafe(gone["_line_id"]) & (keyed["_text_key"] == gone["_line_key"])
    out = keyed.join(gone, same, "left").withColumn("_parts", F.when(F.col("_gone").isNotNull(), F.split(text, "\n", -1)))
    worded = F.array_compact(F.transform("_parts", lambda s, i: F.when(s.rlike(WORDS), i)))
    out = out.withColumn("_worded", worded)
    removed = F.transform("_gone", lambda k: F.get("_worded", k))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), removed)
    left = F.array_join(F.transform(kept, lambda i: F.get("_parts", i)), "\n")
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left))
    return (out.withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
            .drop("_line_id", "_line_key", "_text_key", "_gone", "_parts", "_worded"))
