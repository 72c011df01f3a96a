"""Spelling variants by pivotal grams.

Words that differ by one inserted, deleted or replaced code point are found
without comparing all words.  Bigrams have one order, rarest first.  A word's
gram prefix is its three first bigrams in that order (and every other place of
the third); its pivots are two bigrams of the prefix that don't overlap, of
least total frequency, chosen by dynamic programming.  One edit spoils at most
one pivot, so of two near words the one whose prefix ends earlier in the order
keeps a pivot that lies in the other's prefix.

Position limits: an edit before the second pivot leaves the word from that pivot
on as it is; any other edit leaves all before it, the first pivot included.
Pivots are therefore joined with prefix grams on that side of the word and on
the length (equal or one apart); the rest of the pair is verified in the join.
"""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, stored

MIN_LENGTH, MIN_COUNT, NOISE = 5, 3, 97
PREFIX, PIVOTS = 3, 2  # one edit spoils two bigrams at most
HELD = 500_000  # words counted in a task before their counts are sent on

# In Latin-1 the letters are single bytes; any other character becomes '?', a separator.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of [A-Za-z\\u00C0-\\u00FF] in Latin-1, A-Z lower-cased."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def altered(words: Counter, doc_id, noise: int) -> Counter:
    """The document's word counts after the code points that the hash of id and word picks are deleted."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for w, n in words.items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % noise == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1:]
        out[w] += n
    return out


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n) of words of at least ``min_length`` code points and ``min_count`` occurrences."""
    def run(batches):
        import pyarrow as pa

        def out(held):
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"])

        held: Counter = Counter()
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                for w, n in altered(Counter(words_of(t.as_py())), doc, noise).items():
                    if len(w) >= min_length:
                        held[w] += n
                if len(held) >= HELD:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)

    found = columns(docs, doc_id=doc_id, text=text).selectExpr("cast(doc_id as string) doc_id", "text")
    return (found.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def bigrams(word: str) -> list[str]:
    return [word[i:i + 2] for i in range(len(word) - 1)]


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Words that hold each bigram.  90 letters make 8,100 bigrams at most."""
    def run(batches):
        import pyarrow as pa
        held: Counter = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                held.update(set(bigrams(w)))
        yield pa.RecordBatch.from_pydict({"gram": pa.array(list(held), pa.string()),
                                          "n": pa.array(list(held.values()), pa.int64())})

    found = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in found.collect()}


def cheapest_disjoint(places: list[tuple[int, int]], k: int) -> list[int]:
    """Positions of the ``k`` bigrams of least total cost that don't overlap,
    among ``(position, cost)`` in ascending positions."""
    best: list[tuple[int, list[int]]] = [(c, [p]) for p, c in places]
    for _ in range(k - 1):
        best = [min(((cost + c, chosen + [p]) for cost, chosen in best[:i] if chosen and chosen[-1] + 2 <= p),
                    default=(0, [])) for i, (p, c) in enumerate(places)]
    return min(x for x in best if x[1])[1]


def plan_word(word: str, count: dict[str, int], rank: dict[str, int]) -> tuple[list[int], int, list[int]]:
    """Pivot positions, rank of the last prefix gram, prefix positions."""
    grams = bigrams(word)
    order = sorted(range(len(grams)), key=lambda i: (rank[grams[i]], i))
    first = sorted(order[:PREFIX])
    last = rank[grams[order[PREFIX - 1]]]
    return (cheapest_disjoint([(i, count[grams[i]]) for i in first], PIVOTS), last,
            [i for i in order if rank[grams[i]] <= last])


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b: every pair of distinct words (word, n) one edit apart.

    Words have at least four code points; shorter ones are left out."""
    count = gram_counts(words)
    rank = {g: i for i, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}

    def run(batches):
        import pyarrow as pa
        for b in batches:
            plans = [plan_word(w, count, rank) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([p[0][0] for p in plans], pa.int32()),
                 pa.array([p[0][1] for p in plans], pa.int32()), pa.array([p[1] for p in plans], pa.int32()),
                 pa.array([p[2] for p in plans], pa.list_(pa.int32()))],
                names=["word", "n", "p1", "p2", "last", "pre"])

    # few bytes become many rows: spread the words over as many tasks as a shuffle has
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long_enough = words.where(F.length("word") > PREFIX).select("word", "n")
    plan = stored(long_enough.repartition(tasks, F.xxhash64("word")).mapInArrow(
        run, "word string, n long, p1 int, p2 int, last int, pre array<int>"))
    size = F.length("word")

    def key(left: bool, at, length):
        """Hash of one side of a word up to and with the bigram at ``at``, and a length."""
        side = F.substring("word", F.lit(1), at + 2) if left else F.substring("word", at + 1, size)
        return F.xxhash64(F.lit(left), length, side)

    index = (plan.select("word", "n", "last", F.explode("pre").alias("at"))
             .select(F.explode(F.array(*[F.struct(F.lit(left).alias("left"), key(left, F.col("at"), size).alias("key"))
                                         for left in (True, False)])).alias("k"),
                     F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last")))
    probe = plan.select(
        F.explode(F.array(*[F.struct(F.lit(left).alias("left"), key(left, F.col(p), size + d).alias("key"))
                            for left, p in ((True, "p1"), (False, "p2")) for d in (-1, 0, 1)])).alias("k"),
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"), "p2")
    index, probe = (x.select("k.key", "k.left", *x.columns[1:]) for x in (index, probe))
    same_start = F.substring("a", F.lit(1), F.col("p2")) == F.substring("b", F.lit(1), F.col("p2"))
    met = (probe.join(index.drop("left"), "key")
           .where((F.col("a_last") <= F.col("b_last")) & (F.col("a") != F.col("b")) & (~F.col("left") | same_start)
                  & (F.levenshtein("a", "b", 1) == 1)))
    swap = F.col("a") < F.col("b")
    return met.select(F.when(swap, F.struct("a", "a_n", "b", "b_n")).otherwise(
        F.struct(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    ).alias("p")).select("p.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every (word, form): forms followed to the last.  A form's
    count is at least twice its word's, so there are no rings, and chains,
    halved each round, take few rounds."""
    r = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = r.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(r.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                        F.col("further").isNotNull().alias("moved")))
        r = step.select("word", "root")
        if step.where("moved").isEmpty():
            return r


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, noise: int = NOISE, factor: int = 2) -> DataFrame:
    """One row per word: word, form (its near word of largest count, if that is
    ``factor`` times the word's; equal counts: the first in code-point order),
    root, n, n_near, form_n.

    Null and empty texts have no words; a null doc_id counts as ''.  Repeated
    rows count each.  An empty table gives no rows.  ``min_length`` is at least 4.
    """
    if min_length <= PREFIX or factor < 2:
        raise ValueError("words need at least 4 code points and forms twice the count")
    words = stored(word_counts(docs, doc_id, text, min_length, min_count, noise))
    both = near_words(words).select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("top"))
    enough = -F.col("top.minus_n") >= factor * F.col("n")
    out = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("top.near")).alias("form"), F.when(enough, -F.col("top.minus_n")).alias("form_n")))
    return (out.join(roots(out.where("form is not null")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
