"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Statistics of each whole text are taken in a map step.  Every ratio then goes into
a logarithmic quantile sketch per language and source: counts of value buckets whose
bounds grow by GAMMA, so a quantile is within 1 % of its value.  Such sketches
merge by adding counts: that is a map-side combined groupBy, exact and the same in any order,
and the sketches of a language and of the corpus are sums of the sources'.  Fences
around the quartiles (Tukey's, with a least width) replace fixed cutoffs.  The
fewer documents a source has, the more its fences follow its language's, and a
language's the corpus's (weights that rise with the documents, no switch).  A source's fence reaches at
most a least width beyond its language's, a language's beyond the corpus's, so a
source full of junk does not set its own standard; only the word length, which
writing systems set, is not bounded by the corpus.  The fences are joined back on
(lang, source) and filter.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, stored

GAMMA = 1.02
TINY = 1e-6
ZERO_BUCKET = -100_000
MIN_GROUP = 200
FENCE = 3.0
MIN_WORDS = 50

# ratio: (least distance of the upper fence from the third quartile, of the lower one from the first; none: no lower fence)
RATIOS = {
    "word_length": (2.5, 2.5),
    "symbol_share": (0.15, None),
    "punct_share": (0.1, None),
    "upper_share": (0.2, None),
    "dup_line_share": (0.45, None),
    "repeat_share": (0.35, None),
}

# Ratios that differ between writing systems.
BY_SCRIPT = frozenset(["word_length"])

_SPACE = [9, 10, 11, 12, 13, 32]
_SYMBOL = [ord(c) for c in "#*$%&|<>"]
_PUNCT = [c for c in range(33, 127) if not chr(c).isalnum()]
_UPPER, _LOWER = list(range(65, 91)), list(range(97, 123))


def repeat_words(words: list) -> int:
    """Words inside three-word windows found twice or more."""
    if len(words) < 4:
        return 0
    number = dict(zip(set(words), count()))
    v, ids = len(number), np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    if v >= 2_000_000:  # a product of three would not fit
        pair = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
        code = pair[:-1] * v + ids[2:]
    else:
        code = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    _, at, n = np.unique(code, return_inverse=True, return_counts=True)
    twice = n[at] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:len(words) - 2 + k] |= twice
    return int(inside.sum())


def text_stats(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then the
    counts behind the other ratios: punctuation, upper-case and all ASCII letters,
    lines with a word."""
    raw = (text or "").encode()
    if not raw:
        return (0,) * 9
    words = raw.split()  # bytes split at ASCII white space only
    lines = [s for s in raw.split(b"\n") if s.strip()]
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(c[128:192].sum())
    upper = int(c[_UPPER].sum())
    return (len(words), points - int(c[_SPACE].sum()), int(c[_SYMBOL].sum()), len(lines) - len(set(lines)),
            repeat_words(words), int(c[_PUNCT].sum()), upper, upper + int(c[_LOWER].sum()), len(lines))


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_punct", "n_upper", "n_letters", "n_lines"]


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            source: str = "source") -> DataFrame:
    """doc_id, lang, source and STATS of every row."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = np.array([text_stats(t.as_py()) for t in b.column(1)], np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), *[pa.array(rows[:, i]) for i in range(len(STATS))]],
                names=["doc_id", "lang", "source", *STATS])

    d = columns(docs, doc_id=doc_id, text=text, lang=lang, source=source).selectExpr(
        "cast(doc_id as long) doc_id", "text", "cast(lang as string) lang", "cast(source as string) source")
    return d.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{s} long" for s in STATS))


def sketch(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Quantile sketch of each value column (0 or more) per key: rows (keys,
    ratio, bucket, n).  Null values are not counted."""
    long = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(v).alias("ratio"), F.col(v).cast("double").alias("x")) for v in values])).alias("r"))
    bucket = F.when(F.col("r.x") < TINY, F.lit(ZERO_BUCKET)).otherwise(
        F.ceil(F.log(F.greatest("r.x", F.lit(TINY))) / F.lit(math.log(GAMMA))).cast("int"))
    return (long.where("r.x is not null").groupBy(*keys, F.col("r.ratio").alias("ratio"), bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches under fewer keys: the sums of their counts."""
    return sketches.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """(keys, ratio, total, one column per name in ``at``)."""
    w = Window.partitionBy(*keys, "ratio")
    cum = sketches.withColumn("total", F.sum("n").over(w)).withColumn("cum", F.sum("n").over(w.orderBy("bucket")))
    value = F.when(F.col("bucket") == ZERO_BUCKET, F.lit(0.0)).otherwise(
        F.pow(F.lit(GAMMA), F.col("bucket")) * F.lit(2 / (1 + GAMMA)))
    return cum.groupBy(*keys, "ratio").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("cum") >= F.col("total") * q, value)).alias(name) for name, q in at.items()])


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, fence: map of ratio to struct(low, high))."""
    q = quantiles(sketches, keys, {"q1": 0.25, "q3": 0.75})
    high = F.create_map(*[x for r, (h, _) in RATIOS.items() for x in (F.lit(r), F.lit(float(h)))])[F.col("ratio")]
    low = F.create_map(*[x for r, (_, lo) in RATIOS.items() for x in (F.lit(r), F.lit(float("inf") if lo is None else float(lo)))])[F.col("ratio")]
    spread = F.lit(FENCE) * (F.col("q3") - F.col("q1"))
    q = q.select(*keys, "ratio", "total", F.struct((F.col("q1") - F.greatest(spread, low)).alias("low"),
                                                   (F.col("q3") + F.greatest(spread, high)).alias("high")).alias("f"))
    return q.groupBy(*keys).agg(F.max("total").alias("n"),
                                F.map_from_entries(F.collect_list(F.struct("ratio", "f"))).alias("fence"))


def blended(n: str, own: str, parent: str, k: int, bounded) -> Column:
    """Fence map between ``own`` (weight n / (n + k)) and ``parent``; for ``bounded``
    ratios at most a least width beyond the parent's.  Of BY_SCRIPT ratios the own
    fence's weight rises to 1 at ``k`` documents: a mean of two scripts fits neither."""
    out = []
    for r, (least_high, least_low) in RATIOS.items():
        a, b = F.col(own)[r], F.col(parent)[r]
        w = F.least(F.col(n) / F.lit(k), F.lit(1.0)) if r in BY_SCRIPT else F.col(n) / (F.col(n) + F.lit(k))
        low, high = (w * a[x] + (1 - w) * b[x] for x in ("low", "high"))
        if r in bounded:
            high = F.least(high, b["high"] + F.lit(float(least_high)))
            low = low if least_low is None else F.greatest(low, b["low"] - F.lit(float(least_low)))
        out += [F.lit(r), F.struct((F.lit(float("-inf")) if least_low is None else low).alias("low"), high.alias("high"))]
    return F.create_map(*out)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """One row per input row: doc_id, lang, source, STATS, base_failed, kept, failed (names of the
    ratios beyond their fences; empty for rows the base rules reject).

    Base rules: fewer than 50 words, or over half the words in repeated
    three-word windows.  The sketches hold the documents that pass them.
    ``min_group``: documents at which a group's own fences weigh as much as its parent's.  A null
    text has no words; null languages and null sources are groups of their own.
    Repeated rows count each; an empty table gives no rows.
    """
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    m = measure(docs, doc_id, text, lang, source)
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    m = stored(m.withColumns({
        "base_failed": base_failed, "k_lang": key("lang"), "k_source": key("source"),
        "word_length": per("word_chars", "n_words"), "symbol_share": per("n_symbols", "n_words"),
        "punct_share": per("n_punct", "word_chars"), "upper_share": per("n_upper", "n_letters"),
        "dup_line_share": per("n_dup_lines", "n_lines"), "repeat_share": per("n_repeat_words", "n_words")}))

    by_source = stored(sketch(m.where(~F.col("base_failed")), ["k_lang", "k_source"], list(RATIOS)))
    by_lang = merge(by_source, ["k_lang"])
    everything = merge(by_lang.withColumn("k_all", F.lit("")), ["k_all"])
    f1 = fences(by_source, ["k_lang", "k_source"])
    f2 = fences(by_lang, ["k_lang"]).select("k_lang", F.col("n").alias("n2"), F.col("fence").alias("fence2"))
    f3 = fences(everything, ["k_all"]).select("k_all", F.col("fence").alias("fence3"))
    f2 = (f2.withColumn("k_all", F.lit("")).join(f3, "k_all")
          .select("k_lang", blended("n2", "fence2", "fence3", min_group, RATIOS.keys() - BY_SCRIPT).alias("fence2")))
    chosen = f1.join(f2, "k_lang").select("k_lang", "k_source", blended("n", "fence", "fence2", min_group, RATIOS).alias("fence"))
    out = m.join(chosen, ["k_lang", "k_source"], "left")
    beyond = F.array_compact(F.array(*[
        F.when((F.col(r) > F.col("fence")[r]["high"]) | (F.col(r) < F.col("fence")[r]["low"]), F.lit(r)) for r in RATIOS]))
    failed = F.when(F.col("base_failed") | F.col("fence").isNull(), F.array().cast("array<string>")).otherwise(beyond)
    return out.select("doc_id", "lang", "source", *STATS, "base_failed",
                      (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"), failed.alias("failed"))
