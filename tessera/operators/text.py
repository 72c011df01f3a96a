"""Text classification and similarity as Spark joins and aggregates.

No per-row Python: texts are exploded into tokens, dictionaries are
exploded into (label, token) rows, and scores are sums over an equi-join
on the token, reduced by partial aggregation.  Dictionaries are broadcast
only after a size check (:func:`tessera.operators.joins.bounded_broadcast`).
No (text, label) pair with nothing in common is ever materialised: texts
without any overlap get the tie-break label from a one-row constant.

Word similarity is the Jaccard index of character-bigram sets, computed on
**distinct** words through a bigram inverted index (an equi-join on the
bigram), so only word pairs sharing a bigram meet; every other pair has
similarity exactly 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import strings as S
from tessera.operators import blocks
from tessera.operators.joins import bounded_broadcast, fits_broadcast
from tessera.session import cut_lineage

DICT_BROADCAST_BYTES = 64 << 20
# Rows of a block: words, dictionary words, texts, phrases; words of texts compared at once.
WORD_BLOCK, DICT_BLOCK, TEXT_BLOCK, PHRASE_BLOCK, TOKENS_AT_ONCE = 4096, 1024, 2048, 1024, 524_288
PLACES_AT_ONCE = 16_384
# Vectors of words and of dictionary words that meet in a block; phrases, and matches of a block of texts, in a task.
LEFT_VECTORS, RIGHT_VECTORS, VECTOR_PHRASES, MATCHES_AT_ONCE = 16_384, 8192, 8192, 1 << 21
HELD_WORDS, HELD_LABELS = 1 << 18, 4096  # of a dictionary that every task holds
COMMON = 1000  # a word in more than one text of so many is common


# ------------------------------------------------------------------ tokens

def space_tokens(text) -> Column:
    """``lower(text).split(" ")`` — single-space split, empty tokens kept."""
    t = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(t), " ", -1)


def token_sets(docs: DataFrame, key: str, text: str, between: str = r"[^\pL\pN]+") -> DataFrame:
    """(key, tokens): the different tokens of each lower-case text, which is cut at the pattern (of RE2).

    The texts of an Arrow batch are cut where they lie: no token is a row."""
    docs = docs.filter(F.col(text).isNotNull()).select(key, F.lower(text).alias("tokens"))

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in (b.slice(lo, TEXT_BLOCK) for b in batches for lo in range(0, b.num_rows, TEXT_BLOCK)):
            lists = pc.split_pattern_regex(batch.column(1), between)
            coded = lists.flatten().dictionary_encode()
            words = coded.dictionary
            at = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()) * len(words) + coded.indices.to_numpy()
            at.sort()
            text, word = np.divmod(at[np.diff(at, prepend=-1) > 0], max(1, len(words)))
            kept = pc.utf8_length(words).to_numpy()[word] > 0
            text, word = text[kept], word[kept]
            begin = pa.array(np.searchsorted(text, np.arange(len(lists) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(begin, words.take(pa.array(word)))], names=[key, "tokens"])
    return docs.mapInArrow(cut, T.StructType([docs.schema[key], T.StructField("tokens", T.ArrayType(T.StringType()))]))


def token_counts(docs: DataFrame, key: str, tokens: Column, out: str = "c") -> DataFrame:
    """(key, token, count) — a partial aggregate over the exploded tokens."""
    return docs.select(F.col(key), F.explode(tokens).alias("token")) \
        .groupBy(key, "token").agg(F.count(F.lit(1)).alias(out))


# ------------------------------------------------------------------ C01 / C02 / C03

def bow_cosine(docs: DataFrame, doc_key: str, text: str, dictionary: DataFrame,
               label: str, keywords: str) -> DataFrame:
    """Bag-of-words cosine between each text and each dictionary entry that
    shares at least one token: (doc_key, label, score).

    Whole texts are dealt by their key once, before they are cut into words: words,
    norms and products of a text are then added up where it lies, however few files hold the texts."""
    docs = docs.select(doc_key, text).repartition(doc_key)
    dt = token_counts(docs, doc_key, space_tokens(text), "dc")
    kt = token_counts(dictionary, label, F.col(keywords), "kc")
    kn = kt.groupBy(label).agg(F.sqrt(F.sum(F.col("kc") * F.col("kc"))).alias("kn"))
    # kn has at most as many rows as kt: one decision, no second check
    if fits_broadcast(kt, DICT_BROADCAST_BYTES):
        # one row more than may be held tells a larger dictionary
        held = kt.filter(F.col(label).isNotNull()).limit(HELD_WORDS + 1).toArrow()
        plain = not isinstance(dictionary.schema[label].dataType, (T.StructType, T.ArrayType, T.MapType))
        if plain and held.num_rows <= HELD_WORDS and len(held.column(label).unique()) <= HELD_LABELS:
            return _held_cosine(docs, doc_key, text, held, dictionary.schema[label])
        # a token counts for its text's norm (no label) and for the labels that hold it
        held = kt.groupBy("token").agg(F.collect_list(F.struct(F.lit(False).alias("own"), F.col(label).alias("l"), "kc")).alias("held"))
        own = F.array(F.struct(F.lit(True).alias("own"), F.lit(None).cast(kt.schema[label].dataType).alias("l"), F.col("dc").alias("kc")))
        each = dt.join(F.broadcast(held), "token", "left") \
            .select(doc_key, "dc", F.explode(F.when(F.col("held").isNull(), own).otherwise(F.concat(own, "held"))).alias("_e"))
        dot = each.groupBy(doc_key, F.col("_e.own").alias("own"), F.col("_e.l").alias(label)) \
            .agg(F.sum(F.col("dc") * F.col("_e.kc")).alias("dp"))
        norm = F.sqrt(F.max(F.when(F.col("own"), F.col("dp"))).over(Window.partitionBy(doc_key)))
        scored = dot.withColumn("dn", norm).filter(~F.col("own") & F.col(doc_key).isNotNull()).join(F.broadcast(kn), label)
    else:
        dn = dt.groupBy(doc_key).agg(F.sqrt(F.sum(F.col("dc") * F.col("dc"))).alias("dn"))
        dot = dt.join(kt, "token").groupBy(doc_key, label).agg(F.sum(F.col("dc") * F.col("kc")).alias("dp"))
        scored = dot.join(dn, doc_key).join(kn, label)
    return scored.select(doc_key, label, (F.col("dp") / (F.col("dn") * F.col("kn"))).alias("score"))


def _held_cosine(docs: DataFrame, doc_key: str, text: str, held, label) -> DataFrame:
    """:func:`bow_cosine` with a dictionary of few words (``held``: label, token, kc), sent to every task as a broadcast
    one would be.  The rows of a key follow each other; the words of many keys at once are
    counted and meet the labels that hold them, so no word of a text is a row.  Of a key whose rows go on in the
    next batch the counts of its words are held."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_schema
    docs = docs.filter(F.col(doc_key).isNotNull() & F.col(text).isNotNull()).select(doc_key, F.lower(text).alias("_text"))
    out = T.StructType([docs.schema[doc_key], label, T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(out)
    coded = held.column(0).combine_chunks().dictionary_encode()
    labels, of, kc = coded.dictionary, coded.indices.to_numpy(), held.column("kc").to_numpy().astype(np.float64)
    kn = np.sqrt(np.bincount(of, kc * kc, minlength=len(labels)))
    tokens = held.column("token").combine_chunks().dictionary_encode()
    token = pc.fill_null(tokens.indices, len(tokens.dictionary)).to_numpy()  # a null keyword is like no token
    order = np.argsort(token, kind="stable")
    tokens, of, kc, n_held = tokens.dictionary, of[order], kc[order], np.bincount(token, minlength=len(tokens.dictionary))
    first_held = np.cumsum(n_held) - n_held

    def counted(keys, texts):
        """Different keys, different words, and (key, word, count) by key."""
        numbers: dict[str, int] = {}
        number = np.array([numbers.setdefault(repr(k), len(numbers)) for k in keys.to_pylist()])
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        at = np.repeat(number, pc.list_value_length(lists).to_numpy()) * len(words.dictionary) + words.indices.to_numpy()
        at.sort()
        begin = np.flatnonzero(np.diff(at, prepend=-1))
        doc, word = np.divmod(at[begin], len(words.dictionary))
        return keys.take(pa.array(np.flatnonzero(np.diff(number, prepend=-1)))), words.dictionary, doc, word, np.diff(begin, append=len(at))

    def score(keys, words, doc, word, dc):
        dc = dc.astype(np.float64)
        dn = np.sqrt(np.bincount(doc, dc * dc, minlength=len(keys)))
        word = pc.fill_null(pc.index_in(words, value_set=tokens), -1).to_numpy()[word]
        doc, dc, word = doc[word >= 0], dc[word >= 0], word[word >= 0]
        many = max(1, blocks.CELLS // max(1, len(labels)))
        for lo in range(0, len(keys), many):  # as many texts as have some million pairs with labels
            part = slice(*np.searchsorted(doc, (lo, lo + many)))
            times = n_held[word[part]]
            pick = np.repeat(first_held[word[part]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            pair = np.repeat((doc[part] - lo) * len(labels), times) + of[pick]
            dp = np.bincount(pair, np.repeat(dc[part], times) * kc[pick])
            pair = np.flatnonzero(dp)
            d, k = np.divmod(pair, max(1, len(labels)))
            columns = keys.take(pa.array(lo + d)), labels.take(pa.array(k)), pa.array(dp[pair] / (dn[lo + d] * kn[k]))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def scored(batches):
        key, counts = None, Counter()  # of the last key, whose rows may go on in the next batch

        def last():
            if key is not None:
                yield from score(key, pa.array(list(counts), pa.string()), np.zeros(len(counts), np.int64), np.arange(len(counts)), np.array(list(counts.values())))
        for batch in (b.slice(lo, TEXT_BLOCK) for b in batches for lo in range(0, b.num_rows, TEXT_BLOCK)):
            keys, words, doc, word, dc = counted(*batch.columns)
            upto = np.searchsorted(doc, np.arange(len(keys) + 1))
            of_key = lambda i: dict(zip(words.take(pa.array(word[upto[i]:upto[i + 1]])).to_pylist(), dc[upto[i]:upto[i + 1]].tolist()))
            begin = int(key is not None and repr(key[0].as_py()) == repr(keys[0].as_py()))
            if begin:
                counts.update(of_key(0))
            if begin == len(keys):
                continue
            yield from last()
            end = len(keys) - 1
            part = slice(upto[begin], upto[end])
            yield from score(keys.slice(begin, end - begin), words, doc[part] - begin, word[part], dc[part])
            key, counts = keys.slice(end, 1), Counter(of_key(end))
        yield from last()

    return docs.sortWithinPartitions(doc_key).mapInArrow(scored, out)


def classify_text(docs: DataFrame, doc_key: str, text: str, dictionary: DataFrame,
                  label: str, keywords: str, pos: str | None = None,
                  out_label: str = "label", out_score: str = "score") -> DataFrame:
    """Best dictionary label per text by cosine (ties -> lowest position),
    score as a rounded percentage.  Texts sharing no token with any entry
    get the first entry with score 0, as a full score table would."""
    pos = pos or label
    sc = bow_cosine(docs, doc_key, text, dictionary, label, keywords)
    if pos != label:
        sc = sc.join(bounded_broadcast(dictionary.select(label, pos), DICT_BROADCAST_BYTES), label)
    order = F.struct(-F.col("score"), F.col(pos))
    best = sc.groupBy(doc_key).agg(F.min_by(F.struct(F.col(label).alias("l"), F.col("score").alias("s")),
                                            order).alias("b"))
    first = dictionary.agg(F.min_by(F.col(label), F.col(pos))).scalar()
    base = docs.select(doc_key, first.alias("_first"))
    res = base.join(best, doc_key, "left")
    return res.select(doc_key,
                      F.coalesce(F.col("b.l"), F.col("_first")).alias(out_label),
                      F.round(F.coalesce(F.col("b.s"), F.lit(0.0)) * 100, 2).alias(out_score))


def match_part(docs: DataFrame, doc_key: str, text: str, parts: DataFrame, name: str,
               number: str) -> DataFrame:
    """Text -> part name, score (percent) and part number from a part
    dictionary (name words are the keywords; number = smallest number of
    that name)."""
    d = parts.groupBy(name).agg(F.min(number).alias("part_number")) \
        .withColumn("_kw", F.split(F.lower(F.col(name)), " ", -1))
    c = classify_text(docs, doc_key, text, d, name, "_kw", out_label="part_name",
                      out_score="part_score")
    return c.join(bounded_broadcast(d.select(F.col(name).alias("part_name"), "part_number"),
                                    DICT_BROADCAST_BYTES), "part_name", "left")


# ------------------------------------------------------------------ bigram Jaccard

def bigram_set(w: Column) -> Column:
    """Distinct character bigrams of a word, as an array."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 1, F.lit(1))),
                                         lambda i: F.substring(w, i, 2)))
    return F.filter(grams, lambda g: F.length(g) == 2)


def word_bigrams(words: DataFrame, word: str) -> DataFrame:
    """(word, bigram, nb) with the distinct character bigrams of each word
    and their count ``nb``."""
    return words.select(F.col(word).alias(word), bigram_set(F.col(word)).alias("_g")) \
        .select(word, F.explode("_g").alias("bigram"), F.size("_g").alias("nb"))


def jaccard_pairs(left: DataFrame, lw: str, right: DataFrame, rw: str,
                  same_first_letter: bool = False, threshold: float | None = None) -> DataFrame:
    """(left word, right word, sim) for word pairs sharing at least one
    bigram, sim = Jaccard index of their bigram sets; pairs sharing none
    have similarity 0 and are not emitted.

    With a ``threshold`` only pairs with ``sim >= threshold`` are returned,
    found by prefix filtering: bigrams are ordered by rarity and each word
    is indexed under its first ``|A| - floor(t|A|) + 1`` bigrams only (a
    pair reaching the threshold must share one of those), candidates are
    verified exactly with ``array_intersect``.  Common bigrams then no
    longer multiply the join.
    """
    if threshold is None:
        lb = word_bigrams(left.select(lw).distinct(), lw).withColumnRenamed("nb", "_nl")
        rb = word_bigrams(right.select(rw).distinct(), rw).withColumnRenamed("nb", "_nr") \
            .withColumnRenamed("bigram", "_rbg")
        cond = lb["bigram"] == rb["_rbg"]
        if same_first_letter:
            cond = cond & (F.substring(lb[lw], 1, 1) == F.substring(rb[rw], 1, 1))
        j = lb.join(bounded_broadcast(rb, DICT_BROADCAST_BYTES), cond)
        g = j.groupBy(lw, rw, "_nl", "_nr").agg(F.count(F.lit(1)).alias("_inter"))
        return g.select(lw, rw, (F.col("_inter") / (F.col("_nl") + F.col("_nr") - F.col("_inter")))
                        .alias("sim"))
    t = float(threshold)
    la = left.select(F.col(lw)).distinct().select(lw, bigram_set(F.col(lw)).alias("_la"))
    ra = right.select(F.col(rw)).distinct().select(rw, bigram_set(F.col(rw)).alias("_ra"))
    lb = la.select(lw, F.explode("_la").alias("bigram"), F.size("_la").alias("nb"))
    rb = ra.select(rw, F.explode("_ra").alias("bigram"), F.size("_ra").alias("nb"))
    # bigram vocabulary with frequencies: bounded by the distinct bigrams
    freq = lb.select("bigram").unionByName(rb.select("bigram")).groupBy("bigram") \
        .agg(F.count(F.lit(1)).alias("_df"))
    freq = bounded_broadcast(freq, DICT_BROADCAST_BYTES)

    def prefix(b: DataFrame, w: str) -> DataFrame:
        keep = F.col("nb") - F.floor(F.col("nb") * F.lit(t)) + 1
        win = Window.partitionBy(w).orderBy("_df", "bigram")
        return b.join(freq, "bigram").withColumn("_r", F.row_number().over(win)) \
            .filter(F.col("_r") <= keep).select(w, "bigram")
    lp = prefix(lb, lw)
    rp = prefix(rb, rw).withColumnRenamed("bigram", "_pbg")
    cond = lp["bigram"] == rp["_pbg"]
    if same_first_letter:
        cond = cond & (F.substring(lp[lw], 1, 1) == F.substring(rp[rw], 1, 1))
    cand = lp.join(bounded_broadcast(rp, DICT_BROADCAST_BYTES), cond).select(lw, rw).distinct()
    pairs = cand.join(la, lw).join(bounded_broadcast(ra, DICT_BROADCAST_BYTES), rw)
    inter = F.size(F.array_intersect("_la", "_ra"))
    sim = inter / (F.size("_la") + F.size("_ra") - inter)
    return pairs.select(lw, rw, sim.alias("sim")).filter(F.col("sim") >= t)


def jaccard_matches(left: DataFrame, lw: str, right: DataFrame, rw: str, threshold: float) -> DataFrame:
    """(left word, right word, sim) with bigram Jaccard ``sim >= threshold``, block
    by block (:mod:`tessera.operators.blocks`)."""
    ld = cut_lineage(left.select(F.col(lw).alias("l")).filter(F.col("l").isNotNull()).distinct())
    rd = cut_lineage(right.select(F.col(rw).alias("r")).filter(F.col("r").isNotNull()).distinct())
    t = float(threshold)

    def match(a, b):
        import pyarrow as pa
        if not a.num_rows or not b.num_rows:
            return pa.table({"l": pa.array([], pa.string()), "r": pa.array([], pa.string()), "sim": pa.array([], pa.float64())})
        i, j, sim = blocks.jaccard_above(a.column("l").to_pylist(), b.column("r").to_pylist(), t)
        return pa.table({"l": a.column("l").take(pa.array(i)), "r": b.column("r").take(pa.array(j)), "sim": sim})

    return blocks.met(ld, rd, ["l"], ["r"], WORD_BLOCK, DICT_BLOCK).applyInArrow(match, "l string, r string, sim double") \
        .select(F.col("l").alias(lw), F.col("r").alias(rw), "sim")


# ------------------------------------------------------------------ C05

def correct_words(words: DataFrame, word: str, vocab: DataFrame, vword: str, vpos: str,
                  keywords: DataFrame, kword: str, k: int = 10) -> DataFrame:
    """Spelling correction of distinct words: (word, corrected).

    A word in the vocabulary stays.  Otherwise the vocabulary words with the
    same first letter are ranked by Jaccard distance of bigram sets (ties in
    vocabulary order ``vpos``, then by word); among the first ``k`` the first that is a
    dictionary keyword replaces the word; none -> unchanged.

    Blocks of words meet blocks of vocabulary words of their letter; each pair of
    blocks gives a word's ``k`` nearest there, and the nearest of all blocks decide.
    """
    w = cut_lineage(words.select(F.col(word).alias("w")).filter(F.length("w") > 0).distinct())
    first = F.substring
    v = vocab.select(F.col(vword).alias("v"), F.col(vpos).alias("vp")).filter(F.length("v") > 0).distinct()
    kw = keywords.select(F.col(kword).alias("v")).distinct().withColumn("is_kw", F.lit(True))
    # positions as numbers: the words' order is all that counts
    v = cut_lineage(v.join(kw, "v", "left").select("v", "vp", F.coalesce("is_kw", F.lit(False)).alias("is_kw"),
                                                   first("v", 1, 1).alias("letter")))
    unknown = w.join(v.select(F.col("v").alias("w")), "w", "left_anti").withColumn("letter", first("w", 1, 1))
    place = v.schema["vp"].dataType.simpleString()

    def rank(a, b):
        import numpy as np
        import pyarrow as pa
        schema = pa.schema([("w", pa.string()), ("v", pa.string()), ("vp", b.schema.field("vp").type), ("is_kw", pa.bool_()), ("dist", pa.float64())])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        b = b.select(["v", "vp", "is_kw"]).sort_by([("vp", "ascending"), ("v", "ascending")])
        dist = 1 - blocks.jaccard(a.column("w").to_pylist(), b.column("v").to_pylist())
        near = np.argsort(dist, axis=1, kind="stable")[:, :k]  # equal distances stay in vocabulary order
        i, j = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
        part = b.take(pa.array(j))
        return pa.Table.from_arrays([a.column("w").take(pa.array(i)), *part.columns, pa.array(dist[i, j])], schema=schema)

    found = blocks.met(unknown, v, ["w"], ["v"], WORD_BLOCK, DICT_BLOCK, within="letter").applyInArrow(
        rank, f"w string, v string, vp {place}, is_kw boolean, dist double")
    order = Window.partitionBy("w").orderBy("dist", "vp", "v")
    best = found.withColumn("r", F.row_number().over(order)).filter((F.col("r") <= k) & F.col("is_kw")) \
        .groupBy("w").agg(F.min_by("v", "r").alias("corr"))
    return w.join(best, "w", "left").select(F.col("w").alias(word), F.coalesce("corr", "w").alias("corrected"))


correct_words_postings = correct_words  # the name under which marts know it


# ------------------------------------------------------------------ C04

def vector_matches(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(l, r, sim): words of two (word, vector) tables whose cosine is ``threshold``
    or more, block by block.  Words are unique in each; null, empty, zero and non-finite
    vectors, and vectors of another length than the other side's, are like none."""
    def side(df, name):
        word, vec = df.columns
        # floats travel as they are, half as long as doubles; cosines are of doubles
        x = F.col(vec) if isinstance(df.schema[vec].dataType.elementType, T.FloatType) else F.col(vec).cast("array<double>")
        x = df.select(F.col(word).alias(name), x.alias("x"))
        return cut_lineage(x.withColumn("dim", F.size("x")).filter((F.col("dim") > 0) & F.col(name).isNotNull()
                                                                   & ~F.exists("x", lambda e: e.isNull())))
    t = float(threshold)
    left, right = side(left, "l"), side(right, "r")
    from pyspark.sql.pandas.types import to_arrow_schema
    out = T.StructType([T.StructField("l", left.schema["l"].dataType), T.StructField("r", right.schema["r"].dataType),
                        T.StructField("sim", T.DoubleType())])
    schema = to_arrow_schema(out)

    def match(a, b):
        import numpy as np
        import pyarrow as pa
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        x, y = (c.column("x").combine_chunks().flatten().to_numpy().reshape(c.num_rows, -1).astype(np.float64) for c in (a, b))
        i, j, sim = blocks.cosine_above(x, y, t)
        columns = a.column("l").take(pa.array(i)), b.column("r").take(pa.array(j)), pa.chunked_array([pa.array(sim)])
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return blocks.met(left, right, ["l"], ["r"], LEFT_VECTORS, RIGHT_VECTORS, within="dim").applyInArrow(match, out)


def phrase_scores(doc_tokens: DataFrame, doc_key: str, token: str, phrases: DataFrame,
                  cls: str, phrase: str, pword: str, n_phrases: DataFrame,
                  stop_words=None, threshold: float = 0.35, vectors: DataFrame | None = None, n_rows: int | None = None) -> DataFrame:
    """Per (doc, class): ``max`` and ``mean`` over the class phrases of the
    phrase score = mean over the phrase's words (longer than 2 chars, not
    stop words) of the best similarity to any text token (< threshold -> 0).

    Words are alike by the Jaccard index of their bigrams or, with ``vectors`` (word,
    vector: a row a word), by the cosine of their vectors; a word without one is like none.

    ``n_phrases``: (cls, n) number of phrases of each class (the mean runs
    over all of them; phrases without countable words score 0 in the mean
    and are left out of the max).  Only docs with some similarity get rows.

    ``token`` is a word, or an array of words of a text: no word is a row then, and with their number ``n_rows``
    (or a little more) the arrays go straight to their blocks, without a copy.
    """
    stop = S.DEFAULT_STOP_WORDS if stop_words is None else list(stop_words)
    counts = lambda w: (F.length(F.col(w)) > 2) & ~F.col(w).isin(stop)
    if isinstance(doc_tokens.schema[token].dataType, T.ArrayType):
        texts = doc_tokens.select(F.col(doc_key).alias("doc"), F.col(token).alias("words"))
        if vectors is not None:
            texts = texts.select("doc", F.filter("words", lambda w: (F.length(w) > 2) & ~w.isin(stop)).alias("words")) \
                .groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
    else:
        texts = doc_tokens.filter(counts(token)).select(F.col(doc_key).alias("doc"), F.col(token).alias("w")) \
            .groupBy("doc").agg(F.collect_set("w").alias("words"))
    straight = n_rows is not None and vectors is None and isinstance(doc_tokens.schema[token].dataType, T.ArrayType)
    texts = texts if straight else cut_lineage(texts)
    pw = phrases.filter(counts(pword)).select(F.col(cls).alias("cls"), F.col(phrase).alias("phrase"), F.col(pword).alias("w"))
    score = _phrases_by_bigrams(texts, pw, float(threshold), stop, n_rows if straight else None) if vectors is None else \
        _phrases_by_vectors(texts, pw, vectors, float(threshold))
    agg = score.groupBy("doc", "cls").agg(F.max("top").alias("max_score"), F.sum("total").alias("_sum"))
    n = n_phrases.select(F.col(cls).alias("cls"), "n")
    return agg.join(bounded_broadcast(n, DICT_BROADCAST_BYTES), "cls").select(
        F.col("doc").alias(doc_key), F.col("cls").alias(cls), "max_score", (F.col("_sum") / F.col("n")).alias("mean_score"))


def _phrases_by_vectors(texts: DataFrame, pw: DataFrame, vectors: DataFrame, t: float) -> DataFrame:
    """(doc, cls, top, total), a row per text, class and block of phrases.

    Each different word meets the phrases' words once.  A block of texts then gets the
    matches of its different words and whole phrases; maxima over each text's words and means
    over each phrase's are taken in the task, so no rows of texts by phrase words are shuffled."""
    word, vec = vectors.columns
    pw = cut_lineage(pw.filter(F.col("cls").isNotNull() & F.col("phrase").isNotNull()))
    each = texts.select(F.explode("words").alias("w"))
    used = each.select("w", F.lit(1).alias("said"), F.lit(0).alias("asked")).unionByName(pw.select("w", F.lit(0).alias("said"), F.lit(1).alias("asked")))
    used = used.groupBy("w").agg(F.max("said").alias("said"), F.max("asked").alias("asked"))
    # numbers of the words, given once: the copy keeps them
    known = cut_lineage(vectors.select(F.col(word).alias("w"), F.col(vec).alias("x")).join(used, "w").withColumn("at", F.monotonically_increasing_id()))
    sims = cut_lineage(vector_matches(known.filter("said = 1").select("w", "x"), known.filter("asked = 1").select("at", "x"), t).filter(F.col("sim") > 0))

    whole = pw.join(known.filter("asked = 1").select("w", "at"), "w", "left").groupBy("cls", "phrase") \
        .agg(F.collect_list("at").alias("at"), F.count(F.lit(1)).alias("n")).filter(F.size("at") > 0)
    whole = cut_lineage(whole)
    n_words, n_said, n_sims, n_phrases = (x.first()[0] for x in (
        texts.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))), known.filter("said = 1").agg(F.count(F.lit(1))), sims.agg(F.count(F.lit(1))), whole.agg(F.count(F.lit(1)))))
    # a text's words and their matches, as many as a word has in the mean
    nb = max(1, -(-n_words * (n_said + n_sims) // max(1, n_said) // MATCHES_AT_ONCE))
    npb = max(1, -(-n_phrases // VECTOR_PHRASES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    texts = texts.withColumn("_b", F.pmod(F.xxhash64("doc"), F.lit(nb)).cast("int"))
    whole = whole.withColumn("_pb", F.pmod(F.xxhash64("cls", "phrase"), F.lit(npb)).cast("int"))

    if npb > 1:
        sims = sims.join(whole.select(F.explode("at").alias("r"), "_pb").distinct(), "r")
    else:
        sims = sims.withColumn("_pb", F.lit(0))
    # dealt by the word once, for its list and for the join
    matches = sims.repartition("l").groupBy("l", "_pb").agg(F.collect_list(F.struct(F.col("r").alias("at"), "sim")).alias("m"))
    said = texts.select("_b", F.explode("words").alias("l")).groupBy("l").agg(F.collect_set("_b").alias("_b"))
    matches = said.join(matches, "l").select(F.explode("_b").alias("_b"), "_pb", F.col("l").alias("w"), F.col("m.at").alias("at"), F.col("m.sim").alias("sim"))
    # phrases come with the matches, as rows without a word
    right = matches.unionByName(whole.withColumn("_b", every(nb)).select("_b", "_pb", "at", "cls", "n"), allowMissingColumns=True)

    from pyspark.sql.pandas.types import to_arrow_schema
    out = T.StructType([T.StructField("doc", texts.schema["doc"].dataType), T.StructField("cls", whole.schema["cls"].dataType),
                        T.StructField("top", T.DoubleType()), T.StructField("total", T.DoubleType())])
    schema = to_arrow_schema(out)

    def score(a, b):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        named = pc.is_valid(b.column("w"))
        found, phrases = b.filter(named), b.filter(pc.invert(named)).sort_by("cls")
        if not a.num_rows or not found.num_rows or not phrases.num_rows:
            return schema.empty_table()
        numbers = phrases.column("at").combine_chunks()
        begin_phrase = np.concatenate(([0], np.cumsum(pc.list_value_length(numbers).to_numpy())[:-1]))
        dictionary, to = np.unique(numbers.flatten().to_numpy(), return_inverse=True)
        n_phrase = phrases.column("n").to_numpy().astype(float)
        cls = phrases.column("cls").to_pylist()
        start = np.array([i for i in range(len(cls)) if i == 0 or cls[i] != cls[i - 1]])
        lists = found.column("at").combine_chunks()
        times_of = pc.list_value_length(lists).to_numpy()
        begin = np.cumsum(times_of) - times_of
        col, sim = np.searchsorted(dictionary, lists.flatten().to_numpy()), found.column("sim").combine_chunks().flatten().to_numpy()
        words = a.column("words").combine_chunks()
        size = pc.list_value_length(words).to_numpy()
        owner = np.repeat(np.arange(len(size)), size)
        at = pc.fill_null(pc.index_in(words.flatten(), value_set=found.column("w").combine_chunks()), -1).to_numpy()
        owner, at = owner[at >= 0], at[at >= 0]
        many = max(1, 4 * blocks.CELLS // max(len(dictionary), len(to)))
        docs, classes, tops, totals = [], [], [], []
        for lo in range(0, len(size), many):
            best = np.zeros((min(many, len(size) - lo), len(dictionary)))
            part = slice(*np.searchsorted(owner, (lo, lo + many)))
            place, row = at[part], (owner[part] - lo) * len(dictionary)
            upto = np.cumsum(times_of[place])
            i = 0
            while i < len(place):  # as many places of words as have some million matches
                j = max(i + 1, np.searchsorted(upto, (upto[i - 1] if i else 0) + blocks.CELLS, "right"))
                times = times_of[place[i:j]]
                pick = np.repeat(begin[place[i:j]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                np.maximum.at(best.ravel(), np.repeat(row[i:j], times) + col[pick], sim[pick])
                i = j
            phrase_score = np.add.reduceat(best[:, to], begin_phrase, axis=1) / n_phrase
            top, total = np.maximum.reduceat(phrase_score, start, axis=1), np.add.reduceat(phrase_score, start, axis=1)
            d, c = np.nonzero(top)
            docs.append(lo + d), classes.append(start[c]), tops.append(top[d, c]), totals.append(total[d, c])
        docs, classes, tops, totals = (np.concatenate(x) for x in (docs, classes, tops, totals))
        columns = a.column("doc").take(pa.array(docs)), phrases.column("cls").take(pa.array(classes)), pa.chunked_array([tops]), pa.chunked_array([totals])
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    left = texts.withColumn("_pb", every(npb))
    return left.groupBy("_b", "_pb").cogroup(right.groupBy("_b", "_pb")).applyInArrow(score, out)


def _phrases_by_bigrams(texts: DataFrame, pw: DataFrame, t: float, stop: list[str], n_rows: int | None) -> DataFrame:
    """(doc, cls, top, total), a row per text, class and block of phrases.  ``texts``: (doc, words); the rows of a
    text lie in one block and are put together there.

    Blocks of texts meet blocks of whole phrases: the different words of up to
    ``TOKENS_AT_ONCE`` words of texts are compared with the phrases' words once; maxima over
    each text's words and means over each phrase's are taken in the task."""
    whole = cut_lineage(pw.groupBy("cls", "phrase").agg(F.collect_list("w").alias("words")))
    from pyspark.sql.pandas.types import to_arrow_schema
    out = T._parse_datatype_string(f"doc {texts.schema['doc'].dataType.simpleString()}, "
                                   f"cls {whole.schema['cls'].dataType.simpleString()}, top double, total double")
    schema = to_arrow_schema(out)
    left_out = set(stop)

    def score(a, b):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        b = b.sort_by("cls")
        phrase_words = b.column("words").to_pylist()
        dictionary, to = np.unique(np.array([w for p in phrase_words for w in p], object), return_inverse=True)
        dictionary = list(dictionary)
        width = np.array([len(p) for p in phrase_words])
        texts_words = a.column("words").combine_chunks()
        numbers: dict[str, int] = {}
        number = np.array([numbers.setdefault(repr(d), len(numbers)) for d in a.column("doc").to_pylist()])
        size = np.bincount(number)
        first = np.zeros(len(size), np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
        flat = texts_words.flatten()
        owner = np.repeat(number, pc.fill_null(pc.list_value_length(texts_words), 0).to_numpy())
        best = np.zeros((len(size), len(dictionary)))
        for lo in range(0, len(flat), TOKENS_AT_ONCE):
            coded = flat.slice(lo, TOKENS_AT_ONCE).dictionary_encode()
            at = coded.indices.to_numpy()
            words = ["" if w is None or len(w) < 3 or w in left_out else w for w in coded.dictionary.to_pylist()]  # "" is like none
            i, j, sim = blocks.jaccard_above(words, dictionary, t)
            n = np.bincount(i, minlength=len(words))
            begin = np.cumsum(n) - n
            # each place of a word takes the word's matches
            for few in range(0, len(at), PLACES_AT_ONCE):
                here = at[few:few + PLACES_AT_ONCE]
                times = n[here]
                pick = np.repeat(begin[here] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                row = np.repeat(owner[lo + few:lo + few + len(here)], times) * len(dictionary)
                np.maximum.at(best.ravel(), row + j[pick], sim[pick])
        cls = b.column("cls").to_pylist()
        start = [i for i in range(len(cls)) if i == 0 or cls[i] != cls[i - 1]]
        top, total = np.zeros((len(size), len(start))), np.zeros((len(size), len(start)))
        many = max(1, blocks.CELLS // len(to))
        for lo in range(0, len(size), many):  # as many texts as have some million words of phrases
            phrase_score = np.add.reduceat(best[lo:lo + many, to], np.cumsum(width) - width, axis=1) / width
            top[lo:lo + many] = np.maximum.reduceat(phrase_score, start, axis=1)
            total[lo:lo + many] = np.add.reduceat(phrase_score, start, axis=1)
        i, j = np.nonzero(top)
        columns = a.column("doc").take(pa.array(first[i])), b.column("cls").take(pa.array(np.array(start)[j])), top[i, j], total[i, j]
        return pa.table([pa.chunked_array([c]) if isinstance(c, np.ndarray) else c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return blocks.met(texts, whole, ["doc"], ["cls", "phrase"], TEXT_BLOCK, PHRASE_BLOCK, left_rows=n_rows).applyInArrow(score, out)


# ------------------------------------------------------------------ C06

def top_keywords(docs: DataFrame, doc_key: str, tokens: Column, k: int = 20,
                 min_len: int = 3, stop_words=None) -> DataFrame:
    """Top-k single-word keywords per text by TF-IDF (ties -> word), joined
    by ``", "`` in score order.  Re-aimed from a per-row keyword extractor.

    Whole texts are dealt by key, their words counted where they lie.  Words in more than one text of
    ``COMMON`` (at most that many times the words of a mean text) bring their frequency to the texts by
    broadcast and are cut to the first ``k`` there; only rows of the other words are shuffled."""
    stop = S.DEFAULT_STOP_WORDS if stop_words is None else list(stop_words)
    tc = docs.repartition(doc_key).select(doc_key, F.explode(tokens).alias("w")) \
        .filter((F.length("w") >= min_len) & ~F.col("w").isin(stop)) \
        .groupBy(doc_key, "w").agg(F.count(F.lit(1)).alias("tf"))
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    df_ = cut_lineage(tc.groupBy("w").agg(F.count(F.lit(1)).alias("df")).withColumn("_n", n_docs))
    often = F.col("df") * COMMON > F.col("_n")
    marked = tc.join(F.broadcast(df_.filter(often)), "w", "left")
    rare = marked.filter(F.col("df").isNull()).drop("df", "_n").join(df_.filter(~often), "w")
    sc = marked.filter(F.col("df").isNotNull()).unionByName(rare) \
        .withColumn("tfidf", F.col("tf") * F.log(F.col("_n") / F.col("df")))
    w = Window.partitionBy(doc_key).orderBy(F.col("tfidf").desc(), F.col("w"))
    top = sc.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    return top.groupBy(doc_key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "w"))), lambda s: s["w"]),
                     ", ").alias("keywords"))


# ------------------------------------------------------------------ C07 / C08

def label_centroids(vectors: DataFrame, vec: str, label: str) -> DataFrame:
    """Element-wise mean vector per label: one row (label, centroid) each."""
    ex = vectors.select(label, F.posexplode(vec).alias("pos", "x"))
    means = ex.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("cv"))
    return means.groupBy(label).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "cv"))), lambda s: s["cv"]).alias("centroid"))


def embed_cosine(vectors: DataFrame, key: str, vec: str, centroids: DataFrame, label: str) -> DataFrame:
    """Cosine of every vector with every class centroid: (key, label, cos).

    Blocks of vectors meet blocks of centroids of their length, a matrix product gives all their
    cosines.  Null and zero vectors, and vectors with a null component, have none."""
    def side(df, name, key, vec):
        x = df.select(F.col(key).alias(name), F.col(vec).cast("array<double>").alias("x"))
        return cut_lineage(x.withColumn("dim", F.size("x")).filter((F.col("dim") > 0) & ~F.exists("x", lambda e: e.isNull())))
    left, right = side(vectors, "k", key, vec), side(centroids, "l", label, "centroid")
    from pyspark.sql.pandas.types import to_arrow_schema
    out = T.StructType([T.StructField("k", left.schema["k"].dataType), T.StructField("l", right.schema["l"].dataType),
                        T.StructField("cos", T.DoubleType())])
    schema = to_arrow_schema(out)

    def compare(a, b):
        import numpy as np
        import pyarrow as pa
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        x, y = (c.column("x").combine_chunks().flatten().to_numpy().reshape(c.num_rows, -1) for c in (a, b))
        nx, ny = (np.sqrt((v * v).sum(1)) for v in (x, y))
        i, j = np.nonzero((nx != 0)[:, None] & (ny != 0)[None, :])
        with np.errstate(invalid="ignore"):
            cos = (x @ y.T)[i, j] / (nx[i] * ny[j])
        columns = a.column("k").take(pa.array(i)), b.column("l").take(pa.array(j)), pa.chunked_array([pa.array(cos)])
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return blocks.met(left, right, ["k"], ["l"], WORD_BLOCK, DICT_BLOCK, within="dim").applyInArrow(compare, out) \
        .select(F.col("k").alias(key), F.col("l").alias(label), "cos")


def blend_predict(s1: DataFrame, s2: DataFrame, key: str, cls: str, score1: str, score2: str,
                  w1: float, w2: float, classes: DataFrame, cls_pos: str,
                  allowed: DataFrame | None = None) -> DataFrame:
    """Blend two class-score tables ``s1/w1 + s2/w2`` (missing -> 0), zero the
    classes outside ``allowed`` (key, cls) when given, argmax (first class
    position wins ties): (key, label, score)."""
    a = s1.select(key, cls, F.col(score1).alias("_a"))
    b = s2.select(key, cls, F.col(score2).alias("_b"))
    j = a.join(b, [key, cls], "full_outer") \
        .withColumn("v", F.coalesce("_a", F.lit(0.0)) / w1 + F.coalesce("_b", F.lit(0.0)) / w2)
    if allowed is not None:
        # a key listed in ``allowed`` keeps only its listed classes; keys not
        # listed have no mask
        al = allowed.select(key, cls).withColumn("_ok", F.lit(True))
        masked = allowed.select(key).distinct().withColumn("_masked", F.lit(True))
        j = j.join(al, [key, cls], "left").join(masked, key, "left").withColumn(
            "v", F.when(F.col("_masked") & F.col("_ok").isNull(), F.lit(0.0)).otherwise(F.col("v")))
    # argmax over the whole class list (the model's output space, so bounded by
    # construction): a class without a score, or masked, stands at 0
    order = classes.agg(F.array_sort(F.collect_list(F.struct(F.col(cls_pos).alias("p"), F.col(cls).alias("l"))))).scalar()
    # one pass, so that the scores are made once: rows of no class or no score have no place in the order
    j = j.join(F.broadcast(classes.select(cls, cls_pos, F.lit(True).alias("_listed"))), cls, "left")
    counts = (F.col("v") != 0) & F.col("_listed")
    best = j.groupBy(key).agg(
        F.min_by(F.struct(F.col(cls).alias("l"), F.col("v").alias("s")), F.when(counts, F.struct(-F.col("v"), F.col(cls_pos)))).alias("b"),
        F.collect_set(F.when(counts, F.col(cls))).alias("scored")).withColumn("order", order)
    rest = F.element_at(F.filter("order", lambda c: ~F.array_contains("scored", c["l"])), 1)
    zero = F.when(rest.isNotNull(), F.struct(rest["l"].alias("l"), F.lit(0.0).alias("s")))
    pick = F.when(F.col("b.s") > 0, F.col("b")).otherwise(F.coalesce(zero, F.col("b")))
    return best.select(key, pick["l"].alias("label"), pick["s"].alias("score"))


# ------------------------------------------------------------------ X11

def extract_term(docs: DataFrame, doc_key: str, tokens: Column, terms: DataFrame, term: str,
                 term_pos: str) -> DataFrame:
    """First dictionary term found on token boundaries: (doc_key, term).

    Each token meets the terms that begin with it (an equi-join); only there the
    term's own number of tokens is put together and compared.  The match with the
    smallest start (then longest, then dictionary position) wins — what a
    leftmost regex alternation over the terms returns."""
    parts = F.split("_gram", " ", -1)
    d = terms.select(F.col(term).alias("_gram"), F.col(term_pos).alias("_tp")).select(
        "_gram", "_tp", F.get(parts, F.lit(0)).alias("_first"), F.size(parts).alias("_n"))
    more = d.agg(F.coalesce(F.max("_n") - 1, F.lit(0))).scalar()  # tokens that may follow a first one
    t = docs.select(doc_key, tokens.alias("_t")).withColumn("_more", more)
    each = t.select(doc_key, "_t", "_more", F.posexplode("_t").alias("_start", "_first")) \
        .select(doc_key, "_start", "_first", F.slice("_t", F.col("_start") + 2, F.col("_more")).alias("_next"))
    # a join on the size the optimizer guesses could broadcast the texts
    d = F.broadcast(d) if fits_broadcast(d, DICT_BROADCAST_BYTES) else d.hint("merge")
    spelt = F.array_join(F.concat(F.array("_first"), F.slice("_next", F.lit(1), F.col("_n") - 1)), " ")
    m = each.join(d, "_first").filter((F.col("_n") == 1) | (spelt == F.col("_gram")))
    # leftmost match; at one start the longest term (a named-list regex
    # prefers it), then dictionary position
    order = F.struct("_start", -F.length("_gram"), "_tp")
    return m.groupBy(doc_key).agg(F.min_by(F.col("_gram"), order).alias(term))
