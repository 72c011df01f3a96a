"""Growth of single steps: what a plan or a helper must not do, whatever the size of its input."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import blocks
from tessera.operators import joins as J
from tessera.operators import models as MO
from tessera.operators import text as TX


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_met_without_a_matrix_of_all_pairs():
    """similar words are found in lots; no matrix of all words by all dictionary words."""
    rng = random.Random(3)
    a, b = ([*dict.fromkeys("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(n))] for n in (20_000, 3_000))
    want = blocks.jaccard(a[:500], b)
    tracemalloc.start()
    i, j, sim = blocks.jaccard_above(a, b, 0.35)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(a) * len(b), peak  # a float32 matrix of all pairs alone
    at = i < 500
    assert [(x, y) for x, y in zip(i[at], j[at])] == [(x, y) for x, y in zip(*np.nonzero(want >= 0.35))]
    assert np.array_equal(sim[at], want[i[at], j[at]])


def test_cosine_deals_texts_once(spark, tmp_path):
    """F14 (F2, F4, F6, F12): words of a text are added up where the text lies, not shuffled by word."""
    docs = spark.createDataFrame([(i, f"a b c{i % 3} d") for i in range(30)] + [(30, "z"), (None, "a b")], "k int, t string")
    words = spark.createDataFrame([("x", ["a", "b"]), ("y", ["c1", "q"]), ("y", ["c1"]), (None, ["d"])], "label string, kw array<string>")
    words.write.parquet(str(tmp_path / "words"))
    sc = TX.bow_cosine(docs, "k", "t", spark.read.parquet(str(tmp_path / "words")), "label", "kw")
    exchanges = [x for x in plan_of(sc).splitlines() if "Exchange hashpartitioning(k" in x]
    assert len(exchanges) == 1 and "token" not in exchanges[0], exchanges
    got = {(r["k"], r["label"]): r["score"] for r in sc.collect()}
    assert len(got) == 40 and all(abs(got[i, "x"] - 2 / (2 * 2 ** 0.5)) < 1e-12 for i in range(30))
    assert all(abs(got[i, "y"] - 2 / (2 * 5 ** 0.5)) < 1e-12 for i in range(1, 30, 3))


def largest_part(df) -> int:
    """Rows of the fullest partition: its sort or build is what a task holds."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def without_help(spark):
    """No broadcast by size and no adaptive splits: the join must spread the rows itself."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return before


def test_default_key_is_spread(spark, monkeypatch):
    """the rows without a key, all under the default's, do not meet in one task."""
    monkeypatch.setattr(J, "CHUNK_ROWS", 50, raising=False)
    a = spark.range(4000).select("id", F.when(F.col("id") < 100, F.col("id").cast("string")).alias("k"))
    b = spark.createDataFrame([("X", "none"), ("X", "twice"), *[(str(i), f"n{i}") for i in range(50)]], "t string, name string")
    before = without_help(spark)
    try:
        out = J.join_default_key(a, b, "k", "t", "X")
        assert out.columns == ["id", "k", "t", "name"]
        assert out.count() == 50 + 2 * 3900 and out.filter("k is null").select("id", "name").distinct().count() == 7800
        assert largest_part(out) < 3900
        left = J.join_default_key(a, b, "k", "t", "X", "left")
        assert left.count() == 100 + 2 * 3900 and left.filter("name is null").count() == 50
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_constant_of_sparse_models_is_spread(spark, monkeypatch):
    """every row has the constant's entry; scoring does not gather them in one task."""
    monkeypatch.setattr(J, "CHUNK_ROWS", 50, raising=False)
    f = spark.range(4000).select("id", F.lit("r").alias("region"), (F.col("id") % 400).alias("c"), F.array(F.struct(
        (F.col("id") % 400).alias("i"), F.lit(1.0).alias("x"))).alias("v"))
    models = spark.createDataFrame([("r", "lr", -1, 2.0), *[("r", "lr", i, float(i)) for i in range(400)]],
                                   "region string, algoname string, i long, weight double")
    seen = []
    real = MO.spread_join if hasattr(MO, "spread_join") else None
    assert real, "entries are joined by key alone"
    monkeypatch.setattr(MO, "spread_join", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    before = without_help(spark)
    try:
        pred = MO.predict_sparse(f, models, ["region"], "v")
        assert pred.filter(F.col("pred") == 2.0 + F.col("c")).count() == 4000 == pred.count()
        assert largest_part(seen[0]) < 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cosines_come_from_matrix_products(spark):
    """vectors meet centroids in blocks, no expression over a list of all centroids in each row."""
    nan = float("nan")
    v = spark.createDataFrame([((1, 0), [3.0, 4.0]), ((1, 1), [0.0, 0.0]), ((2, 0), None), ((2, 1), [1.0, None]), ((3, 0), [1.0]), ((4, 0), [nan, 1.0])],
                              "m struct<a: int, b: int>, x array<float>")
    c = spark.createDataFrame([("p", [1.0, 0.0]), ("q", [0.0, 0.0]), ("r", [-4.0, 3.0])], "label string, centroid array<double>")
    out = TX.embed_cosine(v, "m", "x", c, "label")
    assert "CoGroup" in plan_of(out)
    got = {(r["m"]["a"], r["m"]["b"], r["label"]): r["cos"] for r in out.collect()}
    assert sorted(got) == [(1, 0, "p"), (1, 0, "r"), (4, 0, "p"), (4, 0, "r")]
    assert abs(got[1, 0, "p"] - 0.6) < 1e-12 and abs(got[1, 0, "r"]) < 1e-12 and got[4, 0, "p"] != got[4, 0, "p"]


def test_keywords_shuffle_texts_not_counted_words(spark, monkeypatch):
    """no exchange of (text, word) rows; common and rare words give the ranking of a count over all."""
    from collections import Counter
    from math import log
    monkeypatch.setattr(TX, "COMMON", 4, raising=False)
    rng = random.Random(5)
    texts = {i: [rng.choice(["every"] * 6 + [f"word{rng.randint(0, 60)}", f"seldom{rng.randint(0, 900)}"]) for _ in range(30)] for i in range(40)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "k int, t string")
    out = TX.top_keywords(docs, "k", F.split("t", " "), k=5)
    assert not [x for x in plan_of(out).splitlines() if "Exchange hashpartitioning(k" in x and ", w#" in x]
    df = Counter(w for t in texts.values() for w in set(t))
    want = {i: ", ".join(sorted(set(t), key=lambda w: (-Counter(t)[w] * log(40 / df[w]), w))[:5]) for i, t in texts.items()}
    assert {r["k"]: r["keywords"] for r in out.collect()} == want


def test_gated_posts_are_scored_once(spark, monkeypatch):
    """both tasks blend the same scores, of the posts that pass the gate only."""
    from conftest import SMALL
    from tessera.plans import q_text as QT
    seen = []
    real = TX.phrase_scores
    monkeypatch.setattr(TX, "phrase_scores", lambda toks, *a, **k: seen.append(toks) or real(toks, *a, **k))
    QT.c09_f10(spark, SMALL)
    assert len(seen) == 1
    assert seen[0].filter("doc_id % 3 = 0 or doc_id % 4 = 0 or doc_id % 5 = 1 or doc_id % 7 >= 3").isEmpty()


def test_small_models_meet_rows_where_they_lie(spark):
    """F16: rows are not brought together by a key of few values to be scored, nor does one task hold such a key's rows."""
    df = spark.range(4000).select("id", (F.col("id") % 2).alias("k"), (F.col("id") % 4 > 1).cast("int").alias("x"),
                                  (F.col("id") % 4).cast("double").alias("y"))
    models = MO.fit_trees(df, ["k"], ["x"], "y", rounds=1, rate=1.0, depth=2)
    before = without_help(spark)
    try:
        scored = MO.predict_trees(df, models, ["k"], ["x"])
        assert "hashpartitioning(k" not in plan_of(scored), plan_of(scored)
        assert scored.count() == 4000 and scored.filter(F.abs(F.col("pred") - F.col("y")) > 1e-9).isEmpty()
        many, MO.MODELS_BROADCAST_BYTES = MO.MODELS_BROADCAST_BYTES, 0
        chunk, MO.spread_join.__globals__["CHUNK_ROWS"] = MO.spread_join.__globals__["CHUNK_ROWS"], 200
        try:
            spread = MO.predict_trees(df, models, ["k"], ["x"])
            assert largest_part(spread) < 1500
            assert sorted(r["pred"] for r in spread.collect()) == sorted(r["pred"] for r in scored.collect())
        finally:
            MO.MODELS_BROADCAST_BYTES, MO.spread_join.__globals__["CHUNK_ROWS"] = many, chunk
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sums_of_products_without_rows_of_products(spark):
    """listed features have their products added up as columns, with the answer of the exploded ones."""
    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("a"),
                                 F.lit(0.0).alias("none"), F.when(F.col("id") % 11 > 0, (F.col("id") * 37) % 101).alias("y"))
    few = MO.fit_linear(df, ["k"], ["a", "none"], "y")
    assert "Generate explode" not in plan_of(few), plan_of(few)
    dense, MO.DENSE_FEATURES = MO.DENSE_FEATURES, 0
    try:
        many = MO.fit_linear(df, ["k"], ["a", "none"], "y").orderBy("k").collect()
    finally:
        MO.DENSE_FEATURES = dense
    for x, y in zip(few.orderBy("k").collect(), many):
        assert (x["k"], x["n_train"]) == (y["k"], y["n_train"]) and x["coef"][1] == 0
        assert np.allclose([x["intercept"], *x["coef"], x["r2"]], [y["intercept"], *y["coef"], y["r2"]])


def test_features_of_a_run_are_joined_once(spark):
    """what bounds, training and scoring read is a file, not the joins of five tables again."""
    from tessera.plans import q_models as QM
    plan = plan_of(QM.keyed_features(spark, "/root/testdata/sf0.001"))
    assert "Join" not in plan and "lineitem" not in plan, plan


def test_rows_of_a_delivery_are_few_files(spark, tmp_path):
    """a stream's micro-batches, and what their tasks report, do not grow with the tasks that wrote its files."""
    from tessera.plans.q_io import deliver
    deliver(spark.range(5000).repartition(40), str(tmp_path / "src"))
    deliver(spark.range(100).repartition(40), str(tmp_path / "src"))
    assert len(list((tmp_path / "src").glob("part-*"))) == 2
    assert spark.read.parquet(str(tmp_path / "src")).count() == 5100


def test_receipts_of_one_vendor_are_spread(spark, tmp_path):
    """a task's share of the distinct receipts does not grow with the table, whoever sent them."""
    from tessera.operators import aggregates as A
    from tessera.plans import analogues as AN
    from tessera.plans import marts as M
    rows = spark.range(6000).select(F.lit("1").alias("venp_vend_code"), (F.col("id") % 3000).cast("string").alias("venp_root_part"),
                                    F.lit("a-R").alias("venp_item_code"), F.lit(202402).alias("venp_month"),
                                    F.when(F.col("id") % 3000 > 99, 2.0).alias("venp_tot_recd_qty"))
    vendors = spark.createDataFrame([("1", "2", "own"), ("2", "none", "parent")], "ctrr_code string, ctrr_parent_vend_code string, ctrr_name string")
    vendors.write.parquet(str(tmp_path / "vendors"))
    vendors = spark.read.parquet(str(tmp_path / "vendors"))
    before, A.DISTINCT_ROWS = A.DISTINCT_ROWS, 300
    try:
        out = M.supply_receipts(rows, vendors, AN.AS_OF)
        assert out.count() == 2900 and out.select("vendor_name").distinct().collect() == [("parent",)]
        hot = spark.range(6000).select(F.when(F.col("id") % 3000 < 2990, 1).otherwise(2).alias("vendor"), (F.col("id") % 3000).alias("part"))
        apart = A.distinct_rows(hot, 6000)
        dealt = [x for x in plan_of(apart).splitlines() if "Exchange" in x]
        assert len(dealt) == 1 and ", 20)" in dealt[0] and "vendor" in dealt[0] and "part" in dealt[0], dealt
    finally:
        A.DISTINCT_ROWS = before


def test_trims_take_no_step_for_each_character(spark):
    """a text is trimmed by a few replacements over the whole of it, not by a fold over its characters, and to the same length."""
    from tessera.functions import strings as S
    rng = random.Random(7)
    alphabet = list("ab ") * 6 + [*"\\\n\t\r\0\x1f\x7f\x80\xff\u0100\uffff\U00010000", "\U0001f600"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [None, "", "\0" * 30, "x" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for size in (1, 4, 11, 30):
        out = df.select(S.trim_escaped("t", size).alias("o"))
        assert "aggregate(" not in plan_of(out), plan_of(out)
        assert [r["o"] for r in out.collect()] == [S.trim_escaped_py(t, size) for t in texts]


def test_vector_phrases_shuffle_no_text_by_phrase_word(spark, monkeypatch):
    """F8: maxima over a text's words are taken where its matches are; the answer is that of all pairs, in blocks of any size."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(60)]
    vectors = {w: rng.normal(size=5).astype(np.float32) for w in words[:50]} | {"w50": np.zeros(5, np.float32), "w51": np.ones(3, np.float32)}
    toks = [(f"d{rng.integers(30)}", rng.integers(2).item(), words[rng.integers(60)]) for _ in range(500)] + [("none", 0, "w55"), ("null", 0, None)]
    phrases = [(c, f"p{p}", words[rng.integers(60)]) for c in range(3) for p in range(6) for _ in range(rng.integers(1, 5))]
    phrases += [(1, "twice", "w1"), (1, "twice", "w1"), (2, "lost", "w59"), (None, "p0", "w1"), (1, None, "w1")]
    t = spark.createDataFrame(toks, "a string, b int, w string").select(F.struct("a", "b").alias("m"), "w")
    p = spark.createDataFrame(phrases, "c int, p string, w string")
    n = spark.createDataFrame([(c, 9) for c in range(3)], "c int, n long")
    v = spark.createDataFrame([(w, x.tolist()) for w, x in vectors.items()] + [("w52", None), ("w53", [1.0, None, 1.0, 1.0, 1.0])], "w string, x array<float>")

    def cosine(a, b):
        x, y = (np.array(vectors.get(w, [0.0]), np.float64) for w in (a, b))
        return x @ y / np.sqrt((x @ x) * (y @ y)) if len(x) == len(y) and x.any() and y.any() else 0.0
    want = {}
    for d in {x[:2] for x in toks}:
        own = {w for *k, w in toks if tuple(k) == d and w}
        for c in range(3):
            scores = []
            for ph in {x for k, x, _ in phrases if k == c and x}:
                pw = [w for k, x, w in phrases if (k, x) == (c, ph)]
                scores.append(sum(max([s for s in (cosine(w, o) for o in own) if s >= 0.35], default=0.0) for w in pw) / len(pw))
            if any(scores):
                want[(*d, c)] = max(scores), sum(scores) / 9
    for size in (3, 10_000):
        for knob in ("LEFT_VECTORS", "RIGHT_VECTORS", "VECTOR_PHRASES", "MATCHES_AT_ONCE"):
            monkeypatch.setattr(TX, knob, size, raising=False)
        # the length of a word counts too: letters make every word count
        longer = lambda df: df.withColumn("w", F.concat(F.lit("word"), "w"))
        out = TX.phrase_scores(longer(t), "m", "w", longer(p), "c", "p", "w", n, stop_words=[], vectors=longer(v))
        dealt = [x for x in plan_of(out).splitlines() if "Exchange hashpartitioning(doc" in x]
        assert dealt and all(x.split("hashpartitioning(")[1].split(", ")[1].startswith("cls") for x in dealt), dealt
        got = {(r["m"]["a"], r["m"]["b"], r["c"]): (r["max_score"], r["mean_score"]) for r in out.collect()}
        assert got.keys() == want.keys() and len(got) > 100
        assert all(np.allclose(got[k], want[k]) for k in want)
