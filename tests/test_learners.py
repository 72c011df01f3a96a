"""Per-key models against direct computations: deep trees, wide least squares,
algorithms plugged in."""

import pickle
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import algorithms as AL
from tessera.operators import models as MO


def tree_rows(n=700):
    rng = np.random.default_rng(3)
    out = []
    for i in range(n):
        a, b = float(rng.integers(0, 25)), float(rng.normal())
        y = (4 if a > 11 else 0) - (3 if b > 0.4 and a > 5 else 0) + float(rng.normal()) * 0.3 + i % 3
        out.append((f"k{i % 3}" if i < n - 2 else "one", a, None if i % 23 == 0 else b, y))
    return out


def brute_boosting(rows, cuts, rounds, rate, depth):
    """Trees of one key by trying every cut at every node: predictions and the nodes."""
    bins = [[sum(1 for c in cuts[f] if v is None or v > c) for f, v in enumerate(r[1:3])] for r in rows]
    y = np.array([r[3] for r in rows])
    pred, trees = np.full(len(y), y.mean()), []
    for _ in range(rounds):
        res, node, value, tree = y - pred, np.ones(len(y), int), np.zeros(len(y)), {}
        for level in range(depth):
            for k in np.unique(node):
                at = np.flatnonzero(node == k)
                if k < 2 ** level:
                    continue
                before, best = round(res[at].sum() ** 2 / len(at), 9), None
                for f in (0, 1):
                    for c in range(len(cuts[f])):
                        left = np.array([bins[i][f] <= c for i in at])
                        if left.all() or not left.any():
                            continue
                        gain = round(res[at][left].sum() ** 2 / left.sum() + res[at][~left].sum() ** 2 / (~left).sum(), 9)
                        if gain > before and (best is None or gain > best[0]):
                            best = gain, f, c, left
                if best:
                    _, f, c, left = best
                    tree[int(k)] = (f, cuts[f][c])
                    for side, m in ((0, left), (1, ~left)):
                        node[at[m]] = 2 * k + side
                        value[at[m]] = rate * res[at][m].mean()
        pred = pred + value
        trees.append(tree)
    return pred, trees


def test_deep_trees_equal_brute_force(spark):
    rows = tree_rows()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, k string, a double, b double, y double").repartition(4)
    qs = [k / 6 for k in range(1, 6)]
    got = df.agg(F.percentile_approx("a", qs), F.percentile_approx("b", qs)).first()
    cuts = [sorted(set(got[0])), sorted(set(got[1]))]
    m = MO.fit_trees(df, ["k"], ["a", "b"], "y", rounds=2, rate=0.5, bins=6, depth=3)
    models = {r.k: r for r in m.collect()}
    pred = {r.id: r.pred for r in MO.predict_trees(df, m, ["k"], ["a", "b"]).collect()}
    for k in models:
        own = [(i, *r) for i, r in enumerate(rows) if r[0] == k]
        want, trees = brute_boosting([r[1:] for r in own], cuts, 2, 0.5, 3)
        assert [pred[r[0]] for r in own] == pytest.approx(want.tolist(), abs=1e-9)
        assert [{n: (t.feature, t.cut) for n, t in tree.items() if t.feature is not None} for tree in models[k].trees] == trees
    assert max(len(t) for r in models.values() for t in r.trees) > 7 and models["one"].n_train == 2


def test_depth_one_is_a_cut_a_round(spark):
    df = spark.createDataFrame(tree_rows(), "k string, a double, b double, y double")
    m = MO.fit_trees(df, ["k"], ["a", "b"], "y", rounds=3)
    assert all(len(r.steps) == 3 for r in m.collect())
    assert MO.fit_trees(df.limit(0), ["k"], ["a", "b"], "y").count() == 0


def test_wide_least_squares_is_the_closed_form(spark):
    # one key, 20,000 categories of 1 to 4 rows: the fit of a category is its mean
    df = spark.range(50_000).selectExpr("'k' k", "id", "concat('c', cast(pow(id % 20000, 1) as long)) cat",
                                        "cast((id * 7919) % 1000 as double) / 10 y").unionByName(
        spark.range(300).selectExpr("concat('s', id % 3) k", "id", "concat('c', id % 5) cat", "cast(id % 11 as double) y"))
    v = MO.sparse_one_hot(df, ["cat"])
    m = MO.fit_sparse(v, ["k"], "x", "y")
    assert m.where("k = 'k'").count() == 20_001 and m.where("k = 's0'").count() == 6
    pred = MO.predict_sparse(v, m, ["k"], "x")
    mean = df.groupBy("k", "cat").agg(F.avg("y").alias("mean"))
    assert pred.count() == 50_300
    assert pred.join(mean, ["k", "cat"]).agg(F.max(F.abs(F.col("pred") - F.col("mean")))).first()[0] < 1e-6


def test_least_squares_equals_pseudo_inverse(spark):
    rng = np.random.default_rng(2)
    data = [(f"k{i % 3}", f"c{rng.integers(5)}", float(rng.normal() * 4), float(rng.integers(0, 3)), float(rng.normal())) for i in range(240)]
    data += [("flat", "c1", 0.0, 0.0, 2.5)] * 3 + [("null", "c1", 1.0, 1.0, None)] + [(None, "c2", 1.0, 2.0, 3.0), (None, "c3", 2.0, 1.0, 5.0)]
    df = spark.createDataFrame(data, "k string, cat string, p double, q double, y double")
    v = MO.sparse_one_hot(df, ["cat"], ["p", "q"])
    got = {}
    for r in MO.fit_sparse(v, ["k"], "x", "y").collect():
        got.setdefault(r.k, {})[r.i] = r
    names = {r.n: r.h for r in spark.createDataFrame([(n,) for n in ["p", "q", *[f"cat_c{c}" for c in range(5)]]], "n string")
             .select("n", F.xxhash64("n").alias("h")).collect()}
    for k in {d[0] for d in data} - {"null"}:
        own = [d for d in data if d[0] == k]
        cats = sorted({d[1] for d in own})
        a = np.array([[1.0, *[float(d[1] == c) for c in cats], d[2], d[3]] for d in own])
        y = np.array([d[4] for d in own])
        w = np.linalg.pinv(a) @ y
        order = [-1, *[names[f"cat_{c}"] for c in cats], names["p"], names["q"]]
        assert [got[k][i].weight if i in got[k] else 0.0 for i in order] == pytest.approx(w.tolist(), abs=1e-7)
        one = got[k][-1]
        assert one.n_train == len(own)
        if y.std():
            assert one.r2 == pytest.approx(1 - ((a @ w - y) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-7)
    assert "null" not in got


# plugged-in algorithms ------------------------------------------------------------

@pytest.fixture
def nearest():
    """A third algorithm, added without touching the library."""
    name = f"nearest_{uuid.uuid4().hex[:6]}"

    def fit(x, y):
        if len(y) < 3:
            raise ValueError("too few rows")
        return pickle.dumps((x, y))

    def predict(model, x):
        a, y = pickle.loads(model)
        return np.array([y[np.abs(a - r).sum(1).argmin()] for r in x])
    AL.register(name, fit, predict)
    yield name
    del AL.ALGORITHMS[name]


def test_third_algorithm_is_trained_stored_and_scored(spark, tmp_path, nearest):
    data = [(f"k{i % 3}", i, float(i % 40), float((i % 40) * 2 + 1)) for i in range(240)] + [("tiny", 900, 1.0, 1.0), (None, 901, 3.0, 5.0), ("k0", 902, 0.0, None)]
    df = spark.createDataFrame(data, "k string, id long, x double, y double").repartition(3)
    models = AL.fit_registered(df, ["k"], ["x"], "y", ["lr", nearest])
    status = {(r.k, r.algoname): (r.status, r.n_train, r.reason) for r in models.collect()}
    assert status["tiny", nearest] == ("Failed", 1, "ValueError: too few rows") and status["tiny", "lr"][0] == "Succeeded"
    assert status["k0", nearest] == ("Succeeded", 80, None) and len(status) == 10
    path = str(tmp_path / "models")
    models.write.parquet(path)
    out = AL.predict_registered(df, spark.read.parquet(path), ["k"], ["x"], ["id"], chunk_rows=7)
    got = {(r.id, r.algoname): r.pred for r in out.collect()}
    assert len(got) == out.count() == 2 * 241 + 2
    assert all(got[i, a] == pytest.approx(x * 2 + 1) for k, i, x, y in data if i < 240 for a in ("lr", nearest))
    assert (900, nearest) not in got and got[901, "lr"] == pytest.approx(5.0)
    with pytest.raises(ValueError, match="not registered"):
        AL.fit_registered(df, ["k"], ["x"], "y", ["unknown"])
    assert AL.fit_registered(df.limit(0), ["k"], ["x"], "y", ["lr"]).count() == 0
    assert AL.predict_registered(df.limit(0), models, ["k"], ["x"], ["id"]).count() == 0


def test_hot_key_is_sampled_and_scored_in_chunks(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, concat('k', id % 50), 'hot') k", "id", "cast(id % 100 as double) x", "cast(id % 100 as double) * 3 y")
    models = AL.fit_registered(df, ["k"], ["x"], "y", ["lr"], max_rows=500)
    hot = models.where("k = 'hot'").first()
    assert hot.n_rows == 20_000 and hot.n_train == 500
    again = AL.fit_registered(df.repartition(9), ["k"], ["x"], "y", ["lr"], max_rows=500).where("k = 'hot'").first()
    assert bytes(hot.model) == bytes(again.model)
    out = AL.predict_registered(df, models, ["k"], ["x"], ["id"], chunk_rows=1000)
    assert out.count() == 30_000 and out.join(df, "id").agg(F.max(F.abs(F.col("pred") - F.col("y")))).first()[0] < 1e-8


# text encoders, word vectors --------------------------------------------------------

def test_encoder_is_loaded_once_a_worker(spark, tmp_path):
    from tessera.operators import encoders as EN
    log = str(tmp_path / "loads")

    def factory():
        with open(log, "a") as f:
            f.write("x\n")

        def of(texts):
            with open(log + ".n", "a") as f:
                f.write(f"{len(texts)}\n")
            return np.array([[len(t), t.count("a")] for t in texts])
        return of
    EN.register_encoder("lengths", factory)
    try:
        data = [(i, "aab" if i % 2 else f"t{i % 10}") for i in range(2000)] + [(9000, None), (9001, "")]
        out = EN.encode(spark.createDataFrame(data, "id long, t string").repartition(12), "t", "lengths")
        got = {r.id: r.vector for r in out.collect()}
    finally:
        del EN.ENCODERS["lengths"]
    assert got[1] == [3.0, 2.0] and got[9000] is None and got[9001] == [0.0, 0.0] and len(got) == 2002
    workers = len(open(log).readlines())
    assert workers < 12 or workers <= spark.sparkContext.defaultParallelism
    assert sum(map(int, open(log + ".n").readlines())) <= 8 * workers  # seven different texts


def test_hashed_words():
    from tessera.operators.encoders import hashed_words
    import hashlib
    v = hashed_words(32)(["Two two three!", "", "éé"])
    k2, k3 = (int(hashlib.md5(w).hexdigest()[:8], 16) % 32 for w in (b"two", b"three"))
    assert v[0, k2] == pytest.approx(2 / 5 ** 0.5) and v[0, k3] == pytest.approx(1 / 5 ** 0.5) and not v[1:].any()


def test_vector_matches_brute_force(spark):
    from tessera.operators import text as TX
    rng = np.random.default_rng(6)
    a = [(f"a{i}", rng.normal(size=4).tolist()) for i in range(90)] + [("none", None), ("zero", [0.0] * 4), ("nan", [float("nan")] * 4), ("short", [1.0, 2.0]), ("hole", [1.0, None, 1.0, 1.0])]
    b = [(f"b{i}", rng.normal(size=4).tolist()) for i in range(40)] + [("short", [2.0, 4.0])]
    left, right = (spark.createDataFrame(x, "w string, v array<double>") for x in (a, b))
    want = {}
    for w, x in a:
        for u, y in b:
            if x and len(x) == len(y) and None not in x and np.isfinite(x).all() and any(x):
                c = float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y))
                if c >= 0.35:
                    want[w, u] = pytest.approx(c)
    got = {(r.l, r.r): r.sim for r in TX.vector_matches(left, right, 0.35).collect()}
    assert got == want and ("short", "short") in got and len(got) > 200


def test_phrase_scores_in_small_blocks(spark, monkeypatch):
    from tessera.operators import text as TX
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdef"), int(rng.integers(3, 8)))) for _ in range(60)]
    toks = [(int(rng.integers(30)), words[int(rng.integers(60))]) for _ in range(900)] + [(99, "zzzz"), (98, "ab")]
    phrases = [(c, f"p{p}", words[int(rng.integers(60))]) for c in range(3) for p in range(5) for _ in range(int(rng.integers(1, 4)))]
    t = spark.createDataFrame(toks, "d long, w string")
    p = spark.createDataFrame(phrases, "c int, p string, w string")
    n = spark.createDataFrame([(c, 7) for c in range(3)], "c int, n long")

    def sim(a, b):
        x, y = ({w[i:i + 2] for i in range(len(w) - 1)} for w in (a, b))
        return len(x & y) / len(x | y)
    want = {}
    for d in {d for d, _ in toks}:
        own = {w for k, w in toks if k == d and len(w) > 2}
        for c in range(3):
            scores = []
            for ph in {x for k, x, _ in phrases if k == c}:
                pw = [w for k, x, w in phrases if k == c and x == ph]
                best = [max([s for s in (sim(w, o) for o in own) if s >= 0.35], default=0.0) for w in pw]
                scores.append(sum(best) / len(pw))
            if any(scores):
                want[d, c] = (pytest.approx(max(scores)), pytest.approx(sum(scores) / 7))
    for size in (4, 10_000):
        for knob in ("TEXT_BLOCK", "PHRASE_BLOCK", "TOKENS_AT_ONCE"):
            monkeypatch.setattr(TX, knob, size)
        out = TX.phrase_scores(t, "d", "w", p, "c", "p", "w", n, stop_words=[])
        assert {(r.d, r.c): (r.max_score, r.mean_score) for r in out.collect()} == want
