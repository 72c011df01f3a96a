"""Whole work: what a query must not leave out, however large its input."""

from __future__ import annotations

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import algorithms as AL


def test_registered_algorithms_train_on_all_rows(spark, monkeypatch):
    """no key's models come from a sample of its rows, and those of a large key are the models of all of them."""
    assert AL.fit_registered.__defaults__ == (None,)
    monkeypatch.setattr(AL, "TASK_ROWS", 300, raising=False)
    rng = np.random.default_rng(4)
    y = rng.normal(size=6000) ** 3
    data = [(("hot", "odd", None, f"k{i % 40}")[min(3, i % 6)], float(i % 50) if i % 7 else None, 0.1, float(y[i])) for i in range(6000)]
    data += [("ties", float(i % 9), 0.1, float(i % 2)) for i in range(1000)] + [("flat", 3.0, 0.1, float(i % 5)) for i in range(999)]
    data += [("nan", 1.0, 0.1, float("nan") if i == 5 else 1.0) for i in range(400)] + [("hot", 1.0, 0.1, None)]
    df = spark.createDataFrame(data, "k string, x double, same double, y double").repartition(7)
    AL.register("spread", lambda x, y: pickle.dumps(float(y.max() - y.min())), lambda m, x: np.full(len(x), pickle.loads(m)))
    try:
        rows = AL.fit_registered(df, ["k"], ["x", "same"], "y", ["lr", "mean", "median", "spread"]).collect()
    finally:
        del AL.ALGORITHMS["spread"]
    got = {(r.k, r.algoname): r for r in rows}
    keys = {d[0] for d in data}
    assert len(rows) == len(got) == 4 * len(keys) and max(r.n_rows for r in rows) == 1000
    for k in keys:
        own = [d for d in data if d[0] == k and d[3] is not None]
        x = np.array([[np.nan if d[1] is None else d[1], d[2]] for d in own])
        label = np.array([d[3] for d in own])
        for a in ("lr", "mean", "median", "spread"):
            r = got[k, a]
            assert (r.n_rows, r.n_train, r.status, r.reason) == (len(own), len(own), "Succeeded", None)
            want = label.max() - label.min() if a == "spread" else pickle.loads(AL.ALGORITHMS[a][0](x, label))
            assert np.allclose(pickle.loads(bytes(r.model)), want, atol=1e-9, equal_nan=True), (k, a)


@pytest.mark.parametrize("n", [1000, 1001])
def test_large_median_is_exact_whatever_its_bounds(spark, monkeypatch, n):
    """the bounds about the middle only say how many values are ordered."""
    rows = spark.range(n).select((F.col("id") % 1).alias("_key"), F.when(F.col("id") % 3 > 0, F.sqrt("id")).otherwise(-F.col("id")).cast("double").alias("_y"))
    want = np.median([r["_y"] for r in rows.collect()])
    for bounds in ([0.499, 0.501], [0.0, 0.01], [0.9, 1.0], [0.5, 0.5]):
        real = F.percentile_approx
        monkeypatch.setattr(AL.F, "percentile_approx", lambda c, p, acc, b=bounds, f=real: f(c, b, acc))
        out = AL._large_median(rows, []).collect()
        monkeypatch.setattr(AL.F, "percentile_approx", real)
        assert len(out) == 1 and pickle.loads(bytes(out[0].model)) == want


def test_blend_makes_each_score_once(spark):
    """F1: the argmax reads the two score tables once; no score is made again for the classes that stand at 0."""
    from conftest import SMALL
    from tessera.plans import q_text as QT
    plan = QT.c07(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1, plan


def test_phrase_words_given_as_arrays(spark):
    """the different tokens of whole texts give what rows of tokens give, the rows of one text together."""
    from tessera.operators import text as TX
    from tessera.plans import q_text as QT
    docs = spark.createDataFrame([(1, "Brake, noise; brakes & the"), (1, "éngine ÉNGINE engin"), (2, "  "), (2, None), (3, ""), (4, "noises a_b x-ray"), (None, "brake")],
                                 "d long, t string")
    sets = TX.token_sets(docs, "d", "t").collect()
    assert sorted((r.d, tuple(sorted(r.tokens))) for r in sets if r.d) == [
        (1, ("brake", "brakes", "noise", "the")), (1, ("engin", "éngine")), (2, ()), (3, ()), (4, ("a", "b", "noises", "ray", "x"))]
    phrases = spark.createDataFrame([(c, p, w) for c, p, ws in [(0, "p", "brake noise"), (0, "q", "engine"), (1, "r", "the noise ray")] for w in ws.split()],
                                    "c int, p string, w string")
    n = spark.createDataFrame([(0, 2), (1, 1)], "c int, n long")
    rows = docs.select("d", F.explode(QT.alnum_tokens("t")).alias("w"))
    want, got = (sorted(map(tuple, TX.phrase_scores(t, "d", c, phrases, "c", "p", "w", n).filter("d IS NOT NULL").collect()))
                 for t, c in ((rows, "w"), (TX.token_sets(docs, "d", "t"), "tokens")))
    assert got == want and {r[0] for r in got} == {1, 4}


def test_words_met_by_bytes_in_any_lots(monkeypatch):
    """counts of shared bigrams are exact for words of many bigrams and in any lots."""
    from tessera.operators import blocks
    long = "".join(chr(200 + i) for i in range(600))
    a, b = ["brake", "brakes", "", "x", "aaaa", long, "noise", "é😀é😀"], ["brakes", long[:550], "aa", "noises", "", "😀é", "breaks"]
    want = blocks.jaccard(a, b)
    for marks, cells in ((1 << 26, 1 << 20), (8, 1 << 20), (1 << 26, 1)):
        monkeypatch.setattr(blocks, "MARKS", marks)
        monkeypatch.setattr(blocks, "CELLS", cells)
        i, j, sim = blocks.jaccard_above(a, b, 0.35)
        assert sorted(zip(i, j)) == list(zip(*np.nonzero(want >= 0.35))) and np.array_equal(sim, want[i, j])


def test_training_run_boosts_on_all_features(spark):
    """the training run's trees take every prepared feature and the operator's own number of rounds."""
    import inspect
    from tessera.operators import models as MO
    from tessera.plans import q_models as QM
    rng = np.random.default_rng(3)
    rows = [("k", "m", i, 1, float(q), int(c == 0), int(c == 1), int(c == 2), float(q) + (c == 1), i % 10 == 0)
            for i, (q, c) in enumerate(zip(rng.random(200).tolist(), rng.integers(0, 3, 200).tolist()))]
    f = spark.createDataFrame(rows, "pk string, mapping string, l_orderkey long, l_linenumber int, qty_scaled double, l_returnflag_A int, "
                                    "l_returnflag_N int, l_returnflag_R int, part_probability double, is_test boolean")
    linear, trees = QM.train_models(spark, f)
    steps = trees.first()["steps"]
    assert len(steps) == inspect.signature(MO.fit_trees).parameters["rounds"].default == 10
    assert {QM.tree_features(f)[s["feature"]] for s in steps} >= {"qty_scaled", "l_returnflag_N"}
    scored = QM.score_all(f.filter("is_test"), linear, trees, QM.tree_features(f))
    error = {r[0]: r[1] for r in scored.groupBy("algoname").agg(F.avg(F.pow(F.col("pred") - F.col("part_probability"), 2))).collect()}
    assert error["gbt"] < error["mean"] / 4, error


@pytest.mark.parametrize("block", [1, 2, 2048])
def test_cosine_of_few_labels_counts_words_in_batches(spark, monkeypatch, tmp_path, block):
    """a dictionary that every task holds gives the cosines of the joins, rows of one key put together, and no row a word."""
    from tessera.operators import text as TX
    docs = spark.createDataFrame([(i, f"a B c{i % 3}  d") for i in range(12)] + [(5, "a a q"), (5, None), (5, "z"), (20, "z"), (21, ""), (22, None), (None, "a b")],
                                 "k int, t string")
    words = spark.createDataFrame([("x", ["a", "b"]), ("y", ["c1", "q"]), ("y", ["c1"]), (None, ["d"]), ("n", [None, "a", ""]), ("e", []), ("f", None)],
                                  "label string, kw array<string>")
    words.write.parquet(str(tmp_path / "words"))
    words = spark.read.parquet(str(tmp_path / "words"))
    rows = lambda: sorted(map(tuple, TX.bow_cosine(docs, "k", "t", words, "label", "kw").collect()))
    monkeypatch.setattr(TX, "HELD_LABELS", 0, raising=False)
    want = rows()
    monkeypatch.setattr(TX, "HELD_LABELS", 4096)
    monkeypatch.setattr(TX, "TEXT_BLOCK", block)
    plan = TX.bow_cosine(docs, "k", "t", words, "label", "kw")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan, plan
    assert rows() == want and {r[0] for r in want} == {*range(12), 21}
