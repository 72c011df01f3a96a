"""Operator edge cases on hand-built frames (FIXTURES.md part C)."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import models as MO
from tessera.operators import projections as P
from tessera.operators import quality as Q
from tessera.operators import sets as U
from tessera.operators import text as TX
from tessera.operators import windows as W


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_causal_line(spark):
    claims = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    lines = spark.createDataFrame(
        [(1, 10, "L"), (2, 20, None), (3, 30, "X"), (3, 31, None), (4, 40, None), (4, 41, "A")],
        "lk int, ln int, flag string")
    out = J.pick_causal_line(claims, lines, ["k"], ["lk"], ["k"], ["lk"], "flag")
    assert rows(out, "k", "ln") == [(1, 10), (3, 30)]


def test_resolve_parent(spark):
    h = spark.createDataFrame([("A", "P", "a"), ("P", "Q", "parent"), ("B", "none", "b"),
                               ("C", "P", "c1"), ("C", "P", "c2")], "code string, parent string, name string")
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("Z",)], "v string")
    out = J.resolve_parent(df, "v", h, "code", "parent", "name", "vn")
    assert rows(out, "v", "vn") == [("A", "parent"), ("B", "B"), ("C", "parent"), ("Z", "Z")]


def test_map_lookup_last_wins(spark):
    lk = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("n", None, 1)], "k string, v string, o int")
    df = spark.createDataFrame([("a",), ("n",), ("m",)], "key string")
    out = J.map_lookup(df, "key", lk, "k", "v", "val", order="o", default="Not_Found")
    assert rows(out, "key", "val") == [("a", "y"), ("m", "Not_Found"), ("n", None)]


def test_or_join_no_duplicates(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1, 1), (1, 2), (3, 2)], "k1 int, k2 int")
    out = J.or_join(a, b, "k", ("k1", "k2"))
    assert rows(out, "k", "k1", "k2") == [(1, 1, 1), (1, 1, 2), (2, 1, 2), (2, 3, 2)]


def test_range_and_band_join(spark):
    cal = spark.createDataFrame([("JAN", dt.date(2020, 1, 1), dt.date(2020, 1, 31)),
                                 ("FEB", dt.date(2020, 2, 1), dt.date(2020, 2, 29))], "m string, lo date, hi date")
    f = spark.createDataFrame([(1, dt.date(2020, 1, 31)), (2, dt.date(2020, 2, 1)), (3, None)], "id int, d date")
    assert rows(J.range_join(f, cal, "d", "lo", "hi"), "id", "m") == [(1, "JAN"), (2, "FEB")]
    bands = spark.createDataFrame([("u", -1, -1), ("a", 0, 9), ("b", 10, 19)], "b string, lo int, hi int")
    g = spark.createDataFrame([(1, None), (2, 9.0), (3, 10.0)], "id int, x double")
    assert rows(J.band_join(g, bands, "x", "lo", "hi", width=10), "id", "b") == [(1, "u"), (2, "a"), (3, "b")]


def test_dedup_rules(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", dt.date(2020, 1, 1)), (3, "b", None),
                                (4, None, None), (5, None, dt.date(2020, 1, 1))], "id int, k string, ts date")
    assert [r[0] for r in W.dedup_prefer_updated(df, ["k"], "ts").orderBy("id").collect()] == [1, 2, 5]
    t = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, None), (5, None)], "id int, t string")
    assert [r[0] for r in W.dedup_keep_max(t, "t", "id").orderBy("id").collect()] == [3, 4, 5]


def test_ffill_bucketed_equals_plain(spark):
    data = [(i, i // 10, None if i % 3 else float(i)) for i in range(100)]
    df = spark.createDataFrame(data, "o int, day int, v double")
    plain = W.ffill(df, "v", "o", out="f")
    bucketed = W.ffill(df, "v", "o", bucket=F.col("day"), out="f")
    assert rows(plain, "o", "f") == rows(bucketed, "o", "f")


def test_global_index(spark):
    # large enough that range bounds come from a sample (the sampled bounds
    # differ per job; the numbering must not depend on them)
    n = 200_000
    df = spark.range(0, n, numPartitions=7).select((F.col("id") * 7919 % n).alias("k"))
    out = P.global_index(df, ["k"])
    assert out.filter(F.col("k") != F.col("_idx")).count() == 0
    assert out.count() == n


def test_redact_boundary(spark):
    df = spark.createDataFrame([(dt.date(2023, 2, 1), 0, "a"), (dt.date(2023, 2, 1), 1, "b"),
                                (dt.date(2023, 1, 1), 1, "c")], "d date, s int, t string")
    out = U.redact(df, "d", "s", ["t"], "2024-02-01")
    got = {(r["s"], r["d"]): r["t"] for r in out.collect()}
    assert got[(0, dt.date(2023, 2, 1))] is None     # 12 months, neutral
    assert got[(1, dt.date(2023, 2, 1))] == "b"      # 12 months, not neutral
    assert got[(1, dt.date(2023, 1, 1))] is None     # older than 12 months


def test_quality_counts_and_gate(spark):
    df = spark.createDataFrame([(1, None), (2, None), (2, "x")], "k int, c string")
    rules = [Q.is_complete("c"), Q.is_primary_key("k"), Q.distinct_count("k", 0, 5)]
    out = {r["rule"]: r for r in Q.evaluate(df, rules, {"source": "t"}).collect()}
    assert out['IsComplete "c"']["passcnt"] == 1 and out['IsComplete "c"']["failcnt"] == 2
    assert out['IsPrimaryKey "k"']["outcome"] == "Failed" and out['IsPrimaryKey "k"']["passcnt"] == 1
    assert out['DistinctValuesCount "k" between 0 and 5']["passcnt"] is None
    o = spark.createDataFrame(
        [("s1", Q.OVERALL_RULE, "Failed", dt.datetime(2024, 1, 1)),
         ("s1", Q.OVERALL_RULE, "Passed", dt.datetime(2024, 1, 2)),
         ("s2", Q.OVERALL_RULE, "Passed", dt.datetime(2024, 1, 1))],
        "source string, rule string, outcome string, audittimestamp timestamp")
    g = Q.gate(o).collect()[0]
    assert g["gate"] == "Passed" and g["failed_sources"] == 0


def test_traffic_light_boundaries(spark):
    m = spark.createDataFrame([("Intersection", 30.0), ("Intersection", 20.0), ("Intersection", 19.9)],
                              "metric_name string, metric_value double")
    got = [r["status"] for r in MO.traffic_light(m, MO.thresholds(spark)).orderBy(F.desc("metric_value")).collect()]
    assert got == ["Green", "Amber", "Red"]


def test_one_hot_fixed_categories(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    cats = MO.category_table(train, ["c"])
    score = spark.createDataFrame([("b",), ("z",)], "c string")
    out = MO.one_hot(score, ["c"], cats)
    assert out.columns == ["c_a", "c_b"]
    assert rows(out, "c_a", "c_b") == [(0, 0), (0, 1)]


def test_fit_linear_matches_numpy(spark):
    rng = np.random.default_rng(1)
    data = []
    for key in ("a", "b"):
        for _ in range(200):
            x1, x2 = rng.normal(), rng.integers(0, 2)
            y = 3 + 2 * x1 - x2 + rng.normal() * 0.01 + (5 if key == "b" else 0)
            data.append((key, float(x1), int(x2), float(y)))
    df = spark.createDataFrame(data, "k string, x1 double, x2 int, y double")
    fit = {r["k"]: r for r in MO.fit_linear(df, ["k"], ["x1", "x2"], "y").collect()}
    for key in ("a", "b"):
        sub = np.array([(1.0, d[1], d[2], d[3]) for d in data if d[0] == key])
        coef = np.linalg.lstsq(sub[:, :3], sub[:, 3], rcond=None)[0]
        assert abs(fit[key]["intercept"] - coef[0]) < 1e-6
        assert np.allclose(fit[key]["coef"], coef[1:], atol=1e-6)


def test_correct_words_brute_force(spark):
    vocab = ["brake", "braking", "break", "noise", "noisy", "nose", "clutch", "clutter", "bx", "by"]
    kws = ["brake", "noise", "clutch"]
    words = ["brak", "noice", "clutsh", "bxy", "zzz", "brake"]

    def jd(a, b):
        sa = {a[i:i + 2] for i in range(len(a) - 1)}
        sb = {b[i:i + 2] for i in range(len(b) - 1)}
        return 1 - len(sa & sb) / len(sa | sb)

    def brute(w):
        if w in vocab:
            return w
        cand = sorted([(jd(w, v), v) for v in vocab if v[0] == w[0]])[:10]
        for _, v in cand:
            if v in kws:
                return v
        return w
    wdf = spark.createDataFrame([(w,) for w in words], "w string")
    vdf = spark.createDataFrame([(v, v) for v in vocab], "v string, vp string")
    kdf = spark.createDataFrame([(k,) for k in kws], "k string")
    got = dict(TX.correct_words(wdf, "w", vdf, "v", "vp", kdf, "k").collect())
    assert got == {w: brute(w) for w in words}


def test_classify_text_tie_and_no_overlap(spark):
    docs = spark.createDataFrame([(1, "brake noise"), (2, "nothing here"), (3, "")], "id int, text string")
    d = spark.createDataFrame([(10, ["brake"]), (11, ["noise"])], "label int, kw array<string>")
    got = {r["id"]: (r["label"], r["score"]) for r in TX.classify_text(docs, "id", "text", d, "label", "kw").collect()}
    assert got[1][0] == 10 and got[2] == (10, 0.0) and got[3] == (10, 0.0)


def test_jaccard_prefix_filter_is_exact(spark):
    import random
    rnd = random.Random(7)
    letters = "abcdefgh"
    left = [("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))),) for _ in range(300)]
    right = [("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))),) for _ in range(80)]
    a = spark.createDataFrame(left, "w string")
    b = spark.createDataFrame(right, "v string")
    full = TX.jaccard_pairs(a, "w", b, "v").filter(F.col("sim") >= 0.35)
    pref = TX.jaccard_pairs(a, "w", b, "v", threshold=0.35)
    assert rows(full, "w", "v", "sim") == rows(pref, "w", "v", "sim")


def test_jaccard_matches_equals_join(spark):
    import random
    rnd = random.Random(11)
    letters = "abcdefghij"
    left = [("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))),) for _ in range(400)]
    right = [("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))),) for _ in range(90)]
    a = spark.createDataFrame(left, "w string")
    b = spark.createDataFrame(right, "v string")
    full = TX.jaccard_pairs(a, "w", b, "v").filter(F.col("sim") >= 0.35)
    fast = TX.jaccard_matches(a, "w", b, "v", 0.35)
    assert rows(full, "w", "v", "sim") == rows(fast, "w", "v", "sim")


def test_correct_words_postings_equals_join(spark):
    import random
    rnd = random.Random(3)
    letters = "abcdefg"
    vocab = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(300)})
    kws = vocab[::4]
    words = list({"".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(400)}) + vocab[:20]
    wdf = spark.createDataFrame([(w,) for w in words], "w string")
    vdf = spark.createDataFrame([(v, v) for v in vocab], "v string, vp string")
    kdf = spark.createDataFrame([(x,) for x in kws], "k string")
    a = dict(TX.correct_words(wdf, "w", vdf, "v", "vp", kdf, "k").collect())
    b = dict(TX.correct_words_postings(wdf, "w", vdf, "v", "vp", kdf, "k").collect())
    assert a == b


def test_one_pass_of_outcomes_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, 50.0), (2, "c", None), (4, "d", 7.0)], "k int, t string, v double")
    rules = [Q.is_primary_key("k"), Q.is_complete("t"), Q.values_between("v", 0, 10), Q.custom_sql("select count(*) from primary where v > 6", 0, 5)]
    run = {"corelation_id": "r", "source": "s", "year": "2024", "month": "02", "day": "01"}
    one = Q.evaluate_rows(df, rules, str(tmp_path / "rows"), run)
    assert sorted(map(str, one.collect())) == sorted(map(str, Q.evaluate(df, rules, run).collect()))
    want = Q.row_outcomes(df, rules, run)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "rows")).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert Q.evaluate_rows(df.limit(0), rules, str(tmp_path / "none"), run).count() == 4
