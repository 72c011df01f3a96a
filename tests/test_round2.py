"""Hand-worked cases of rules that a twin written by the same hand could share a misreading of."""

import pytest
from pyspark.sql import functions as F

from tessera import sinks as K
from tessera import sources as SR
from tessera.functions import dates as D
from tessera.functions import strings as S
from tessera.functions import values as V
from tessera.operators import joins as J
from tessera.operators import models as MO
from tessera.operators import text as TX
from tessera.operators import windows as W


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_ffill_null_part(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (None, 12, None), ("a", 3, None), ("a", 15, 2.0)], "p string, t int, v double")
    got = rows(W.ffill(df, "v", "t", part=["p"], bucket=F.floor(F.col("t") / 10)), "p", "t", "v")
    assert got == sorted([(None, 1, 5.0), (None, 12, 5.0), ("a", 3, None), ("a", 15, 2.0)], key=str)


def test_keep_last_null_order(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert rows(W.keep_last(df, ["k"], "o"), "k", "v") == [("a", "x"), ("b", "z")]


def test_sentiment_forms(spark):
    df = spark.createDataFrame([(x,) for x in ("-1.0", "2.0", "2", "1.5", "3", "x", None)], "s string")
    assert [r[0] for r in df.select(V.norm_sentiment("s")).collect()] == [-1, 2, 2, 0, 0, 0, 0]


def test_blend_argmax_over_all_classes(spark):
    s1 = spark.createDataFrame([("d", 3, 0.9), ("e", 1, 0.5), ("f", 0, -0.2)], "k string, c int, s double")
    s2 = s1.filter("false")
    classes = spark.createDataFrame([(i, i) for i in range(4)], "c int, p int")
    mask = spark.createDataFrame([("d", 0), ("d", 1)], "k string, c int")
    out = TX.blend_predict(s1, s2, "k", "c", "s", "s", 1.0, 1.0, classes, "p", mask)
    assert rows(out, "k", "label", "score") == [("d", 0, 0.0), ("e", 1, 0.5), ("f", 1, 0.0)]


def test_scalar_lookup_raises_for_used_keys_only(spark):
    lk = spark.createDataFrame([(1, "a", "p"), (2, "b", "q"), (2, "c", "q")], "k int, v string, w string")
    df = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    got = rows(J.scalar_lookup(df, lk, {"x": "k"}, ["v", "w"], ["o1", "o2"], default="-"), "x", "o1", "o2")
    assert got == sorted([(1, "a", "p"), (3, "-", "-"), (None, "-", "-")], key=str)
    with pytest.raises(Exception, match="more than one row"):
        J.scalar_lookup(df.unionByName(spark.createDataFrame([(2,)], "x int")), lk, {"x": "k"}, "v", "o").collect()


def test_traffic_light_two_use_cases(spark):
    t = spark.createDataFrame([("u1", "m", 30.0, 20.0), ("u2", "m", 50.0, 40.0)], "usecase string, metric_name string, base_threshold double, critical_threshold double")
    m = spark.createDataFrame([("m", 35.0), ("other", 1.0)], "metric_name string, metric_value double")
    assert rows(MO.traffic_light(m, t), "usecase", "status") == [("u1", "Green"), ("u2", "Red")]


def test_csv_keeps_line_breaks_quotes_and_empty_text(spark, tmp_path):
    data = [(1, 'two\nlines, "quoted"', ""), (2, None, " x "), (None, "a\\b", "q")]
    df = spark.createDataFrame(data, "i int, t string, u string")
    K.write_csv(df, str(tmp_path / "c"))
    assert rows(SR.read_csv(spark, str(tmp_path / "c"), schema="i int, t string, u string"), "i", "t", "u") == sorted(data, key=str)


def test_extract_term_of_any_length(spark):
    docs = spark.createDataFrame([(1, "the front brake pad disc set squeaks"), (2, "pad")], "d int, t string")
    terms = spark.createDataFrame([("front brake pad disc set", 1), ("brake", 0), ("pad", 2)], "term string, pos int")
    assert rows(TX.extract_term(docs, "d", F.split("t", " "), terms, "term", "pos"), "d", "term") == [(1, "front brake pad disc set"), (2, "pad")]


def test_load_append_never_cuts_silently(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    df = spark.createDataFrame([("abcdef",), ("ab",), (None,)], "s string")
    schema = StructType([StructField("s", StringType())])
    with pytest.raises(Exception, match="longer than 3"):
        K.load_append(df, schema, str(tmp_path / "a"), {"s": 3})
    K.load_append(df, schema, str(tmp_path / "b"), {"s": 3}, too_long="reject", rejects=str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "b")), "s") == [("ab",), (None,)]
    assert rows(spark.read.parquet(str(tmp_path / "r")), "s") == [("abcdef",)]
    K.load_append(df, schema, str(tmp_path / "c"), {"s": 3}, too_long="cut")
    assert rows(spark.read.parquet(str(tmp_path / "c")), "s") == [("ab",), ("abc",), (None,)]


def test_open_band_is_clamped(spark):
    facts = spark.createDataFrame([(5,), (25,), (None,), (99,)], "x int")
    bands = spark.createDataFrame([("all", 0, 9_999_999), ("low", 0, 9), ("high", 20, 30)], "b string, lo int, hi int")
    out = J.band_join(facts, bands, "x", "lo", "hi", width=10)
    assert rows(out, "x", "b") == sorted([(5, "all"), (5, "low"), (25, "all"), (25, "high"), (99, "all")], key=str)
    exploded = [n for n in J.range_join(facts.filter("x is not null"), bands, "x", "lo", "hi", "numeric", 10)._jdf.queryExecution()
                .optimizedPlan().toString().split("\n") if "Generate" in n]
    assert exploded


def test_split_keywords_comma(spark):
    df = spark.createDataFrame([("Oil leak, noise,  Rattle",), ("a/ b c",)], "t string")
    assert [r[0] for r in df.select(S.split_keywords("t", ",")).collect()] == [["oil", "leak", "noise", "rattle"], ["a/", "b", "c"]]
    assert df.select(S.split_keywords("t")).collect()[1][0] == ["a", "b", "c"]


def test_trim_escaped_equals_rule(spark):
    texts = ["plain text here", "trailing line\n", "é" * 20, "a é b ü c", "日本 語 x", "😀 😀 a", "tab\tand\\slash", "", None, "x" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 5, 12, 14, 20):
        assert [r[0] for r in df.select(S.trim_escaped("t", n)).collect()] == [S.trim_escaped_py(t, n) for t in texts]


def test_year_prefix_is_always_20(spark):
    assert spark.range(1).select(D.expand_year(F.lit("JAN-98"))).first()[0] == "JAN-2098"


def test_trees_per_key_and_many_keys(spark):
    df = spark.range(3000).selectExpr("concat('k', id) k", "explode(sequence(1, 6)) x").selectExpr("k", "cast(x as double) x", "cast(x > 3 as double) * 2 y")
    m = MO.fit_trees(df, ["k"], ["x"], "y", rounds=2, rate=1.0, bins=6)
    assert m.count() == 3000
    worst = MO.predict_trees(df, m, ["k"], ["x"]).agg(F.max(F.abs(F.col("pred") - F.col("y")))).first()[0]
    assert worst < 1e-9


def test_sparse_linear_many_categories(spark):
    df = spark.range(40_000).selectExpr("'k' k", "concat('c', id % 20000) cat", "cast(id % 7 as double) x", "cast(id as double) y")
    v = MO.sparse_one_hot(df, ["cat"], ["x"])
    assert v.selectExpr("explode(x)").select("col.i").distinct().count() == 20_001
    small = spark.createDataFrame([("a", c, float(n), 3.0 * n + (2.0 if c == "u" else 0.0)) for n in range(5) for c in "uv"], "k string, cat string, n double, y double")
    sv = MO.sparse_one_hot(small, ["cat"], ["n"], out="vec")
    p = MO.predict_sparse(sv, MO.fit_sparse(sv, ["k"], "vec", "y"), ["k"], "vec")
    assert p.agg(F.max(F.abs(F.col("pred") - F.col("y")))).first()[0] < 1e-9


def test_broadcast_bound_follows_the_plan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(10).write.parquet(p)
    assert J.fits_broadcast(spark.read.parquet(p), 4096)
    spark.range(50_000).write.mode("append").parquet(p)
    assert not J.fits_broadcast(spark.read.parquet(p), 4096)


def test_mapping_rules(spark):
    def check(train, infer, tc="default", ic="region"):
        m = spark.createDataFrame([(train, infer, tc, ic)], "training_algorithms array<string>, inference_algorithms array<string>, training_mapping_column string, inference_mapping_column string")
        return MO.check_mapping(m, [], []).first()["valid"]
    assert check(["a", "b"], ["a"]) and check(["a"], ["a"], "region") and not check(["a"], ["a", "b"]) and not check(["a"], ["a"], "x")


def test_run_table_is_catalogued(spark, tmp_path):
    rec = spark.createDataFrame([("u", 1, "2024", "02", "01", "j1")], "usecase_name string, total_jobs long, year string, month string, day string, stepjobid string")
    K.write_ndjson(rec, str(tmp_path / "runs"), partition_by=["year", "month", "day", "stepjobid"])
    spark.sql("DROP TABLE IF EXISTS run_records")
    got = SR.read_run_tables(spark, str(tmp_path / "runs"), table="run_records").select("usecase_name", "total_jobs", "month", "stepjobid").collect()
    assert [tuple(r) for r in got] == [("u", 1, "02", "j1")] and spark.catalog.tableExists("run_records")
    spark.sql("DROP TABLE run_records")
