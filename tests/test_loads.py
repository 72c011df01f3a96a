"""Reading and writing that must hold when something goes wrong: failed and
repeated loads, aging rows, hot keys, odd files."""

import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import sinks as K
from tessera import sources as SR
from tessera.operators import quality as Q
from tessera.operators import sets as U
from tessera.operators import windows as W
from tessera.streaming.files import run_available_now


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def name():
    return f"t_{uuid.uuid4().hex[:12]}"


# readers ----------------------------------------------------------------------

def test_query_names_stay_inside_the_sql(spark):
    part = spark.createDataFrame([(1, "p"), (2, "from part here")], "k int, part string")
    one = SR.read_query(spark, "SELECT k, part, 'from part here' AS note FROM part WHERE part = 'from part here';", {"part": part})
    assert rows(one) == [(2, "from part here", "from part here")]
    two = SR.read_query(spark, "WITH x AS (SELECT max(k) AS part FROM part) SELECT x.part, p.k FROM x, part p -- end", {"part": part})
    assert rows(two) == [(2, 1), (2, 2)]
    assert not any(t.name.startswith("t_") and t.isTemporary for t in spark.catalog.listTables())


def test_custom_sql_rule_with_a_column_named_primary(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "primary int, t string")
    rule = Q.custom_sql("select count(primary) from primary where t <> 'from primary'", 1, 3)
    run = {"corelation_id": "r", "source": "s", "year": "2024", "month": "02", "day": "01"}
    assert Q.evaluate(df, [rule], run).first()["outcome"] == "Passed"


@pytest.mark.parametrize("sep", [",", "$"])
def test_one_column_csv_keeps_nulls(spark, tmp_path, sep):
    data = [(None,), ("",), ("a",), (None,), (" x\ny",), ('"q"',)]
    K.write_csv(spark.createDataFrame(data, "t string"), str(tmp_path / "c"), sep=sep)
    assert rows(SR.read_csv(spark, str(tmp_path / "c"), schema="t string", sep=sep)) == sorted(data, key=str)


def test_csv_files_are_bounded(spark, tmp_path):
    K.write_csv(spark.range(1000).coalesce(1), str(tmp_path / "c"), max_records=100)
    assert len(glob.glob(str(tmp_path / "c" / "*.csv"))) == 10
    assert SR.read_csv(spark, str(tmp_path / "c"), schema="id long").count() == 1000


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_many_files_are_one_scan_per_column_order(spark, tmp_path):
    paths = []
    for i in range(6):
        cols = ["b", "a"] if i == 3 else ["a", "b", "c"]
        df = spark.createDataFrame([(f"a{i}", f"b{i}", i)], "a string, b string, c int").select(*cols)
        paths.append(str(tmp_path / str(i)))
        df.write.option("header", True).csv(paths[-1])
    got = SR.read_many(spark, paths, ["a", "b"], header=True)
    assert rows(got) == [(f"a{i}", f"b{i}") for i in range(6)] and scans(got) == 2
    spark.range(3).write.parquet(str(tmp_path / "p1"))
    spark.range(4).write.parquet(str(tmp_path / "p2"))
    both = SR.read_many(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")], ["id"], fmt="parquet")
    assert both.count() == 7 and scans(both) == 1


# writers ----------------------------------------------------------------------

def test_hot_key_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("pk"),
                                     F.lit("m").alias("mapping"), F.col("id"), F.md5(F.col("id").cast("string")).alias("x"))
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        K.write_keyed(df, str(tmp_path / "k"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot = glob.glob(str(tmp_path / "k" / "pk=hot" / "mapping=m" / "*.parquet"))
    assert len({os.path.basename(f).split("-")[1] for f in hot}) > 1  # part numbers: tasks
    assert spark.read.parquet(str(tmp_path / "k")).count() == 200_000
    K.write_keyed(df.where("pk = 'hot'").limit(5), str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 100_005


def test_catalogued_table_keeps_its_place(spark, tmp_path):
    t, df = name(), spark.createDataFrame([(1, "2024", "02", "01")], "x int, year string, month string, day string")
    K.write_catalogued(df, str(tmp_path / "a"), t)
    K.write_catalogued(df, str(tmp_path / "a") + "/", t)
    with pytest.raises(ValueError, match="lies at"):
        K.write_catalogued(df, str(tmp_path / "b"), t)
    assert spark.table(t).count() == 1 and not os.path.exists(tmp_path / "b")


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])


@pytest.mark.parametrize("catalogued", [True, False])
def test_failed_refresh_keeps_the_old_rows(spark, tmp_path, catalogued):
    target, t = str(tmp_path / "full"), name() if catalogued else None
    now = lambda: rows(spark.table(t) if t else spark.read.parquet(target))
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, s string")
    K.load_full(old, SCHEMA, target, table=t)
    half = spark.range(0, 100_000, numPartitions=4).select("id", F.when(F.col("id") > 99_990, F.raise_error(F.lit("broken row"))).otherwise("x").alias("s")) \
        .withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="broken row"):
        K.load_full(half, SCHEMA, target, table=t)
    assert now() == [(1, "a"), (2, "b")]

    def refuse(loaded):
        raise ValueError(f"{loaded.count()} rows are too few")
    with pytest.raises(ValueError, match="1 rows are too few"):
        K.load_full(old.limit(1), SCHEMA, target, table=t, check=refuse)
    assert now() == [(1, "a"), (2, "b")]
    # the target may be read by the load itself
    K.load_full((spark.table(t) if t else spark.read.parquet(target)).withColumn("s", F.upper("s")), SCHEMA, target, table=t)
    assert now() == [(1, "A"), (2, "B")]
    K.load_full(old.limit(0), SCHEMA, target, table=t)
    assert now() == []
    left = os.listdir(target if catalogued else tmp_path)
    assert len([x for x in left if "version=" in x]) == (2 if catalogued else 0) and not [x for x in left if "loading" in x or "replaced" in x]


def test_repeated_append_replaces_its_own_rows(spark, tmp_path):
    df, target, bad = spark.createDataFrame([(1, "a"), (2, "abcdef")], "k long, s string"), str(tmp_path / "t"), str(tmp_path / "r")
    for _ in range(2):
        K.load_append(df, SCHEMA, target, {"s": 3}, too_long="reject", rejects=bad, load_id="x")
    K.load_append(df.where("k = 1"), SCHEMA, target, {"s": 3}, load_id="y")
    assert rows(spark.read.parquet(target), "k", "s", "load_id") == [(1, "a", "x"), (1, "a", "y")]
    assert rows(spark.read.parquet(bad), "k", "s") == [(2, "abcdef")]
    K.load_append(df.limit(0), SCHEMA, target, {"s": 3}, load_id="x")
    assert rows(spark.read.parquet(target), "k", "load_id") == [(1, "y")]


def test_staged_file_size(spark, tmp_path):
    K.stage_single(spark.range(0, 1000, numPartitions=7), str(tmp_path / "s"), {"id": "string"})
    assert len(glob.glob(str(tmp_path / "s" / "*.parquet"))) == 1
    plan = spark.range(0, 1000, numPartitions=7).hint("rebalance")._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" in plan


# maintained loads ------------------------------------------------------------------

POSTS = "id string, message string, created date, sentiment int, month string"


def posts(spark, data):
    return spark.createDataFrame([(i, m, d, s, None if d is None else f"{d:%Y-%m}") for i, m, d, s in data], POSTS)


def months_between(a, b):
    last = lambda d: (d + dt.timedelta(days=1)).month != d.month
    n = (a.year - b.year) * 12 + a.month - b.month
    return n if a.day == b.day or last(a) and last(b) else n + (a.day - b.day) / 31


def settle_by_hand(state, batch, day):
    every = state + batch
    top = {}
    for i, m, _, _ in every:
        if m is not None:
            top[m] = max(top.get(m, ""), i)
    out = []
    for i, m, d, s in every:
        if m is None or top[m] == i:
            age = None if d is None else months_between(day, d)
            out.append((i, None if age is not None and (age > 12 or s == 0) else m, d, s))
    return out


def load(batch, table, base, load_id, day):
    return K.merge_load(batch, table, base, load_id, lambda x: U.redact(
        W.dedup_keep_max(x, "message", "id"), "created", "sentiment", ["message"], str(day)), part="month", key="message",
        as_of=day, changes_on=F.when(F.col("message").isNotNull(), F.add_months("created", 12)))


def state_of(spark, table):
    return rows(spark.table(table), "id", "message", "created", "sentiment")


def test_loads_day_by_day(spark, tmp_path):
    import random
    rng, table, base, state = random.Random(5), name(), str(tmp_path / "m"), []
    day = dt.date(2023, 1, 31)
    for k in range(5):
        batch = []
        for j in range(25):
            created = day - dt.timedelta(days=rng.choice([0, 3, 40, 200, 330, 364, 365, 366, 500]))
            batch.append((f"{k}-{j:03}" if rng.random() < 0.8 else f"0-x{k}{j}", rng.choice(["a", "b", None, f"m{rng.randrange(40)}"]),
                          None if j == 7 else created, rng.choice([-1, 0, 1, None])))
        load(posts(spark, batch), table, base, f"load{k}", day)
        state = settle_by_hand(state, batch, day)
        assert state_of(spark, table) == sorted(state, key=str)
        day += dt.timedelta(days=rng.choice([29, 61, 100]))
    # age alone, without new rows
    day += dt.timedelta(days=200)
    load(posts(spark, []), table, base, "quiet", day)
    state = settle_by_hand(state, [], day)
    assert state_of(spark, table) == sorted(state, key=str)
    dropped = K.drop_unreferenced(spark, table, base)
    assert dropped >= 2 and state_of(spark, table) == sorted(state, key=str) and K.drop_unreferenced(spark, table, base) == 0


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    table, base, day = name(), str(tmp_path / "m"), dt.date(2024, 1, 10)
    old = [(f"a{m}", f"text {m}", dt.date(2023, m, 15), 1) for m in range(3, 13)]
    load(posts(spark, old), table, base, "one", day)
    touched = load(posts(spark, [("b1", "text 5", dt.date(2024, 1, 9), 1)]), table, base, "two", day)
    assert touched == ["2023-05", "2024-01"]  # the older copy's month and its own
    assert ("a5", "text 5", dt.date(2023, 5, 15), 1) not in state_of(spark, table)
    assert "2023-05" not in str(spark.sql(f"SHOW PARTITIONS {table}").collect())
    assert load(posts(spark, []), table, base, "three", dt.date(2024, 3, 16)) == ["2023-03"]


def test_load_broken_off_is_repeated(spark, tmp_path, monkeypatch):
    from tessera.sinks import maintained as MT
    table, base, day = name(), str(tmp_path / "m"), dt.date(2024, 1, 10)
    one = [("a1", "x", dt.date(2023, 12, 1), 1), ("a2", None, dt.date(2023, 11, 1), 1), ("a3", "y", dt.date(2023, 10, 1), 1)]
    two = [("b1", "x", dt.date(2024, 1, 1), 1), ("b2", None, dt.date(2023, 11, 3), 1), ("b3", "z", dt.date(2024, 1, 2), 1)]
    load(posts(spark, one), table, base, "one", day)
    want = sorted(settle_by_hand(settle_by_hand([], one, day), two, day), key=str)
    move = MT._move
    for stop in (0, 1):  # before the rows move, and between rows and index
        calls = []

        def broken(*a):
            calls.append(a)
            if len(calls) > stop:
                raise RuntimeError("lost")
            move(*a)
        monkeypatch.setattr(MT, "_move", broken)
        with pytest.raises(RuntimeError, match="lost"):
            load(posts(spark, two), table, base, "two", day)
        monkeypatch.setattr(MT, "_move", move)
    for _ in range(2):
        load(posts(spark, two), table, base, "two", day)
        assert state_of(spark, table) == want
    with pytest.raises(ValueError, match="plain partition"):
        load(posts(spark, [("q", "q", day, 1)]).withColumn("month", F.lit("a/b")), table, base, "odd", day)


# streams, windows --------------------------------------------------------------------

def test_late_rows_of_many_batches_are_all_counted(spark, tmp_path):
    src, sink, ck = (str(tmp_path / x) for x in ("src", "sink", "ck"))
    base = dt.datetime(2024, 1, 20)

    def put(i, ts):
        spark.createDataFrame([(i, ts, 1, "a", 1.0, "{}")], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
            .coalesce(1).write.mode("append").parquet(src)
    put(0, base)
    assert run_available_now(spark, src, sink, ck, max_files=1, delay="1 hour") == 0
    for i in range(1, 7):
        put(i, base - dt.timedelta(days=i))
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")  # a query remembers its last report only
    try:
        assert run_available_now(spark, src, sink, ck, max_files=1, delay="1 hour") >= 6
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)


def test_ffill_without_a_bucket(spark):
    import random
    rng = random.Random(1)
    data = [(k, i, rng.choice([None, None, None, float(i)])) for k in ("a", "b", None) for i in range(400)] + [("c", 1, None), ("c", 2, None)]
    df = spark.createDataFrame(data, "k string, o int, v double").repartition(5)
    want, last = {}, {}
    for k, i, v in data:
        last[k] = v if v is not None else last.get(k)
        want[k, i] = last[k]
    got = {(r.k, r.o): r.f for r in W.ffill(df, "v", "o", part=["k"], out="f").collect()}
    assert got == want
    one = W.ffill(df.where("k = 'a'"), "v", "o")
    assert {r.o: r.v for r in one.collect()} == {i: want["a", i] for i in range(400)}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Subquery")[0]
    assert W.ffill(df.limit(0), "v", "o").count() == 0


def test_changed_files_replace_their_rows(spark, tmp_path):
    src, table, target = tmp_path / "in" / "deep", name(), str(tmp_path / "out")
    os.makedirs(src)

    def put(file, text, age):
        (src / file).write_text(text)
        os.utime(src / file, (1_700_000_000 + age, 1_700_000_000 + age))

    def run(**more):
        return SR.ingest_changed(spark, str(tmp_path / "in"), target, table, "k int, s string", glob="*.csv", header=True, **more)

    def now():
        return rows(SR.read_curated(spark, table), "k", "s")
    assert run() == 0
    put("a.csv", "k,s\n1,x\n2,y\n", 0)
    put("b.csv", "k,s\n3,z\n", 1)
    put("c.txt", "k,s\n9,no\n", 2)
    assert run() == 2 and now() == [(1, "x"), (2, "y"), (3, "z")] and run() == 0
    put("a.csv", "k,s\n1,X\n", 50)  # changed
    put("d.csv", "k,s\n3,z\n", -500)  # new, but older than all, with equal rows
    assert run(max_files=1) == 2 and now() == [(1, "X"), (3, "z"), (3, "z")] and run() == 0
    # a batch broken off before the catalog knew it: files lie there, the next run takes its number
    spark.range(3).selectExpr("7 k", "'left' s", "'f' source_file", "now() modified").write.parquet(f"{target}/batch_id=3")
    put("e.csv", "k,s\n5,e\n", 60)
    assert run() == 1 and now() == [(1, "X"), (3, "z"), (3, "z"), (5, "e")]
    assert rows(SR.read_curated(spark, table, history=True), "k", "s").count((2, "y")) == 1
    os.remove(src / "b.csv")
    assert (3, "z") in rows(SR.read_curated(spark, table, present_in=str(tmp_path / "in")), "k", "s")
    assert len(rows(SR.read_curated(spark, table, present_in=str(tmp_path / "in")), "k", "s")) == 3
    put("empty.csv", "k,s\n", 70)
    assert run() == 0
