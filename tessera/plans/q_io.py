"""Registered source/sink queries (S*, K*, Z15): each writes the data with
a sink into a fresh folder under the session's shared checkpoint folder
(``spark.checkpoint.dir``) and returns the read-back DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import sinks as K
from tessera import sources as SR
from tessera.operators.joins import estimated_bytes
from tessera.plans import analogues as AN
from tessera.plans.registry import query
from tessera.session import checkpoint_dir, table

RUN_DATE = dt.date(2024, 2, 1)


def scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-io/{name}-{uuid.uuid4().hex[:12]}"


@query("S02_K01_run_partitions", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def s02_k01(spark, sf):
    """Write orders under the run-date partitions twice (a rerun replaces
    the day), read that day back by partition filter."""
    path = scratch(spark, "orders_run")
    o = table(spark, sf, "orders")
    K.write_run(o, path, RUN_DATE)
    K.write_run(o, path, RUN_DATE)
    K.write_run(o.limit(0), path, dt.date(2024, 1, 31))
    back = SR.read_run(spark, path, RUN_DATE)
    return back.select(*o.columns)


_CUST_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@query("S03_S04_K02_csv", sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey AS key2, c_name AS name2 FROM customer""")
def s03_s04_k02(spark, sf):
    """CSV with header and explicit schema; a ``$``-separated copy read back
    for two projected columns."""
    c = table(spark, sf, "customer")
    p1, p2 = scratch(spark, "cust_csv"), scratch(spark, "cust_dollar")
    K.write_csv(c, p1)
    K.write_csv(c, p2, sep="$")
    a = SR.read_csv(spark, p1, schema=_CUST_SCHEMA)
    b = SR.read_csv(spark, p2, schema=_CUST_SCHEMA, sep="$", columns=["c_custkey", "c_name"]) \
        .select(F.col("c_custkey").alias("key2"), F.col("c_name").alias("name2"))
    return a.join(b, a["c_custkey"] == b["key2"])


@query("S05_U01_read_many", sql="""
SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def s05(spark, sf):
    """One file set per market segment, appended back by column name."""
    c = table(spark, sf, "customer")
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    paths = []
    for i, s in enumerate(segs):
        p = scratch(spark, f"seg{i}")
        part = c.filter(F.col("c_mktsegment") == s)
        # column order differs per file: the append goes by name
        cols = part.columns if i % 2 == 0 else list(reversed(part.columns))
        K.write_csv(part.select(*cols), p)
        paths.append(p)
    rest = scratch(spark, "seg_rest")
    K.write_csv(c.filter(~F.col("c_mktsegment").isin(segs)), rest)
    paths.append(rest)
    df = SR.read_many(spark, paths, ["c_custkey", "c_name", "c_mktsegment"], fmt="csv", header=True,
                      inferSchema=True)
    return df.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")


_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("permalink", T.StringType())])


@query("S06_K11_json_lines", sql="""
SELECT event_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN 'p/' || CAST(event_id AS VARCHAR) END AS permalink
FROM events""")
def s06_k11(spark, sf):
    """JSON lines with a fixed column list; records without ``permalink``
    read back with a null."""
    e = table(spark, sf, "events")
    p = scratch(spark, "events_json")
    with_link = e.filter(F.col("event_id") % 3 == 0).select(
        "event_id", "event_type", "value",
        F.concat(F.lit("p/"), F.col("event_id").cast("string")).alias("permalink"))
    without = e.filter(F.col("event_id") % 3 != 0).select("event_id", "event_type", "value")
    K.write_ndjson(with_link, p + "/a")
    K.write_ndjson(without, p + "/b")
    return SR.read_json_lines(spark, [p + "/a", p + "/b"], _EVENT_SCHEMA)


@query("S07_S09_snapshot_recent", sql="""
SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def s07_s09(spark, sf):
    """Snapshot read of a written table; file selection by extension and by
    modification time."""
    n = table(spark, sf, "nation")
    p = scratch(spark, "nation_snap")
    n.write.mode("overwrite").parquet(p)
    snap = SR.read_snapshot(spark, p, "parquet")
    q = scratch(spark, "nation_files")
    K.write_csv(snap, q)
    K.write_ndjson(snap, q, mode="append")  # another format in the folder, left out by the glob
    recent = SR.read_recent(spark, q, "csv", glob="*.csv", modified_after="2000-01-01T00:00:00",
                            header=True, schema="n_nationkey int, n_name string, n_regionkey int")
    return recent


@query("S10_Z15_ingest", sql="""
SELECT 'region' AS name, CAST(r_regionkey AS BIGINT) AS key, r_name AS label, NULL::DOUBLE AS amount FROM region
UNION ALL SELECT 'nation', n_nationkey, n_name, n_regionkey FROM nation
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""")
def s10_z15(spark, sf):
    """Config-driven ingest: master/transaction snapshots and a manual file
    folder, each overwriting its curated target; all rows read back."""
    manual = scratch(spark, "manual_supplier")
    K.write_csv(table(spark, sf, "supplier"), manual)
    target = scratch(spark, "curated")
    cfg = [{"category": "master", "source": f"{sf}/region.parquet", "name": "region"},
           {"category": "transaction", "source": f"{sf}/nation.parquet", "name": "nation"},
           {"category": "manual", "source": manual, "name": "supplier", "fmt": "csv", "glob": "*.csv"}]
    SR.ingest(spark, cfg, target)
    SR.ingest(spark, cfg, target)  # rerun: targets are replaced, not doubled
    picked = {"region": ("r_regionkey", "r_name", None), "nation": ("n_nationkey", "n_name", "n_regionkey"),
              "supplier": ("s_suppkey", "s_name", "s_acctbal")}
    parts = []
    for name, (key, label, amount) in picked.items():
        d = spark.read.parquet(f"{target}/{name}")
        parts.append(d.select(F.lit(name).alias("name"), F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"),
                              (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount")))
    return reduce(lambda x, y: x.unionByName(y), parts)


@query("S11_E14_run_tables", sql="""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS stepjobid, 'events' AS usecase_name,
       CAST(count(*) AS BIGINT) AS total_jobs, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed_jobs,
       CAST(floor(min(epoch(ts))) AS BIGINT) AS start_time, CAST(floor(max(epoch(ts))) AS BIGINT) AS end_time
FROM events GROUP BY CAST(ts AS DATE)""")
def s11_e14(spark, sf):
    """Nested run records (struct and array columns) written as JSON under
    ``year=/month=/day=/stepjobid=`` and read back by partition discovery."""
    e = table(spark, sf, "events")
    d = F.to_date("ts")
    rec = e.groupBy(d.alias("d")).agg(
        F.count(F.lit(1)).alias("total_jobs"), F.count_if(F.col("event_type") == "error").alias("failed_jobs"),
        F.min(F.unix_timestamp(F.col("ts"))).alias("s"),
        F.max(F.unix_timestamp(F.col("ts"))).alias("t"),
        F.array_sort(F.collect_set("event_type")).alias("types"))
    rec = rec.select(
        F.date_format("d", "yyyy").alias("year"), F.date_format("d", "MM").alias("month"),
        F.date_format("d", "dd").alias("day"), F.col("d").cast("string").alias("stepjobid"),
        F.lit("events").alias("usecase_name"), F.lit("Completed").alias("status"),
        F.lit(None).cast("string").alias("winner_algo"),
        F.transform("types", lambda t: F.struct(t.alias("algo_name"), F.lit(1.0).alias("algo_score")))
        .alias("algo_scores"),
        F.struct(F.col("s").alias("start_time"), F.col("t").alias("end_time")).alias("preprocessing"),
        F.struct(F.col("s").alias("start_time"), F.col("t").alias("end_time")).alias("training"),
        "total_jobs", "failed_jobs")
    p = scratch(spark, "run_records")
    body = [c for c in rec.columns if c not in ("year", "month", "day", "stepjobid")] + ["stepjobid"]
    K.write_ndjson(rec.select("year", "month", "day", *body).withColumn("stepjobid_p", F.col("stepjobid")),
                   p, partition_by=["year", "month", "day", "stepjobid_p"])
    back = SR.read_run_tables(spark, p)
    return back.select("stepjobid", "usecase_name", "total_jobs", "failed_jobs",
                       F.col("preprocessing.start_time").alias("start_time"),
                       F.col("training.end_time").alias("end_time"))


@query("K03_keyed_partition_read", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type = 'PROMO' AND l_returnflag = 'R'""")
def k03(spark, sf):
    """Write lines keyed by (pk, mapping) = (part type, flag); read one key's
    partition back (partition pruning on the directories)."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    x = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("p_type").alias("pk"), F.col("l_returnflag").alias("mapping"),
        "l_orderkey", "l_linenumber", "l_quantity")
    path = scratch(spark, "keyed")
    K.write_keyed(x, path)
    back = spark.read.parquet(path).filter((F.col("pk") == "PROMO") & (F.col("mapping") == "R"))
    return back.select("l_orderkey", "l_linenumber", "l_quantity")


_LOAD_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.IntegerType()), T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_shipdate", T.DateType())])


@query("K05_K06_K07_typed_loads", sql="""
SELECT 'full' AS kind, CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(l_quantity AS INTEGER) AS l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
UNION ALL
SELECT 'append', l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER), substr(l_returnflag || l_linestatus, 1, 1),
       CAST(l_shipdate AS DATE) FROM lineitem
UNION ALL
SELECT 'staged', l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER), l_returnflag, CAST(l_shipdate AS DATE)
FROM lineitem""")
def k05_k06_k07(spark, sf):
    """Full-refresh typed load (twice: replaced), append load that cuts texts to
    their declared length (tried again: replaced), and a staged file; all read back."""
    li = table(spark, sf, "lineitem")
    full, app, stg = scratch(spark, "full"), scratch(spark, "append"), scratch(spark, "staged")
    K.load_full(li, _LOAD_SCHEMA, full)
    K.load_full(li, _LOAD_SCHEMA, full)
    for _ in range(2):
        K.load_append(li.withColumn("l_returnflag", F.concat("l_returnflag", "l_linestatus")),
                      _LOAD_SCHEMA, app, max_len={"l_returnflag": 1}, too_long="cut", load_id="one")
    K.stage_single(li.select(*[f.name for f in _LOAD_SCHEMA.fields]), stg,
                   casts={"l_quantity": "int", "l_shipdate": "date"})
    a = spark.read.parquet(full).withColumn("kind", F.lit("full"))
    b = spark.read.parquet(app).drop("load_id").withColumn("kind", F.lit("append"))
    c = spark.read.parquet(stg).withColumn("kind", F.lit("staged"))
    return a.unionByName(b).unionByName(c)


_AS_OF = dt.datetime.fromisoformat(AN.AS_OF)
_OUT_COLS = ["kind", "id", "name", "note", "amount", "stamp"]


@query("K08_K09_K10_K12_K13_outputs", sql=f"""
SELECT 'dash' AS kind, CAST(r_regionkey AS BIGINT) AS id, r_name AS name, NULL::VARCHAR AS note, NULL::DOUBLE AS amount,
       NULL::VARCHAR AS stamp FROM region
UNION ALL SELECT 'outcomes', n_nationkey, n_name, NULL, n_regionkey, NULL FROM nation, range(2)
UNION ALL SELECT 'archive', s_suppkey, s_name, NULL, s_acctbal, 'archive_ts={_AS_OF:%Y%m%d%H%M%S}' FROM supplier
UNION ALL SELECT 'gzip', p_partkey, p_name, p_brand, p_retailprice, 'gz' FROM part
UNION ALL SELECT 'features', c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN 'UNKNOWN' ELSE c_mktsegment END, c_acctbal,
                 '{_AS_OF:%Y-%m-%dT%H:%M:%SZ}' FROM customer""")
def k08_k13(spark, sf):
    """Dashboard overwrite, outcome append (twice), timestamped archive,
    gzip Parquet, feature snapshot with defaults and event time: all rows and
    columns read back, with the archive's folder name and the files' codec."""
    d, o, a, g, f = (scratch(spark, n) for n in ("dash", "outcomes", "archive", "gzip", "features"))
    K.write_dashboard(table(spark, sf, "region"), d)
    K.write_dashboard(table(spark, sf, "region"), d)
    K.write_outcomes(table(spark, sf, "nation"), o)
    K.write_outcomes(table(spark, sf, "nation"), o)
    K.archive_snapshot(table(spark, sf, "supplier"), a, AN.AS_OF)
    K.write_run(table(spark, sf, "part"), g, RUN_DATE, compression="gzip")
    c = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")))
    K.write_features(c, f, {"c_mktsegment": "UNKNOWN"}, AN.AS_OF)

    def rows(kind, path, key, name, note=None, amount=None, stamp=None):
        none = F.lit(None)
        return spark.read.parquet(path).select(
            F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id"), F.col(name).alias("name"),
            (F.col(note) if note else none).cast("string").alias("note"),
            (F.col(amount) if amount else none).cast("double").alias("amount"),
            (none if stamp is None else stamp).cast("string").alias("stamp"))

    file = F.col("_metadata.file_path")
    parts = [rows("dash", d, "r_regionkey", "r_name"), rows("outcomes", o, "n_nationkey", "n_name", amount="n_regionkey"),
             rows("archive", a, "s_suppkey", "s_name", amount="s_acctbal", stamp=F.regexp_extract(file, "(archive_ts=[0-9]+)", 1)),
             rows("gzip", g, "p_partkey", "p_name", "p_brand", "p_retailprice", F.regexp_extract(file, r"\.(gz)\.parquet$", 1)),
             rows("features", f, "c_custkey", "c_name", "c_mktsegment", "c_acctbal", F.col("event_time"))]
    out = reduce(lambda x, y: x.unionByName(y), parts)
    return out.select(*_OUT_COLS)


FILE_BYTES = 256 << 20


def deliver(df, path: str) -> None:
    """Rows appended as a file for every ``FILE_BYTES`` that the optimizer expects of them, not one for
    each task that read them: a stream's micro-batches are counted in files."""
    df.hint("rebalance", max(1, estimated_bytes(df) // FILE_BYTES)).write.mode("append").parquet(path)


@query("S09_A01_streaming_daily_counts", sql="""
SELECT date_trunc('day', ts) AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total
FROM events GROUP BY ALL""")
def s09_a01_stream(spark, sf):
    """Events arrive as three batches of files plus a re-delivered batch of
    duplicates; an ``AvailableNow`` file stream (run twice, the second run
    finds only the late batch) de-duplicates within the watermark and keeps
    daily counts per event type."""
    from tessera.streaming.files import run_available_now
    e = table(spark, sf, "events")
    src, sink, ck = scratch(spark, "stream_src"), scratch(spark, "stream_sink"), scratch(spark, "stream_ck")
    for i in range(3):
        deliver(e.filter(F.col("event_id") % 3 == i), src)
    run_available_now(spark, src, sink, ck, max_files=1, delay="31 days")
    deliver(e.filter(F.col("event_id") % 10 == 0), src)  # re-delivered rows
    run_available_now(spark, src, sink, ck, max_files=1, delay="31 days")
    out = spark.read.parquet(sink)
    return out.select("day", "event_type", F.col("n").cast("bigint").alias("n"), F.round("total", 4).alias("total"))


_S01_SQL = """
SELECT c.c_mktsegment AS segment, n.n_name AS nation, CAST(count(*) AS BIGINT) AS n_orders,
       round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderstatus <> 'P'
GROUP BY c.c_mktsegment, n.n_name"""


@query("S01_read_query", sql=_S01_SQL)
def s01(spark, sf):
    """SQL over catalog tables registered as views (Catalyst prunes the
    columns and pushes the filter into the Parquet scan)."""
    return SR.read_query(spark, _S01_SQL, {t: table(spark, sf, t) for t in ("orders", "customer", "nation")})


@query("K04_catalogued", sql="""
SELECT n_nationkey, n_name, '2024' AS year, '01' AS month, '31' AS day FROM nation
UNION ALL SELECT n_nationkey, upper(n_name) || '!', '2024', '02', '01' FROM nation""")
def k04(spark, sf):
    """Two days written to a catalogued table, the second one twice: the first
    stays, the rerun replaces its own day."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    name, path = f"tessera_catalogued_{uuid.uuid4().hex[:12]}", scratch(spark, "catalogued")
    day = lambda df, m, d: df.withColumns({"year": F.lit("2024"), "month": F.lit(m), "day": F.lit(d)})
    K.write_catalogued(day(n, "01", "31"), path, name)
    second = n.withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!")))
    K.write_catalogued(day(second.withColumn("n_name", F.lit("old")), "02", "01"), path, name)
    K.write_catalogued(day(second, "02", "01"), path, name)
    return spark.table(name)


# day of each load, posts new on it (doc_id % 3), posts of the day before delivered again
_LOAD_DAYS = ["2023-03-01", "2023-09-15", "2024-06-30"]
_AGE = """(year(a) - year(b)) * 12 + (month(a) - month(b))
        + CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)) THEN 0 ELSE (day(a) - day(b)) / 31.0 END"""


def _posts_sql(k: int) -> str:
    return f"""b{k} AS (
  SELECT '{k}-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS id, CASE WHEN doc_id % 50 = 0 THEN NULL ELSE text END AS message,
         CASE WHEN doc_id % 50 = 0 THEN NULL ELSE lower(left(text, 40)) END AS processed_text,
         DATE '2022-06-01' + CAST(doc_id % 800 AS INTEGER) AS created, CAST(doc_id % 5 - 2 AS INTEGER) AS sentiment
  FROM documents WHERE doc_id % 3 = {k}{f" OR (doc_id % 3 = {k - 1} AND doc_id % 2 = 0)" if k else ""}),
all{k} AS ({f"SELECT * FROM t{k - 1} UNION ALL " if k else ""}SELECT * FROM b{k}),
top{k} AS (SELECT *, max(id) OVER (PARTITION BY message) AS top FROM all{k}),
aged{k} AS (SELECT *, {_AGE} AS age FROM (SELECT *, created AS b, DATE '{_LOAD_DAYS[k]}' AS a FROM top{k} WHERE message IS NULL OR id = top)),
t{k} AS (SELECT id, CASE WHEN (age <= 12 AND sentiment = 0) OR age > 12 THEN NULL ELSE message END AS message,
                CASE WHEN (age <= 12 AND sentiment = 0) OR age > 12 THEN NULL ELSE processed_text END AS processed_text,
                created, sentiment FROM aged{k})"""


@query("Z14_K06_maintained_loads", sql=f"""
WITH {", ".join(map(_posts_sql, range(3)))}
SELECT id, md5(message) AS message_md5, processed_text, created, sentiment FROM t2""")
def z14_maintained_loads(spark, sf):
    """Posts (documents) loaded on three days, some delivered again with new ids:
    after each load one row per message over all that was loaded, texts of
    neutral and of year-old posts gone, only touched months rewritten.  The second
    load is tried twice."""
    from tessera.operators import sets as U
    from tessera.operators import windows as W
    d = table(spark, sf, "documents")
    text = F.when(F.col("doc_id") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("text"))
    posts = d.select("doc_id", text.alias("message"), F.lower(F.substring(text, 1, 40)).alias("processed_text"),
                     F.date_add(F.lit("2022-06-01").cast("date"), (F.col("doc_id") % 800).cast("int")).alias("created"),
                     (F.col("doc_id") % 5 - 2).cast("int").alias("sentiment"))
    posts = posts.withColumn("month", F.date_format("created", "yyyy-MM"))
    name, base = f"tessera_posts_{uuid.uuid4().hex[:12]}", scratch(spark, "maintained")
    for k, day in enumerate(_LOAD_DAYS):
        again = (F.col("doc_id") % 3 == k - 1) & (F.col("doc_id") % 2 == 0)
        batch = posts.where((F.col("doc_id") % 3 == k) | again).withColumn(
            "id", F.concat(F.lit(f"{k}-"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))).drop("doc_id")
        for _ in range(2 if k == 1 else 1):
            K.merge_load(batch, name, base, f"load{k}", lambda x: U.redact(  # noqa: B023
                W.dedup_keep_max(x, "message", "id"), "created", "sentiment", ["message", "processed_text"], day),  # noqa: B023
                part="month", key="message", as_of=day,
                changes_on=F.when(F.col("message").isNotNull(), F.add_months("created", 12)))
    return spark.table(name).select("id", F.md5("message").alias("message_md5"), "processed_text", "created", "sentiment")


@query("S09_Z15_K04_changed_files", sql="""
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 1 THEN upper(s_name) || '!' ELSE s_name END AS s_name,
       CASE WHEN s_suppkey % 4 = 1 THEN -s_acctbal ELSE s_acctbal END AS s_acctbal FROM supplier""")
def s09_z15_changed(spark, sf):
    """Suppliers arrive in four files, the last after the first run, when one of
    the others is replaced by a new one.  Each run takes new and changed files only, runs without any change nothing."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    source, target, name = scratch(spark, "arrivals"), scratch(spark, "curated_files"), f"tessera_curated_{uuid.uuid4().hex[:12]}"
    schema = "s_suppkey bigint, s_name string, s_acctbal double"

    def put(part: int, rows):
        rows.where(F.col("s_suppkey") % 4 == part).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{source}/part={part}")

    def run():
        return SR.ingest_changed(spark, source, target, name, schema, glob="*.csv", header=True)
    for part in range(3):
        put(part, s)
    first = run(), run()
    put(3, s)
    put(1, s.withColumns({"s_name": F.concat(F.upper("s_name"), F.lit("!")), "s_acctbal": -F.col("s_acctbal")}))
    second = run(), run()
    if first[1] or second[1]:
        raise RuntimeError("a run without changes took files")
    return SR.read_curated(spark, name, present_in=source)
