"""Registered queries for joins (J*), aggregates (A*), windows (W*), set
operations (U*) and top-k (T*), with DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import sets as U
from tessera.operators import windows as W
from tessera.plans import analogues as AN
from tessera.plans.registry import query
from tessera.session import table

# ---------------------------------------------------------------- joins


@query("J01_inner_multi_key", sql="""
SELECT o_orderkey, l_linenumber, o_orderstatus
FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus""")
def j01(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                             F.col("l_linestatus").alias("o_orderstatus"),
                                             "l_linenumber")
    return J.join(o, li, ["o_orderkey", "o_orderstatus"]) \
        .select("o_orderkey", "l_linenumber", "o_orderstatus")


@query("J02_left_distinct", sql="""
SELECT o_orderkey, d.l_returnflag
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) d ON o_orderkey = d.l_orderkey""")
def j02(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_returnflag")
    return J.left_distinct(o, d, ["k"]).select(F.col("k").alias("o_orderkey"), "l_returnflag")


@query("J03_range_join_calendar", sql=f"""
WITH {AN.MONTH_CALENDAR_SQL.strip()},
o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + 10 AS fcok FROM orders)
SELECT o_orderkey, mnt.month, mnt.fyear, f.month AS fcok_month, f.fyear AS fcok_year
FROM o JOIN cal f ON o.fcok BETWEEN f.caln_start_date AND f.caln_end_date
       JOIN cal mnt ON o.d BETWEEN mnt.start_date AND mnt.end_date""")
def j03(spark, sf):
    cal = AN.month_calendar(spark, sf)  # ranges of a month
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"),
        F.date_add(F.to_date("o_orderdate"), 10).alias("fcok"))
    fc = cal.select(F.col("month").alias("fcok_month"), F.col("fyear").alias("fcok_year"),
                    "caln_start_date", "caln_end_date")
    x = J.range_join(o, J.bounded_broadcast(fc, 100_000), "fcok", "caln_start_date", "caln_end_date", clamp=False)
    mn = cal.select("month", "fyear", "start_date", "end_date")
    x = J.range_join(x, J.bounded_broadcast(mn, 100_000), "d", "start_date", "end_date", clamp=False)
    return x.select("o_orderkey", "month", "fyear", "fcok_month", "fcok_year")


@query("J04_band_join", sql=f"""
WITH {AN.QUANTITY_BANDS_SQL.strip()},
li AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, mile_desc
FROM li JOIN mile ON coalesce(q, -1) BETWEEN mile_start_km AND mile_end_km""")
def j04(spark, sf):
    bands = AN.quantity_bands(spark, sf)
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity")).alias("q"))
    x = J.band_join(li, J.bounded_broadcast(bands, 100_000), "q", "mile_start_km", "mile_end_km",
                    width=10, null_as=-1)
    return x.select("l_orderkey", "l_linenumber", "mile_desc")


@query("J05_default_key", sql="""
WITH ptyp AS (SELECT DISTINCT l_returnflag AS ptyp_part_type, 'flag ' || l_returnflag AS ptyp_part_desc FROM lineitem
              UNION ALL SELECT 'X', 'unspecified')
SELECT l_orderkey, l_linenumber, ptyp_part_desc
FROM lineitem JOIN ptyp ON coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END, 'X') = ptyp_part_type""")
def j05(spark, sf):
    li = table(spark, sf, "lineitem")
    ptyp = li.select(F.col("l_returnflag").alias("ptyp_part_type"),
                     F.concat(F.lit("flag "), F.col("l_returnflag")).alias("ptyp_part_desc")).distinct() \
        .unionByName(spark.createDataFrame([("X", "unspecified")], "ptyp_part_type string, ptyp_part_desc string"))
    x = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
                  .otherwise(F.col("l_returnflag")).alias("part_type"))
    return J.join_default_key(x, J.bounded_broadcast(ptyp, 100_000), "part_type", "ptyp_part_type", "X") \
        .select("l_orderkey", "l_linenumber", "ptyp_part_desc")


@query("J06_J19_semi_anti", sql="""
SELECT o_orderkey, 'semi' AS kind FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL
SELECT o_orderkey, 'anti' FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey)""")
def j06_j19(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    r = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    semi = J.semi_join(o, r, "o_orderkey", "l_orderkey").withColumn("kind", F.lit("semi"))
    anti = J.anti_join(o, r, "o_orderkey", "l_orderkey").withColumn("kind", F.lit("anti"))
    return semi.unionByName(anti)


@query("J07_or_join", sql="""
SELECT c_custkey, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey OR c_nationkey = n_regionkey""")
def j07(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return J.or_join(c, n, "c_nationkey", ("n_nationkey", "n_regionkey")).select("c_custkey", "n_nationkey")


@query("J08_left_chain", sql="""
SELECT o_orderkey, c_name, n_name, r_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'ASIA' AND n_name IS NOT NULL""")
def j08(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    x = J.left_chain(o, [(c, "o_custkey", "c_custkey"), (n, "c_nationkey", "n_nationkey"),
                         (r, "n_regionkey", "r_regionkey")]) \
        .filter((F.col("r_name") != "ASIA") & F.col("n_name").isNotNull())
    return x.select("o_orderkey", "c_name", "n_name", "r_name")


_CAST_KEY_SQL = ("CASE WHEN l_linenumber = 3 THEN 'x' || CAST(l_partkey AS VARCHAR) "
                 "ELSE lpad(CAST(l_partkey AS VARCHAR), 8, '0') END")


@query("J09_cast_key_star", sql=f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_suppkey, {_CAST_KEY_SQL} AS part_txt FROM lineitem),
p AS (SELECT CAST(p_partkey AS VARCHAR) AS p_txt, p_name FROM part)
SELECT l_orderkey, l_linenumber, c_name, n_name, s_name, p_name
FROM li LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN p ON TRY_CAST(part_txt AS INTEGER) = TRY_CAST(p_txt AS INTEGER)""")
def j09(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit("x"), F.col("l_partkey").cast("string")))
        .otherwise(F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("part_txt"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("p_txt"), "p_name")
    x = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left") \
        .join(c, F.col("o_custkey") == c["c_custkey"], "left") \
        .join(n, F.col("c_nationkey") == n["n_nationkey"], "left") \
        .join(s, li["l_suppkey"] == s["s_suppkey"], "left")
    x = J.join_cast_key(x, p, "part_txt", "p_txt", how="left")
    return x.select("l_orderkey", "l_linenumber", "c_name", "n_name", "s_name", "p_name")


@query("J10_causal_line", sql="""
WITH cnt AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, l_linenumber, l_returnflag
FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus
            JOIN cnt ON cnt.k = l_orderkey
WHERE (cnt.n > 1 AND l_returnflag = 'R') OR (cnt.n = 1 AND l_returnflag IN ('R', 'A'))""")
def j10(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", "l_linenumber", "l_returnflag")
    x = J.pick_causal_line(o, li, ["o_orderkey", "o_orderstatus"], ["l_orderkey", "l_linestatus"],
                           ["o_orderkey"], ["l_orderkey"], "l_returnflag",
                           multi_flags=("R",), single_flags=("R", "A"))
    return x.select("o_orderkey", "l_linenumber", "l_returnflag")


@query("J11_resolve_parent", sql=f"""
WITH {AN.VENDOR_HIERARCHY_SQL.strip()},
v AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS vend_cd FROM lineitem UNION SELECT 'unknown-vendor'),
r AS (SELECT c1.ctrr_code AS code, coalesce(max(c2.ctrr_name), max(c1.ctrr_name)) AS nm
      FROM ctrr c1 JOIN (SELECT DISTINCT ctrr_code, ctrr_name FROM ctrr) c2 ON c1.ctrr_parent_vend_code = c2.ctrr_code
      GROUP BY c1.ctrr_code)
SELECT vend_cd, coalesce(r.nm, vend_cd) AS vendor_name FROM v LEFT JOIN r ON v.vend_cd = r.code""")
def j11(spark, sf):
    h = AN.vendor_hierarchy(spark, sf)
    v = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("vend_cd")) \
        .unionByName(spark.createDataFrame([("unknown-vendor",)], "vend_cd string")).distinct()
    return J.resolve_parent(v, "vend_cd", h, "ctrr_code", "ctrr_parent_vend_code", "ctrr_name",
                            "vendor_name").select("vend_cd", "vendor_name")


@query("J12_scalar_lookup", sql="""
SELECT c_custkey,
       coalesce((SELECT n_name FROM nation WHERE n_nationkey =
                   CASE WHEN c_custkey % 50 = 0 THEN 99 ELSE c_nationkey END), 'UNKNOWN') AS nation_name
FROM customer""")
def j12(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 50 == 0, F.lit(99)).otherwise(F.col("c_nationkey")).alias("nk"))
    n = table(spark, sf, "nation")
    return J.scalar_lookup(c, n, {"nk": "n_nationkey"}, "n_name", "nation_name", default="UNKNOWN") \
        .select("c_custkey", "nation_name")


@query("J13_scalar_max_two_outer", sql="""
SELECT l_orderkey, l_linenumber,
       (SELECT max(s_name) FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey = c_nationkey) AS same_nation_supplier
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def j13(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    x = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"]) \
        .select("l_orderkey", "l_linenumber", "l_suppkey", "c_nationkey")
    s = table(spark, sf, "supplier")
    return J.scalar_max(x, s, {"l_suppkey": "s_suppkey", "c_nationkey": "s_nationkey"}, "s_name",
                        "same_nation_supplier").select("l_orderkey", "l_linenumber", "same_nation_supplier")


@query("J14_comma_join", sql="""
SELECT l_orderkey, l_linenumber, c_custkey, n_name
FROM lineitem, orders, customer, nation
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
  AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""")
def j14(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").filter(F.col("o_orderdate").between(
        F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1997-12-31").cast("timestamp_ntz")))
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    x = J.join(li, o.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"])
    x = J.join(x.withColumnRenamed("o_custkey", "c_custkey"), c, ["c_custkey"])
    x = J.join(x.withColumnRenamed("c_nationkey", "n_nationkey"), n, ["n_nationkey"])
    return x.select("l_orderkey", "l_linenumber", "c_custkey", "n_name")


@query("J15_left_merge_dedup", sql="""
WITH lab AS (SELECT doc_id AS label_doc, quality, toxic FROM labels
             UNION ALL SELECT doc_id, quality, toxic FROM labels WHERE doc_id % 3 = 0),
conv AS (SELECT DISTINCT conv_id AS conv_doc, 'has-conversation' AS conv_flag FROM conversations),
m1 AS (SELECT DISTINCT doc_id, lang, quality, toxic FROM documents LEFT JOIN lab ON doc_id = label_doc)
SELECT DISTINCT doc_id, lang, quality, toxic, conv_flag FROM m1 LEFT JOIN conv ON doc_id = conv_doc""")
def j15(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("label_doc"), "quality", "toxic")
    lab = lab.unionByName(lab.filter(F.col("label_doc") % 3 == 0))
    conv = table(spark, sf, "conversations").select(F.col("conv_id").alias("conv_doc")).distinct() \
        .withColumn("conv_flag", F.lit("has-conversation"))
    m1 = J.left_merge_dedup(d, lab, "doc_id", "label_doc")
    return J.left_merge_dedup(m1, conv, "doc_id", "conv_doc")


@query("J16_map_lookup_last_wins", sql="""
WITH lk AS (SELECT n_nationkey AS k, n_name AS v, 0 AS ord FROM nation
            UNION ALL SELECT n_nationkey, lower(n_name), 1 FROM nation WHERE n_nationkey % 4 = 0
            UNION ALL SELECT n_nationkey, NULL, 2 FROM nation WHERE n_nationkey = 5),
d AS (SELECT k, v FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY ord DESC) AS rn FROM lk) WHERE rn = 1),
c AS (SELECT c_custkey, CASE WHEN c_custkey % 40 = 0 THEN 77 ELSE c_nationkey END AS nk FROM customer)
SELECT c_custkey, CASE WHEN d.k IS NULL THEN 'Not_Found' ELSE d.v END AS city FROM c LEFT JOIN d ON c.nk = d.k""")
def j16(spark, sf):
    n = table(spark, sf, "nation")
    lk = n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"), F.lit(0).alias("ord")) \
        .unionByName(n.filter(F.col("n_nationkey") % 4 == 0).select(
            F.col("n_nationkey").alias("k"), F.lower("n_name").alias("v"), F.lit(1).alias("ord"))) \
        .unionByName(n.filter(F.col("n_nationkey") == 5).select(
            F.col("n_nationkey").alias("k"), F.lit(None).cast("string").alias("v"), F.lit(2).alias("ord")))
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 40 == 0, F.lit(77)).otherwise(F.col("c_nationkey")).alias("nk"))
    return J.map_lookup(c, "nk", lk, "k", "v", "city", order="ord", default="Not_Found") \
        .select("c_custkey", "city")


@query("J17_full_outer_counts", sql="""
WITH p AS (SELECT event_type AS rule, count(*) AS passcnt FROM events WHERE value >= 10 AND event_type <> 'error'
           GROUP BY event_type),
f AS (SELECT event_type AS rule, count(*) AS failcnt FROM events WHERE value < 10 AND event_type <> 'signup'
      GROUP BY event_type)
SELECT coalesce(p.rule, f.rule) AS rule, CAST(coalesce(passcnt, 0) AS BIGINT) AS passcnt,
       CAST(coalesce(failcnt, 0) AS BIGINT) AS failcnt
FROM p FULL OUTER JOIN f ON p.rule = f.rule""")
def j17(spark, sf):
    e = table(spark, sf, "events")
    p = e.filter((F.col("value") >= 10) & (F.col("event_type") != "error")).groupBy(
        F.col("event_type").alias("rule")).agg(F.count(F.lit(1)).alias("passcnt"))
    f = e.filter((F.col("value") < 10) & (F.col("event_type") != "signup")).groupBy(
        F.col("event_type").alias("rule")).agg(F.count(F.lit(1)).alias("failcnt"))
    return J.full_outer_counts(p, f, "rule", "passcnt", "failcnt")


@query("J18_join_meta", sql="""
WITH meta AS (SELECT DISTINCT event_type AS rule_type, upper(event_type) AS rule_label FROM events)
SELECT event_id, rule_label FROM events JOIN meta ON event_type = rule_type""")
def j18(spark, sf):
    e = table(spark, sf, "events")
    meta = e.select(F.col("event_type").alias("rule_type"),
                    F.upper("event_type").alias("rule_label")).distinct()
    x = e.select("event_id", "event_type")
    return J.join_meta(x, meta, "event_type", "rule_type").select("event_id", "rule_label")


# ---------------------------------------------------------------- aggregates


@query("A01_group_sum_null_rules", sql="""
WITH t AS (SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END AS st,
                  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE l_quantity END AS q
           FROM lineitem)
SELECT l_returnflag, st, round(coalesce(sum(q), 0), 4) AS total FROM t
WHERE l_returnflag IS NOT NULL AND st IS NOT NULL GROUP BY l_returnflag, st""")
def a01(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise(F.col("l_linestatus")).alias("st"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity")).alias("q"))
    g = A.group_sum(li, ["l_returnflag", "st"], "q", out="total")
    return g.withColumn("total", F.round("total", 4))


@query("A02_A03_max_distinct", sql="""
SELECT s_nationkey, max(s_name) AS max_name, count(DISTINCT s_acctbal > 0) AS n_signs
FROM (SELECT DISTINCT s_nationkey, s_name, s_acctbal FROM supplier) GROUP BY s_nationkey""")
def a02_a03(spark, sf):
    s = table(spark, sf, "supplier").select("s_nationkey", "s_name", "s_acctbal")
    signs = s.select("s_nationkey", (F.col("s_acctbal") > 0).alias("positive")).filter("positive is not null")
    n = J.left_distinct(s.select("s_nationkey").distinct(), signs, ["s_nationkey"]) \
        .groupBy("s_nationkey").agg(F.count("positive").alias("n_signs"))
    return J.join(A.max_per_key(s, "s_nationkey", "s_name", "max_name"), n, ["s_nationkey"])


@query("A04_A09_metrics", sql="""
SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_customers, min(o_totalprice) AS min_price,
       CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS n_status FROM orders""")
def a04_a09(spark, sf):
    o = table(spark, sf, "orders")
    return A.metrics(o, {"n_customers": F.countDistinct("o_custkey").cast("bigint"),
                         "min_price": F.min("o_totalprice"),
                         "n_status": F.countDistinct("o_orderstatus").cast("bigint")})


@query("A05_status_rollup", sql="""
WITH t AS (SELECT event_type AS source, CAST(ts AS DATE) AS d,
                  CASE WHEN value >= 99 THEN 'Failed' ELSE 'Passed' END AS outcome FROM events)
SELECT source, d, CASE WHEN sum(CASE WHEN outcome = 'Failed' THEN 1 WHEN outcome = 'Passed' THEN 0 END) >= 1
                       THEN 'Failed' ELSE 'Passed' END AS result
FROM t GROUP BY source, d""")
def a05(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.to_date("ts").alias("d"),
        F.when(F.col("value") >= 99, "Failed").otherwise("Passed").alias("outcome"))
    return A.status_rollup(e, ["source", "d"])


@query("A06_A10_duplicate_texts", sql="""
SELECT md5(text) AS text_md5, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY text HAVING count(*) > 1""")
def a06_a10(spark, sf):
    d = table(spark, sf, "documents").select("text")
    g = A.duplicate_groups(d, ["text"])
    return g.select(F.md5("text").alias("text_md5"), F.col("n"))


@query("A07_count_exploded", sql="""
SELECT w AS word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)
GROUP BY w""")
def a07(spark, sf):
    p = table(spark, sf, "part").select(F.split("p_name", " ").alias("words"))
    return A.count_exploded(p, "words", "word")


@query("A08_group_size", sql="""
SELECT c_nationkey, c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY c_nationkey, c_mktsegment""")
def a08(spark, sf):
    return A.group_size(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


@query("A11_run_summary", sql="""
WITH s AS (SELECT CAST(ts AS DATE) AS run_date, user_id % 7 AS model,
                  CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Succeeded' END AS status,
                  CAST(floor(epoch(ts)) AS BIGINT) AS start_time,
                  CAST(floor(epoch(ts)) AS BIGINT) + CAST(trunc(value) AS BIGINT) AS end_time FROM events)
SELECT run_date, CAST(count(*) AS BIGINT) AS total_jobs,
       CAST(count(*) FILTER (WHERE status = 'Succeeded') AS BIGINT) AS succeeded_jobs,
       CAST(count(*) FILTER (WHERE status = 'Failed') AS BIGINT) AS failed_jobs,
       max(end_time) - min(start_time) AS elapsed_seconds, CAST(count(DISTINCT model) AS BIGINT) AS models
FROM s GROUP BY run_date""")
def a11(spark, sf):
    e = table(spark, sf, "events")
    start = F.unix_timestamp(F.col("ts"))
    s = e.select(F.to_date("ts").alias("run_date"), (F.col("user_id") % 7).alias("model"),
                 F.when(F.col("event_type") == "error", "Failed").otherwise("Succeeded").alias("status"),
                 start.alias("start_time"), (start + F.col("value").cast("bigint")).alias("end_time"))
    return A.run_summary(s, model_col="model", keys=["run_date"])


# ---------------------------------------------------------------- windows


@query("W01_topn_rank", sql="""
SELECT DISTINCT event_type, event_id FROM (
  SELECT event_type, event_id, rank() OVER (PARTITION BY event_type ORDER BY round(value) DESC) AS rk FROM events)
WHERE rk <= 5""")
def w01(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", F.round("value").alias("v"))
    return W.topn_rank(e, ["event_type"], "v", 5, keys=["event_type", "event_id"])


@query("W02_T05_winner", sql="""
WITH m AS (SELECT event_type AS algoname, round(avg(value), 2) AS metric FROM events GROUP BY event_type)
SELECT algoname, metric FROM m ORDER BY metric DESC, algoname LIMIT 1""")
def w02_t05(spark, sf):
    m = table(spark, sf, "events").groupBy(F.col("event_type").alias("algoname")) \
        .agg(F.round(F.avg("value"), 2).alias("metric"))
    return W.winner(m, "metric", "algoname")


@query("W03_latest_per", sql="""
SELECT user_id, event_type, event_id FROM events e
WHERE ts = (SELECT max(ts) FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type)""")
def w03(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return W.latest_per(e, ["user_id", "event_type"], "ts").select("user_id", "event_type", "event_id")


@query("W04_W08_dedup_prefer_updated", sql="""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS flag,
                  CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate END AS upd FROM lineitem),
c AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, flag) AS n FROM t)
SELECT l_orderkey, l_linenumber FROM c WHERE n = 1 OR upd IS NOT NULL""")
def w04_w08(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_shipdate")).alias("upd"))
    return W.dedup_prefer_updated(li, ["l_orderkey", "flag"], "upd").select("l_orderkey", "l_linenumber")


@query("W05_U06_dedup_keep_max", sql="""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN NULL ELSE text END AS t FROM documents),
m AS (SELECT t AS k, max(doc_id) AS mx FROM t WHERE t IS NOT NULL GROUP BY t)
SELECT doc_id FROM t LEFT JOIN m ON t.t = m.k WHERE m.mx IS NULL OR t.doc_id = m.mx""")
def w05_u06(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("t"))
    return W.dedup_keep_max(d, "t", "doc_id").select("doc_id")


@query("W06_keep_last", sql="""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
       arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id""")
def w06(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return W.keep_last(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("W07_ffill", sql="""
WITH t AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events)
SELECT event_id,
  last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v_user,
  last_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v_all
FROM t""")
def w07(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("v"))
    day = F.date_trunc("day", F.col("ts"))
    x = W.ffill(e, "v", ["ts", "event_id"], part=["user_id"], bucket=day, out="v_user")
    x = W.ffill(x, "v", ["ts", "event_id"], part=[], bucket=day, out="v_all")
    return x.select("event_id", "v_user", "v_all")


# ---------------------------------------------------------------- sets / top-k


@query("U01_union_by_name", sql="""
SELECT c_custkey, c_name, c_mktsegment, NULL AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def u01(spark, sf):
    c = table(spark, sf, "customer")
    a = c.filter(F.col("c_mktsegment") == "BUILDING").select("c_mktsegment", "c_name", "c_custkey")
    b = c.filter(F.col("c_mktsegment") != "BUILDING").select("c_acctbal", "c_custkey", "c_name", "c_mktsegment")
    return U.union_by_name([a, b], ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])


@query("U03_once_only", sql="""
WITH u AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, o_orderstatus FROM u GROUP BY ALL HAVING count(*) = 1""")
def u03(spark, sf):
    o = table(spark, sf, "orders")
    a = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    b = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_orderstatus")
    return U.once_only(a, b)


@query("U04_subset_check", sql="""
WITH s AS (SELECT user_id, list_distinct(list(event_type)) AS used FROM events GROUP BY user_id)
SELECT user_id, list_has_all(['click', 'view', 'purchase', 'signup'], used) AS known_only FROM s""")
def u04(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("used"))
    allowed = F.array(*[F.lit(x) for x in ("click", "view", "purchase", "signup")])
    return e.select("user_id", U.is_subset(F.col("used"), allowed).alias("known_only"))


_WINDOWS = [("1995-04-01", "1996-03-31"), ("1996-04-01", "1997-03-31"),
            ("1998-04-01", "1999-03-31"), ("2000-04-01", "2001-03-31")]


@query("U05_read_windows", sql="""
SELECT o_orderkey FROM orders WHERE """ + " OR ".join(
    f"CAST(o_orderdate AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'" for lo, hi in _WINDOWS))
def u05(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return U.read_windows(o, "d", [(F.lit(lo).cast("date"), F.lit(hi).cast("date")) for lo, hi in _WINDOWS]) \
        .select("o_orderkey")


@query("U07_redact", sql="""
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS b, DATE '1998-06-01' AS a, o_custkey % 5 - 2 AS sentiment,
                  o_orderpriority FROM orders),
m AS (SELECT *, (year(a) - year(b)) * 12 + (month(a) - month(b))
        + CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)) THEN 0 ELSE (day(a) - day(b)) / 31.0 END
        AS age FROM t)
SELECT o_orderkey, CASE WHEN (age <= 12 AND sentiment = 0) OR age > 12 THEN NULL ELSE o_orderpriority END
                   AS o_orderpriority
FROM m""")
def u07(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority",
                                          (F.col("o_custkey") % 5 - 2).alias("sentiment"))
    return U.redact(o, "o_orderdate", "sentiment", ["o_orderpriority"], "1998-06-01") \
        .select("o_orderkey", "o_orderpriority")


@query("T01_best_label", sql="""
WITH s AS (SELECT o_custkey, o_orderpriority AS label, round(o_totalprice / 100000) AS score FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, label) AS rn FROM s)
SELECT o_custkey, label, score FROM r WHERE rn = 1""")
def t01(spark, sf):
    s = table(spark, sf, "orders").select("o_custkey", F.col("o_orderpriority").alias("lbl"),
                                          F.round(F.col("o_totalprice") / 100000).alias("sc"))
    return W.best_label(s, ["o_custkey"], "lbl", "sc")


@query("A10_count_delta", sql="""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN NULL ELSE text END AS t FROM documents),
m AS (SELECT t AS k, max(doc_id) AS mx FROM t WHERE t IS NOT NULL GROUP BY t),
kept AS (SELECT doc_id FROM t LEFT JOIN m ON t.t = m.k WHERE m.mx IS NULL OR t.doc_id = m.mx)
SELECT (SELECT count(*) FROM t) AS rows_before, (SELECT count(*) FROM kept) AS rows_after,
       (SELECT count(*) FROM t) - (SELECT count(*) FROM kept) AS rows_removed""")
def a10(spark, sf):
    """Rows before and after removing duplicate texts (keep the largest id)."""
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("t"))
    return A.count_delta(d, W.dedup_keep_max(d, "t", "doc_id"))
