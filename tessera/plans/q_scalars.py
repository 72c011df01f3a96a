"""Registered queries for scalar functions (D*, X*, M*), projections (P*)
and filters (F*), each over a driver table, with DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import strings as S
from tessera.functions import values as V
from tessera.operators import filters as FL
from tessera.operators import projections as P
from tessera.plans import analogues as AN
from tessera.plans.registry import query
from tessera.session import table


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_FY = ("CAST(year({d} - INTERVAL 3 MONTH) AS VARCHAR) || '-' || "
       "CAST(year({d} - INTERVAL 3 MONTH) + 1 AS VARCHAR)")

# ---------------------------------------------------------------- dates


@query("D01_fiscal_session", sql=f"""
SELECT o_orderkey, {_FY.format(d='o_orderdate')} AS session FROM orders""")
def d01(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.fiscal_session("o_orderdate").alias("session"))


@query("D02_D03_D09_month_keys", sql="""
SELECT DISTINCT year(l_shipdate) AS year, month(l_shipdate) AS month,
  CAST(CASE WHEN month(l_shipdate) <= 3 THEN year(l_shipdate) - 1 ELSE year(l_shipdate) END AS VARCHAR)
    || '-' || CAST(CASE WHEN month(l_shipdate) <= 3 THEN year(l_shipdate) ELSE year(l_shipdate) + 1 END AS VARCHAR)
    AS session,
  (year(l_shipdate) - 1989) * 12 + month(l_shipdate) - 2 AS serial_id
FROM lineitem""")
def d02_d03_d09(spark, sf):
    li = table(spark, sf, "lineitem")
    y, m = D.year_month("l_shipdate")
    return li.select(y.alias("year"), m.alias("month"),
                     D.fiscal_session_my(m, y).alias("session"),
                     D.serial_month(m, y).alias("serial_id")).distinct()


@query("D04_D05_D10_month_labels", sql="""
SELECT o_orderkey, upper(strftime(o_orderdate, '%b-%Y')) AS month_label,
       strftime(o_orderdate, '%b-%Y') AS month_year, strftime(o_orderdate, '%B') AS month_name,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS parsed_label
FROM orders""")
def d04_d05_d10(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.month_label("o_orderdate").alias("month_label"),
                    D.month_year("o_orderdate").alias("month_year"),
                    D.month_name("o_orderdate").alias("month_name"),
                    D.month_start("o_orderdate").alias("month_start"),
                    D.parse_month_label(D.month_label("o_orderdate")).alias("parsed_label"))


@query("D06_expand_year", sql="""
WITH t AS (SELECT o_orderkey, upper(strftime(o_orderdate, '%b-%y')) AS short_label FROM orders)
SELECT o_orderkey, short_label,
       substr(short_label, 1, length(short_label) - 2) || '20' || substr(short_label, length(short_label) - 1, 2)
         AS fixed_century,
       substr(short_label, 1, length(short_label) - 2)
         || CASE WHEN CAST(substr(short_label, length(short_label) - 1, 2) AS INTEGER) < 98 THEN '20' ELSE '19' END
         || substr(short_label, length(short_label) - 1, 2) AS pivot_century
FROM t""")
def d06(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.upper(F.date_format("o_orderdate", "MMM-yy")).alias("short_label"))
    return o.select("o_orderkey", "short_label",
                    D.expand_year("short_label").alias("fixed_century"),
                    D.expand_year("short_label", pivot=98).alias("pivot_century"))


_DATE_TEXT_SQL = """
CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%d-%m-%Y')
                      WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
                      ELSE 'bad' || CAST(l_linenumber AS VARCHAR) END"""


def _date_text():
    return (F.when(F.col("l_linenumber") % 3 == 0, F.date_format("l_shipdate", "dd-MM-yyyy"))
            .when(F.col("l_linenumber") % 3 == 1, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.concat(F.lit("bad"), F.col("l_linenumber").cast("string"))))


@query("D07_D08_date_text", sql=f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {_DATE_TEXT_SQL} AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, raw,
  CASE WHEN strpos(substr(raw, 1, 4), '-') > 0
       THEN substr(raw, 7, 4) || '-' || substr(raw, 4, 2) || '-' || substr(raw, 1, 2) || ' 00:00:00'
       ELSE raw END AS normalized,
  coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%d-%m-%Y')) AS parsed
FROM t""")
def d07_d08(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             _date_text().alias("raw"))
    return li.select("l_orderkey", "l_linenumber", "raw",
                     D.normalize_date_text("raw").alias("normalized"),
                     D.parse_date("raw", ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy")).alias("parsed"))


@query("D11_days_used", sql="""
SELECT l_orderkey, l_linenumber,
       greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0) AS days_used
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def d11(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", D.days_used("o_orderdate", "l_shipdate").alias("days_used"))


@query("D12_months_old", sql=f"""
WITH t AS (SELECT o_orderkey, DATE '{AN.AS_OF_DATE}' AS a, CAST(o_orderdate AS DATE) AS b FROM orders)
SELECT o_orderkey, round((year(a) - year(b)) * 12 + (month(a) - month(b))
  + CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)) THEN 0
         ELSE (day(a) - day(b)) / 31.0 END, 4) AS months_old
FROM t""")
def d12(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.round(D.months_old("o_orderdate", AN.AS_OF), 4).alias("months_old"))


@query("D13_P10_run_cols", sql=f"""
SELECT r_regionkey, r_name, '{AN.AS_OF_DATE[:4]}' AS year, '{AN.AS_OF_DATE[5:7]}' AS month,
       '{AN.AS_OF_DATE[8:10]}' AS day, 'run-1' AS corelation_id FROM region""")
def d13_p10(spark, sf):
    return P.with_run_cols(table(spark, sf, "region"), AN.AS_OF, run_id="run-1")


@query("D14_elapsed", sql="""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) + CAST(trunc(value) AS BIGINT) * 60
                 - CAST(floor(epoch(ts)) AS BIGINT) AS elapsed
FROM events""")
def d14(spark, sf):
    e = table(spark, sf, "events")
    start = F.unix_timestamp(F.col("ts"))
    st = F.struct(start.alias("start_time"),
                  (start + F.col("value").cast("bigint") * 60).alias("end_time"))
    return e.select("event_id", D.elapsed_seconds(st).alias("elapsed"))


# ---------------------------------------------------------------- strings


@query("X01_prefix", sql="""
SELECT p_partkey, substr(p_name, 1, 3) AS p3, substr(p_name, 1, 4) AS p4, substr(p_name, 1, 5) AS p5 FROM part""")
def x01(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.prefix("p_name", 3).alias("p3"),
                    S.prefix("p_name", 4).alias("p4"), S.prefix("p_name", 5).alias("p5"))


@query("X02_X03_dash_digits", sql="""
WITH t AS (
  SELECT c_custkey, substr(c_name, 1, 5)
           || CASE c_custkey % 3 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE '--' END || substr(c_name, 6) AS code
  FROM customer)
SELECT c_custkey, code,
  CASE WHEN substr(code, 6, 1) = '-' THEN substr(code, 1, 5) || substr(code, 7) ELSE code END AS no_dash,
  coalesce(TRY_CAST(regexp_replace(code, '[^0-9]', '', 'g') AS BIGINT), 0) AS num
FROM t""")
def x02_x03(spark, sf):
    c = table(spark, sf, "customer")
    code = F.concat(F.substring("c_name", 1, 5),
                    F.when(F.col("c_custkey") % 3 == 0, "-").when(F.col("c_custkey") % 3 == 1, "")
                    .otherwise("--"),
                    F.col("c_name").substr(F.lit(6), F.length("c_name")))
    t = c.select("c_custkey", code.alias("code"))
    return t.select("c_custkey", "code", S.remove_dash("code").alias("no_dash"),
                    S.digits("code").alias("num"))


@query("X04_responsibility", sql="""
SELECT doc_id,
  CASE WHEN text IS NULL THEN 'PRODUCTION'
       WHEN starts_with(lower(trim(text)), 'en') OR starts_with(lower(trim(text)), 'yo') THEN 'DESIGN'
       WHEN starts_with(lower(trim(text)), 'qa') THEN 'VENDOR'
       ELSE 'PRODUCTION' END AS defect_resp
FROM documents""")
def x04(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.responsibility("text").alias("defect_resp"))


@query("X05_alnum_key", sql="""
SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}]', '', 'g') AS pk FROM pages""")
def x05(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.alnum_key("url").alias("pk"))


@query("X06_X07_location_plant", sql="""
WITH t AS (SELECT o_orderkey, replace(substr(o_orderpriority, 1, 4), '-', '') AS loc, o_orderstatus,
                  o_orderpriority FROM orders)
SELECT o_orderkey, CASE WHEN loc IN ('1UR', '2HI') THEN 'MSIL' ELSE loc END AS location,
       CASE WHEN regexp_matches(o_orderstatus || o_orderpriority, '^\\p{L}') THEN 'SMG' ELSE 'MSIL' END
         AS status_group,
       CASE WHEN regexp_matches(o_orderpriority, '^\\p{L}') THEN 'SMG' ELSE 'MSIL' END AS priority_group
FROM t""")
def x06_x07(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    S.location("o_orderpriority", aliases=["1UR", "2HI"]).alias("location"),
                    S.plant_group(F.concat("o_orderstatus", "o_orderpriority")).alias("status_group"),
                    S.plant_group("o_orderpriority").alias("priority_group"))


_ENGINE_PREFIX_SQL = """CASE p_size % 4 WHEN 0 THEN upper(substr(p_type, 1, 3)) WHEN 1 THEN NULL
                        WHEN 2 THEN 'D13' ELSE 'ZZZ' END"""


@query("X08_engine_type", sql=f"""
WITH t AS (SELECT p_partkey, {_ENGINE_PREFIX_SQL} AS prefix, p_name || ' ' || p_type AS descr FROM part),
d AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in S.ENGINE_DEFAULTS.items())}) d(k, v)),
m AS (SELECT p_partkey, coalesce(prefix, 'XXX') AS p, descr FROM t)
SELECT p_partkey, coalesce(nullif(regexp_extract(descr, '\\s(' || p || '\\w+)', 1), ''), d.v) AS engine_type
FROM m LEFT JOIN d ON m.p = d.k""")
def x08(spark, sf):
    p = table(spark, sf, "part")
    prefix = (F.when(F.col("p_size") % 4 == 0, F.upper(F.substring("p_type", 1, 3)))
              .when(F.col("p_size") % 4 == 1, F.lit(None).cast("string"))
              .when(F.col("p_size") % 4 == 2, F.lit("D13")).otherwise(F.lit("ZZZ")))
    t = p.select("p_partkey", prefix.alias("prefix"),
                 F.concat_ws(" ", "p_name", "p_type").alias("descr"))
    return t.select("p_partkey", S.engine_type("prefix", "descr").alias("engine_type"))


@query("X09_trim_escaped", sql="""
WITH h AS (SELECT conv_id, turn, substr(text, 1, 64) AS head FROM conversations),
c AS (SELECT conv_id, turn, i, substr(head, i, 1) AS ch, unicode(substr(head, i, 1)) AS o
      FROM h, LATERAL (SELECT unnest(range(1, length(head) + 1)) AS i)),
w AS (SELECT *, CASE WHEN o IN (92, 10, 9, 13) THEN 2 WHEN o < 32 OR o = 127 THEN 4 WHEN o < 128 THEN 1 WHEN o < 256 THEN 4
                     WHEN o < 65536 THEN 6 ELSE 10 END AS width FROM c),
s AS (SELECT *, sum(width) OVER (PARTITION BY conv_id, turn ORDER BY i) AS upto FROM w),
k AS (SELECT conv_id, turn, count(*) FILTER (WHERE upto <= 64) AS k, max(upto) FILTER (WHERE upto <= 64) AS total FROM s GROUP BY ALL),
p AS (SELECT h.conv_id, h.turn, head, coalesce(k, 0) AS k, coalesce(total, 0) AS total, substr(head, 1, coalesce(k, 0)::INT) AS kept
      FROM h LEFT JOIN k USING (conv_id, turn))
SELECT conv_id, turn, CASE WHEN total = 64 OR k = length(head) OR strpos(reverse(kept), ' ') = 0 THEN kept
                           ELSE substr(kept, 1, length(kept) - strpos(reverse(kept), ' ')) END AS text_64
FROM p""")
def x09(spark, sf):
    """Byte-bounded trim of whole conversation texts."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", S.trim_escaped("text", 64).alias("text_64"))


_CLEAN_STOP = _sql_list(S.DEFAULT_STOP_WORDS)
_WORD = "[\\p{L}\\p{N}_]"


def clean_string_sql(col: str) -> str:
    """DuckDB twin of the clean-up part of :func:`strings.clean_tokens` (RE2 has
    no look-around, so the lookbehind is a captured prefix)."""
    s = f"regexp_replace({col}, '<.*?>', '', 'g')"
    s = f"regexp_replace({s}, '(^|[^\\p{{L}}\\p{{N}}_])@({_WORD})', '\\1\\2', 'g')"
    s = f"regexp_replace({s}, '(http?\\://|https?\\://|www)\\S+', ' ', 'g')"
    s = f"regexp_replace({s}, '{S.EMOJI_CLASS}', '', 'g')"
    return f"replace(replace({s}, '#', ''), '_', ' ')"


@query("X10_clean_text", sql=f"""
WITH t AS (SELECT doc_id, regexp_extract_all({clean_string_sql('text')}, '[\\p{{L}}\\p{{N}}]+') AS toks FROM documents),
u AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM t),
f AS (SELECT doc_id, tok, min(pos) AS pos FROM u GROUP BY doc_id, tok),
k AS (SELECT doc_id, string_agg(lower(tok), ' ' ORDER BY pos) AS clean_text FROM f
      WHERE length(tok) > 2 AND tok NOT IN ({_CLEAN_STOP}) GROUP BY doc_id)
SELECT doc_id, coalesce(clean_text, '') AS clean_text FROM t LEFT JOIN k USING (doc_id)""")
def x10(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.clean_text("text").alias("clean_text"))


@query("X13_path_parts", sql="""
WITH t AS (SELECT event_id, 's3://bucket/runs/year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m')
                  || CASE WHEN event_id % 4 = 0 THEN '' ELSE '/day=' || strftime(ts, '%d') END
                  || '/stepjobid=' || CAST(user_id AS VARCHAR) || '/part-0.json' AS path FROM events)
SELECT event_id, nullif(regexp_extract(path, 'year=([^/]*)', 1), '') AS year,
       nullif(regexp_extract(path, 'month=([^/]*)', 1), '') AS month,
       nullif(regexp_extract(path, 'day=([^/]*)', 1), '') AS day,
       nullif(regexp_extract(path, 'stepjobid=([^/]*)', 1), '') AS stepjobid
FROM t""")
def x13(spark, sf):
    e = table(spark, sf, "events")
    path = F.concat(F.lit("s3://bucket/runs/year="), F.date_format("ts", "yyyy"),
                    F.lit("/month="), F.date_format("ts", "MM"),
                    F.when(F.col("event_id") % 4 == 0, F.lit(""))
                    .otherwise(F.concat(F.lit("/day="), F.date_format("ts", "dd"))),
                    F.lit("/stepjobid="), F.col("user_id").cast("string"), F.lit("/part-0.json"))
    t = e.select("event_id", path.alias("path"))
    return t.select("event_id", *[S.path_part("path", k).alias(k)
                                  for k in ("year", "month", "day", "stepjobid")])


_ARN_SQL = """
CASE WHEN event_id % 5 = 0 THEN 'no id here ' || CAST(event_id AS VARCHAR)
     ELSE 'arn:aws:states:eu-west-1:1:execution:train-' || event_type || ':'
          || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4)
          || '-' || substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-'
          || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 21, 12)
END"""


def _arn():
    h = F.md5(F.col("event_id").cast("string"))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(F.col("event_id") % 5 == 0,
                  F.concat(F.lit("no id here "), F.col("event_id").cast("string"))) \
        .otherwise(F.concat(F.lit("arn:aws:states:eu-west-1:1:execution:train-"),
                            F.col("event_type"), F.lit(":"), uuid))


@query("X14_X19_uuid_job_id", sql=f"""
WITH t AS (SELECT event_id, {_ARN_SQL} AS arn FROM events)
SELECT event_id, regexp_extract(arn, '{S.UUID_PATTERN}', 0) AS uuid,
       array_to_string(string_split(arn, ':')[-2:], '-') AS job_id
FROM t""")
def x14_x19(spark, sf):
    e = table(spark, sf, "events").select("event_id", _arn().alias("arn"))
    return e.select("event_id", S.extract_uuid("arn").alias("uuid"), S.job_id("arn").alias("job_id"))


def _split_sql(sep: str) -> str:
    return f"""array_to_string(flatten(list_transform(string_split(regexp_replace(lower(text), '{sep} +', '{sep}', 'g'), '{sep}'),
          lambda x: list_filter(string_split_regex(trim(x), '\\s+'), lambda w: w <> ''))), '|')"""


@query("X15_split_keywords", sql=f"""
SELECT item_id, {_split_sql(',')} AS by_comma, {_split_sql('/')} AS by_slash FROM benchmark""")
def x15(spark, sf):
    return table(spark, sf, "benchmark").select(
        "item_id", F.array_join(S.split_keywords("text", ","), "|").alias("by_comma"),
        F.array_join(S.split_keywords("text"), "|").alias("by_slash"))


@query("X16_X12_labels", sql="""
SELECT c_custkey, n_name || '-' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'DOM' ELSE 'EXP' END
                  || CASE WHEN c_acctbal > 5000 THEN '-N' ELSE '' END AS model,
       coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, n_name) AS owner
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def x16_x12(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    model = S.model_label("n_name", F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 5000)
    owner = S.owner(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), "n_name")
    return j.select("c_custkey", model.alias("model"), owner.alias("owner"))


@query("X17_actual_value", sql="""
WITH t AS (SELECT event_id, CASE WHEN event_type = 'click' THEN MAP(['Completeness', 'Count'], [value, value + 1])
                                 ELSE MAP(['Completeness'], [value]) END AS m FROM events)
SELECT event_id, CASE WHEN cardinality(m) > 1 THEN 'NA' ELSE CAST(map_values(m)[1] AS VARCHAR) END AS actual_value
FROM t""")
def x17(spark, sf):
    e = table(spark, sf, "events")
    m = F.when(F.col("event_type") == "click",
               F.create_map(F.lit("Completeness"), F.col("value"), F.lit("Count"), F.col("value") + 1)) \
        .otherwise(F.create_map(F.lit("Completeness"), F.col("value")))
    return e.select("event_id", V.actual_value(m).alias("actual_value"))


@query("X18_clean_columns", sql="""
SELECT o_orderkey AS order_key, o_orderdate AS order_date, o_totalprice AS total_price FROM orders""")
def x18(spark, sf):
    """Snake-case column names."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_orderdate").alias("OrderDate"),
        F.col("o_totalprice").alias("Total-Price"))
    return o.toDF(*S.clean_columns_names(o.columns))


# ---------------------------------------------------------------- maps / math


@query("M01_M02_props", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing,
       CASE WHEN TRY_CAST(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 - 3 AS VARCHAR) AS INTEGER)
                 IN (-2, -1, 0, 1, 2)
            THEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 - 3 ELSE 0 END AS sentiment
FROM events""")
def m01_m02(spark, sf):
    e = table(spark, sf, "events")
    k = V.json_get("props", "k")
    raw = (k.cast("int") % 7 - 3).cast("string")
    return e.select("event_id", k.alias("k"), V.json_get("props", "missing").alias("missing"),
                    V.norm_sentiment(raw).alias("sentiment"))


@query("M03_minmax", sql="""
SELECT event_id,
  round(CASE WHEN max(value) OVER () = min(value) OVER () THEN 0.0
             ELSE (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) END, 6) AS scaled,
  round(CASE WHEN max(value) OVER (PARTITION BY event_type) = min(value) OVER (PARTITION BY event_type) THEN 0.0
             ELSE (value - min(value) OVER (PARTITION BY event_type))
                  / (max(value) OVER (PARTITION BY event_type) - min(value) OVER (PARTITION BY event_type)) END, 6)
    AS scaled_by_type
FROM events""")
def m03(spark, sf):
    from tessera.operators import models as MO
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    g = MO.minmax(e, "value", out="scaled")
    g = MO.minmax(g, "value", part=["event_type"], out="scaled_by_type")
    return g.select("event_id", F.round("scaled", 6).alias("scaled"),
                    F.round("scaled_by_type", 6).alias("scaled_by_type"))


@query("M04_M05_scores", sql="""
SELECT l_orderkey, l_linenumber, round(l_discount * 100, 2) AS pct,
       round(l_discount / 0.4 + l_tax / 0.6, 6) AS blended
FROM lineitem""")
def m04_m05(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", V.percent("l_discount").alias("pct"),
                     F.round(V.blend("l_discount", "l_tax", 0.4, 0.6), 6).alias("blended"))


# ---------------------------------------------------------------- projections


@query("P01_P02_project_schema", sql="""
SELECT CAST(l_orderkey AS BIGINT) AS order_key, CAST(l_linenumber AS INTEGER) AS line_no,
       CAST(l_quantity AS INTEGER) AS qty, l_returnflag AS flag
FROM lineitem""")
def p01_p02(spark, sf):
    from pyspark.sql import types as T
    li = table(spark, sf, "lineitem")
    x = P.project(li, {"l_orderkey": "order_key", "l_linenumber": "line_no",
                       "l_quantity": "qty", "l_returnflag": "flag", "no_such_col": "ignored"})
    schema = T.StructType([T.StructField("order_key", T.LongType()),
                           T.StructField("line_no", T.IntegerType()),
                           T.StructField("qty", T.IntegerType()),
                           T.StructField("flag", T.StringType())])
    return P.apply_schema(x, schema)


@query("P03_P04_uid", sql=f"""
SELECT o_orderkey, '{AN.LOAD_TS}' AS glue_last_updated,
       CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR) || '-' || '{AN.LOAD_TS}' AS uid
FROM orders""")
def p03_p04(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    o = P.with_load_ts(o, AN.AS_OF)
    return P.with_uid(o, ["o_orderkey"], AN.AS_OF)


@query("P05_P06_keys", sql="""
SELECT l_orderkey, l_linenumber,
       sha256(concat_ws(chr(1), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS row_id,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key
FROM lineitem""")
def p05_p06(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    li = P.with_row_id(li, ["l_orderkey", "l_linenumber"])
    return li.withColumn("line_key", S.concat_key("l_orderkey", "l_linenumber", sep="-"))


_BLANKY_SQL = "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '  ' ELSE c_mktsegment END"


def _blanky():
    return (F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("string"))
            .when(F.col("c_custkey") % 4 == 1, F.lit("  ")).otherwise(F.col("c_mktsegment")))


@query("P07_P08_P09_nulls", sql=f"""
WITH t AS (SELECT c_custkey, c_name, {_BLANKY_SQL} AS seg FROM customer)
SELECT c_custkey, coalesce(seg, 'XXX') AS seg_default,
       CASE WHEN trim(seg) = '' THEN NULL ELSE seg END AS seg_null,
       coalesce(CASE WHEN trim(seg) = '' THEN NULL ELSE seg END, substr(c_name, 1, 5)) AS seg_filled
FROM t""")
def p07_p08_p09(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", _blanky().alias("seg"))
    c = c.withColumn("seg_null", V.blank_to_null("seg")) \
        .withColumn("seg_filled", V.fill_from("seg", "c_name", 5))
    c = P.fill_defaults(c.withColumn("seg_default", F.col("seg")), {"seg_default": "XXX"})
    return c.select("c_custkey", "seg_default", "seg_null", "seg_filled")


@query("P11_P12_measures_text", sql="""
SELECT l_orderkey, l_linenumber, round(coalesce(l_tax, 0) + coalesce(l_discount, 0), 6) AS tax_disc,
       concat_ws(' ', l_returnflag, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_linestatus END,
                 CAST(l_linenumber AS VARCHAR)) AS joined
FROM lineitem""")
def p11_p12(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(V.sum_measures("l_tax", "l_discount"), 6).alias("tax_disc"),
                     S.join_text("l_returnflag",
                                 F.when(F.col("l_linenumber") % 2 == 0, F.lit(None).cast("string"))
                                 .otherwise(F.col("l_linestatus")),
                                 "l_linenumber").alias("joined"))


@query("P13_source", sql="""
WITH t AS (SELECT doc_id, 's3://landing/social/' || source || '/batch-1.json' AS path FROM documents),
f AS (SELECT doc_id, regexp_extract(path, '([^/]+)/[^/]+$', 1) AS folder FROM t)
SELECT doc_id, CASE WHEN folder = 'src0' THEN 'forum' WHEN folder = 'src1' THEN 'news' ELSE folder END AS source
FROM f""")
def p13(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("s3://landing/social/"), F.col("source"),
                           F.lit("/batch-1.json")).alias("path"))
    return P.with_source(d, path_col="path", rename={"src0": "forum", "src1": "news"}) \
        .select("doc_id", "source")


# ---------------------------------------------------------------- filters


@query("F01_code_rule", sql=f"""
WITH t AS (SELECT p_partkey, 'Y' || substr(p_type, 1, 2) || CAST(p_size AS VARCHAR) AS model_code FROM part
           UNION ALL SELECT -1, 'YC%' UNION ALL SELECT -2, 'YL*' UNION ALL SELECT -3, NULL)
SELECT p_partkey, model_code FROM t
WHERE model_code IS NOT NULL AND model_code NOT IN ({_sql_list(S.MODEL_CODE_DENY)})
  AND starts_with(model_code, 'Y') AND substr(model_code, 1, 3) NOT IN ({_sql_list(S.BASE_CODE_DENY)})""")
def f01(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("Y"), F.substring("p_type", 1, 2),
                              F.col("p_size").cast("string")).alias("model_code"))
    extra = spark.createDataFrame([(-1, "YC%"), (-2, "YL*"), (-3, None)],
                                  "p_partkey long, model_code string")
    t = p.unionByName(extra).withColumn("_base", S.prefix("model_code", 3))
    return FL.filter_codes(t, "model_code", "_base").select("p_partkey", "model_code")


@query("F02_F03_F08_order_filters", sql="""
SELECT o_orderkey FROM orders
WHERE NOT coalesce(o_orderstatus IN ('F'), false)
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
  AND o_totalprice IS NOT NULL""")
def f02_f03_f08(spark, sf):
    o = table(spark, sf, "orders")
    o = FL.exclude_keep_null(o, "o_orderstatus", ["F"])
    o = FL.between(o, "o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"),
                   F.lit("1998-12-31").cast("timestamp_ntz"))
    return FL.not_null(o, ["o_totalprice"]).select("o_orderkey")


@query("F04_F05_customer_guards", sql="""
SELECT c_custkey FROM customer
WHERE trim(c_mktsegment) <> 'BUILDING' AND trim(c_mktsegment) IS NOT NULL
  AND TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) > 0""")
def f04_f05(spark, sf):
    c = table(spark, sf, "customer")
    return c.filter(FL.trim_ne("c_mktsegment", "BUILDING") & F.trim("c_mktsegment").isNotNull()
                    & FL.numeric_gt("c_acctbal", 0)).select("c_custkey")


@query("F06_code_pattern", sql=f"""
WITH {AN.PRODUCTION_DAYS_SQL.strip()}
SELECT DISTINCT pday_ctrlpt_number FROM prod
WHERE length(pday_ctrlpt_number) > 3 AND regexp_matches(pday_ctrlpt_number, '^.A.*500$')""")
def f06(spark, sf):
    prod = AN.production_days(spark, sf)
    return prod.filter(FL.code_pattern("pday_ctrlpt_number")).select("pday_ctrlpt_number").distinct()


@query("F07_channel", sql="""
SELECT doc_id FROM documents WHERE upper(source) IN ('SRC1', 'SRC2', 'SRC3') AND lang = 'en'""")
def f07(spark, sf):
    d = table(spark, sf, "documents")
    return FL.filter_channel(d, "source", ["Src1", "src2", "SRC3"], lang_col="lang").select("doc_id")


@query("F09_spam_flag", sql=f"""
SELECT doc_id,
  len(regexp_extract_all(text, '(^|[^\\p{{L}}\\p{{N}}_])@{_WORD}+')) AS mentions,
  len(regexp_extract_all(text, '(^|[^\\p{{L}}\\p{{N}}_])#{_WORD}+')) AS hashtags,
  len(regexp_extract_all(text, '(^|[^\\p{{L}}\\p{{N}}_])@{_WORD}+')) <= 4
    AND len(regexp_extract_all(text, '(^|[^\\p{{L}}\\p{{N}}_])#{_WORD}+')) <= 4 AS filter_flag
FROM documents""")
def f09(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.mention_count("text").alias("mentions"),
                    S.hashtag_count("text").alias("hashtags"),
                    FL.spam_flag("text").alias("filter_flag"))
