"""Source-entity analogues built from the driver tables.

The marts were written against manufacturing tables (claims, production
days, invoices ...).  The driver ships TPC-H-like tables instead, so each
entity is derived from them — in Spark for the query and as an SQL CTE for
the oracle.  Both sides must stay in step; every builder has its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

# Run date used by every registered query (never the wall clock).
AS_OF = "2024-02-01 00:00:00"
AS_OF_DATE = "2024-02-01"
LOAD_TS = "2024-02-01 05:30:00"  # AS_OF at UTC+5:30, as text


def production_days(spark: SparkSession, sf: str) -> DataFrame:
    """Production-day rows: one per line item, model code from the part."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    first = F.when(F.col("l_linenumber") <= 2, F.col("l_linestatus")) \
        .otherwise(F.col("l_linenumber").cast("string"))
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("l_shipdate").alias("pday_date"),
        F.concat(first, F.col("l_returnflag"), F.pmod(F.col("l_suppkey"), F.lit(10)).cast("string"),
                 F.lit("500")).alias("pday_ctrlpt_number"),
        F.concat(F.lit("Y"), F.substring("p_type", 1, 2), F.col("p_size").cast("string"))
        .alias("pday_pmodel_code"),
        F.col("l_quantity").alias("pday_quantity_a"),
        F.col("l_tax").alias("pday_quantity_b"))


PRODUCTION_DAYS_SQL = """
prod AS (
  SELECT l_shipdate AS pday_date,
         (CASE WHEN l_linenumber <= 2 THEN l_linestatus ELSE CAST(l_linenumber AS VARCHAR) END)
           || l_returnflag || CAST(l_suppkey % 10 AS VARCHAR) || '500' AS pday_ctrlpt_number,
         'Y' || substr(p_type, 1, 2) || CAST(p_size AS VARCHAR) AS pday_pmodel_code,
         l_quantity AS pday_quantity_a, l_tax AS pday_quantity_b
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    """Dispatch invoices: one per order line; dealer = customer, spec code
    from the order priority."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    p = table(spark, sf, "part")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    return j.select(
        F.col("o_orderdate").alias("invc_date"),
        F.concat(F.lit("Y"), F.substring("p_type", 1, 2), F.col("p_size").cast("string"),
                 F.col("l_returnflag")).alias("invc_pmod_code"),
        F.substring("o_orderpriority", 1, 1).alias("invc_spec_code"),
        F.col("o_custkey").cast("string").alias("invc_delr_code"),
        F.col("l_quantity").cast("int").alias("invc_qty"))


INVOICES_SQL = """
invc AS (
  SELECT o_orderdate AS invc_date,
         'Y' || substr(p_type, 1, 2) || CAST(p_size AS VARCHAR) || l_returnflag AS invc_pmod_code,
         substr(o_orderpriority, 1, 1) AS invc_spec_code,
         CAST(o_custkey AS VARCHAR) AS invc_delr_code,
         CAST(l_quantity AS INTEGER) AS invc_qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def dealers(spark: SparkSession, sf: str) -> DataFrame:
    """Dealer master: code, city (nation), state (region)."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]) \
        .join(r, n["n_regionkey"] == r["r_regionkey"]) \
        .select(F.col("c_custkey").cast("string").alias("delr_cd"),
                F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                F.col("c_custkey").alias("ord"))


DEALERS_SQL = """
dmdl AS (
  SELECT CAST(c_custkey AS VARCHAR) AS delr_cd, n_name AS city, r_name AS state, c_custkey AS ord
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def vendor_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor hierarchy: every supplier, parent = suppkey % 10, except every
    7th supplier whose parent code has no row; every 11th supplier appears a
    second time under an upper-case name (two names for one code)."""
    s = table(spark, sf, "supplier")
    parent = F.when(F.col("s_suppkey") % 7 == 0, F.lit("none")) \
        .otherwise(F.pmod(F.col("s_suppkey"), F.lit(10)).cast("string"))
    base = s.select(F.col("s_suppkey").cast("string").alias("ctrr_code"),
                    parent.alias("ctrr_parent_vend_code"), F.col("s_name").alias("ctrr_name"))
    twin = s.filter(F.col("s_suppkey") % 11 == 0).select(
        F.col("s_suppkey").cast("string").alias("ctrr_code"),
        parent.alias("ctrr_parent_vend_code"), F.upper(F.col("s_name")).alias("ctrr_name"))
    return base.unionByName(twin)


VENDOR_HIERARCHY_SQL = """
ctrr AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS ctrr_code,
         CASE WHEN s_suppkey % 7 = 0 THEN 'none' ELSE CAST(s_suppkey % 10 AS VARCHAR) END AS ctrr_parent_vend_code,
         s_name AS ctrr_name
  FROM supplier
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR),
         CASE WHEN s_suppkey % 7 = 0 THEN 'none' ELSE CAST(s_suppkey % 10 AS VARCHAR) END, upper(s_name)
  FROM supplier WHERE s_suppkey % 11 = 0)"""


def month_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Month calendar over the months the orders span: label ``MON-YY``,
    fiscal year, month bounds, and a second pair of bounds shifted back five
    days (the calendar's other role)."""
    o = table(spark, sf, "orders")
    m = o.select(F.trunc(F.to_date("o_orderdate"), "month").alias("start_date")).distinct()
    fy = F.year(F.add_months(F.col("start_date"), -3))
    return m.select(
        F.upper(F.date_format("start_date", "MMM-yy")).alias("month"),
        F.concat(fy.cast("string"), F.lit("-"), (fy + 1).cast("string")).alias("fyear"),
        "start_date", F.last_day("start_date").alias("end_date"),
        F.date_sub("start_date", 5).alias("caln_start_date"),
        F.date_sub(F.last_day("start_date"), 5).alias("caln_end_date"))


MONTH_CALENDAR_SQL = """
cal AS (
  SELECT upper(strftime(start_date, '%b-%y')) AS month,
         CAST(year(start_date - INTERVAL 3 MONTH) AS VARCHAR) || '-'
           || CAST(year(start_date - INTERVAL 3 MONTH) + 1 AS VARCHAR) AS fyear,
         start_date, last_day(start_date) AS end_date,
         CAST(start_date - INTERVAL 5 DAY AS DATE) AS caln_start_date,
         CAST(last_day(start_date) - INTERVAL 5 DAY AS DATE) AS caln_end_date
  FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS start_date FROM orders))"""


def quantity_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of width 10 over the quantities present, plus the -1 band that
    catches null quantities."""
    li = table(spark, sf, "lineitem")
    b = li.select(F.floor(F.col("l_quantity") / 10).cast("int").alias("b")) \
        .filter(F.col("b").isNotNull()).distinct()
    bands = b.select(F.concat(F.lit("Q"), (F.col("b") * 10).cast("string"), F.lit("-"),
                              (F.col("b") * 10 + 9).cast("string")).alias("mile_desc"),
                     (F.col("b") * 10).alias("mile_start_km"),
                     (F.col("b") * 10 + 9).alias("mile_end_km"))
    unknown = spark.range(1).select(F.lit("UNKNOWN").alias("mile_desc"),
                                    F.lit(-1).alias("mile_start_km"), F.lit(-1).alias("mile_end_km"))
    return bands.unionByName(unknown)


QUANTITY_BANDS_SQL = """
mile AS (
  SELECT 'Q' || CAST(b * 10 AS VARCHAR) || '-' || CAST(b * 10 + 9 AS VARCHAR) AS mile_desc,
         b * 10 AS mile_start_km, b * 10 + 9 AS mile_end_km
  FROM (SELECT DISTINCT CAST(floor(l_quantity / 10) AS INTEGER) AS b FROM lineitem WHERE l_quantity IS NOT NULL)
  UNION ALL SELECT 'UNKNOWN', -1, -1)"""


def supply_receipts_src(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor receipts: supplier, part, part+flag item, yyyymm month, quantity
    (null on 7th lines)."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("venp_vend_code"),
        F.col("l_partkey").cast("string").alias("venp_root_part"),
        F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_returnflag")).alias("venp_item_code"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("venp_month"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(F.col("l_quantity"))
        .alias("venp_tot_recd_qty"))


SUPPLY_SQL = """
venp AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS venp_vend_code, CAST(l_partkey AS VARCHAR) AS venp_root_part,
         CAST(l_partkey AS VARCHAR) || '-' || l_returnflag AS venp_item_code,
         year(l_shipdate) * 100 + month(l_shipdate) AS venp_month,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS venp_tot_recd_qty
  FROM lineitem)"""


def audit_sources(spark: SparkSession, sf: str):
    """Audit header (orders), model master (nation), audit detail (lineitem),
    IQS codes (region)."""
    o = table(spark, sf, "orders")
    n = table(spark, sf, "nation")
    li = table(spark, sf, "lineitem")
    r = table(spark, sf, "region")
    chkm = o.select(
        F.col("o_orderkey").alias("chkm_chksht_no"),
        F.when(F.col("o_orderkey") % 2 == 0,
               F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")))
        .otherwise((F.col("o_custkey") % 5).cast("string")).alias("chkm_bveh_code"),
        F.col("o_orderdate").alias("chkm_audit_date"),
        F.when(F.col("o_orderstatus") == "F", "D").otherwise("E").alias("chkm_dom_exp"),
        F.when(F.col("o_orderpriority").startswith("1"), "Y").otherwise("N").alias("chkm_nissan"))
    qmmm = n.select(F.col("n_name").alias("qmmm_code"), F.col("n_regionkey").cast("string").alias("qmmm_family_model_code"),
                    F.when(F.col("n_nationkey") % 2 == 0, "O").otherwise("X").alias("qmmm_type"),
                    F.upper(F.concat(F.lit("m"), F.col("n_nationkey").cast("string"), F.lit("-"), F.col("n_name")))
                    .alias("qmmm_desc"))
    chkd = li.select(
        F.col("l_orderkey").alias("chkd_chksht_no"),
        F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")).alias("chkd_defect_code"),
        F.col("l_quantity").alias("chkd_factor_value"), F.col("l_linestatus").alias("chkd_defect_type"),
        F.col("l_suppkey").cast("string").alias("chkd_vend_code"),
        (F.col("l_linenumber") % 4).cast("string").alias("chkd_iqs_code"))
    cods = r.select(F.col("r_regionkey").cast("string").alias("cods_code"), F.col("r_name").alias("cods_desc"),
                    F.when(F.col("r_regionkey") != 2, "IQS").otherwise("OTHER").alias("cods_type"))
    return chkm, qmmm, chkd, cods


AUDIT_SQL = """
chkm AS (SELECT o_orderkey AS chkm_chksht_no,
                CASE WHEN o_orderkey % 2 = 0 THEN 'NATION_' || CAST(o_custkey % 25 AS VARCHAR)
                     ELSE CAST(o_custkey % 5 AS VARCHAR) END AS chkm_bveh_code,
                o_orderdate AS chkm_audit_date, CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE 'E' END AS chkm_dom_exp,
                CASE WHEN starts_with(o_orderpriority, '1') THEN 'Y' ELSE 'N' END AS chkm_nissan FROM orders),
qmmm AS (SELECT n_name AS qmmm_code, CAST(n_regionkey AS VARCHAR) AS qmmm_family_model_code,
                CASE WHEN n_nationkey % 2 = 0 THEN 'O' ELSE 'X' END AS qmmm_type,
                upper('m' || CAST(n_nationkey AS VARCHAR) || '-' || n_name) AS qmmm_desc FROM nation),
chkd AS (SELECT l_orderkey AS chkd_chksht_no, l_returnflag || CAST(l_linenumber AS VARCHAR) AS chkd_defect_code,
                l_quantity AS chkd_factor_value, l_linestatus AS chkd_defect_type,
                CAST(l_suppkey AS VARCHAR) AS chkd_vend_code, CAST(l_linenumber % 4 AS VARCHAR) AS chkd_iqs_code
         FROM lineitem),
cods AS (SELECT CAST(r_regionkey AS VARCHAR) AS cods_code, r_name AS cods_desc,
                CASE WHEN r_regionkey <> 2 THEN 'IQS' ELSE 'OTHER' END AS cods_type FROM region)"""


def spares_sources(spark: SparkSession, sf: str):
    """Invoice detail (lines with the order's customer), invoice header,
    customer, address (nation/region), item master (part, two companies)."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    p = table(spark, sf, "part")
    d = li.join(o.select("o_orderkey", "o_custkey"), li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("l_partkey").cast("string").alias("invd_item_code"), F.col("l_orderkey").alias("invd_invo_no"),
        (F.col("o_custkey") % 3).cast("string").alias("invd_cust_ccat_id"), F.col("o_custkey").alias("invd_cust_id"),
        F.when(F.col("l_linenumber") == 6, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("invd_qty"))
    h = o.select(F.col("o_orderkey").alias("invo_no"), F.to_date("o_orderdate").alias("invo_date"),
                 F.when(F.col("o_orderkey") % 3 == 0, "02").otherwise("01").alias("invo_comp_code"),
                 (F.col("o_custkey") % 3).cast("string").alias("invo_cust_ccat_id"), F.col("o_custkey").alias("invo_cust_id"))
    cust = c.select((F.col("c_custkey") % 3).cast("string").alias("cust_ccat_id"), F.col("c_custkey").alias("cust_id"))
    addr = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        (F.col("c_custkey") % 3).cast("string").alias("addr_cust_ccat_id"), F.col("c_custkey").alias("addr_cust_id"),
        F.col("n_name").alias("addr_city"), F.col("r_name").alias("addr_in_stat_id"))
    item = p.select(F.col("p_partkey").cast("string").alias("item_code"),
                    F.when(F.col("p_partkey") % 2 == 0, "01").otherwise("02").alias("item_comp_code"),
                    F.col("p_name").alias("item_desc"))
    return d, h, cust, addr, item


SPARES_SQL = """
invd AS (SELECT CAST(l_partkey AS VARCHAR) AS invd_item_code, l_orderkey AS invd_invo_no,
                CAST(o_custkey % 3 AS VARCHAR) AS invd_cust_ccat_id, o_custkey AS invd_cust_id,
                CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS invd_qty
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
invo AS (SELECT o_orderkey AS invo_no, CAST(o_orderdate AS DATE) AS invo_date,
                CASE WHEN o_orderkey % 3 = 0 THEN '02' ELSE '01' END AS invo_comp_code,
                CAST(o_custkey % 3 AS VARCHAR) AS invo_cust_ccat_id, o_custkey AS invo_cust_id FROM orders),
cust AS (SELECT CAST(c_custkey % 3 AS VARCHAR) AS cust_ccat_id, c_custkey AS cust_id FROM customer),
addr AS (SELECT CAST(c_custkey % 3 AS VARCHAR) AS addr_cust_ccat_id, c_custkey AS addr_cust_id, n_name AS addr_city,
                r_name AS addr_in_stat_id
         FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
item AS (SELECT CAST(p_partkey AS VARCHAR) AS item_code, CASE WHEN p_partkey % 2 = 0 THEN '01' ELSE '02' END AS item_comp_code,
                p_name AS item_desc FROM part)"""

# Extract windows for the spares analogue (the source's windows cover
# 2015-2023, the driver data 1995-2001; one fiscal year left out as there).
SPARES_WINDOWS_ANALOGUE = [("1995-04-01", "1996-03-31"), ("1996-04-01", "1997-03-31"),
                           ("1997-04-01", "1998-03-31"), ("1998-04-01", "1999-03-31"),
                           ("2000-04-01", "2001-03-31")]


def warranty_sources(spark: SparkSession, sf: str) -> dict:
    """Claim headers (orders), claim lines (line items), vehicle details
    (customers, with exact duplicates), dealers, part types, judge codes,
    shop-floor codes, plants (nations), model master and platform / part
    maps — all derived from the driver tables."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    p = table(spark, sf, "part")
    d = F.to_date("o_orderdate")
    k = F.col("o_orderkey")
    prio1 = F.substring("o_orderpriority", 1, 1)
    clam = o.select(
        k.alias("clam_issue_no"),
        F.when(k % 20 == 0, "X").otherwise("D").alias("clam_deind"),
        F.when(k % 97 == 0, F.lit("CTMT ")).otherwise(F.col("o_custkey").cast("string")).alias("clam_delr_cd"),
        F.lit("F").alias("clam_for_cd"), F.lit("O").alias("clam_outlet_cd"),
        F.col("o_orderstatus").alias("clam_dup_sl_no"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(prio1).alias("clam_shop_floor"),
        F.col("o_orderpriority").alias("clam_clam_type_dms"),
        F.when(k % 50 == 0, F.lit("I400")).otherwise((k % 100).cast("string")).alias("clam_vend_cd"),
        (F.col("o_custkey") % 30).cast("string").alias("clam_plant_no"),
        F.concat(F.lit("M"), (F.col("o_custkey") % 7).cast("string")).alias("clam_model_cd"),
        F.concat(F.lit("Y"), prio1, F.lit("X")).alias("clam_bveh_code"),
        F.col("o_custkey").cast("string").alias("clam_vin_no"),
        F.when(k % 13 == 0, "F01").otherwise("F00").alias("clam_judge_cd"),
        F.lit("DLR").alias("clam_war_party_type"),
        F.when(k % 9 == 0, F.lit(None).cast("int"))
        .otherwise(F.floor(F.col("o_totalprice") / 10000).cast("int")).alias("clam_odometer"),
        F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("clam_credit_amt"),
        F.date_sub(d, 30).alias("clam_register_dt"), d.alias("clam_repair_dt"), d.alias("clam_process_dt"),
        F.date_add(d, 10).alias("clam_fcok_date"), d.alias("clam_sratr_date"))
    clm2 = li.join(o.select("o_orderkey", "o_custkey"), li["l_orderkey"] == o["o_orderkey"]).select(
        F.lit("D").alias("clm2_deind"), F.col("o_custkey").cast("string").alias("clm2_delr_cd"),
        F.lit("F").alias("clm2_for_cd"), F.lit("O").alias("clm2_outlet_cd"),
        F.col("l_linestatus").alias("clm2_dup_sl_no"), F.col("l_orderkey").alias("clm2_issue_no"),
        F.when(F.col("l_returnflag") == "R", "X").when(F.col("l_returnflag") == "A", "L")
        .otherwise(F.lit(None).cast("string")).alias("clm2_casual_part"),
        F.col("l_partkey").cast("string").alias("clm2_part_no"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag"))
        .alias("clm2_part_type"))
    cid = F.col("c_custkey")
    vd1 = c.select(
        cid.cast("string").alias("vdtl_vin"),
        F.when(cid % 4 == 0, "petrol").when(cid % 4 == 1, "diesel").when(cid % 4 == 2, "cng")
        .otherwise("lpg").alias("vdtl_fuel"),
        F.when(F.col("c_acctbal") > 5000, "AT").otherwise("MT").alias("vdtl_tm_type"),
        F.when(cid % 5 == 0, F.lit(None).cast("string")).when(cid % 5 == 1, "K12").when(cid % 5 == 2, "D13")
        .when(cid % 5 == 3, "G12").otherwise("ZZ9").alias("vdtl_engi_prefix"),
        F.concat(F.col("c_mktsegment"), F.lit(" K12M G12X "), F.col("c_name")).alias("vdtl_pmod_desc"))
    vdtl = vd1.unionByName(vd1.filter(F.col("vdtl_vin").cast("int") % 10 == 0))
    dmdl = dealers(spark, sf).select("delr_cd", F.lit("F").alias("for_cd"), F.lit("O").alias("outlet_cd"),
                                     "city", "state", F.col("state").alias("region"))
    dmdl = dmdl.unionByName(dmdl)
    ptyp = li.select(F.col("l_returnflag").alias("ptyp_part_type")).distinct() \
        .withColumn("ptyp_part_desc", F.concat(F.lit("type "), F.col("ptyp_part_type"))) \
        .unionByName(spark.range(1).select(F.lit("X").alias("ptyp_part_type"),
                                           F.lit("unspecified").alias("ptyp_part_desc")))
    judg = o.select(F.concat(F.lit("F0"), (prio1.cast("int") - 1).cast("string")).alias("judg_cd")).distinct()
    shop = o.select(prio1.alias("code"), F.substring("o_orderpriority", 3, 20).alias("description")).distinct() \
        .unionByName(spark.range(1).select(F.lit("X").alias("code"), F.lit("UNASSIGNED").alias("description")))
    item = p.select(F.col("p_partkey").cast("string").alias("item_code"),
                    F.when(F.col("p_partkey") % 2 == 0, "01").otherwise("02").alias("item_comp_code"),
                    F.col("p_name").alias("item_desc"))
    wrpn = n.select(F.col("n_nationkey").cast("string").alias("wrpn_code"), F.col("n_name").alias("wrpn_desc"))
    modl = o.filter(F.col("o_custkey") % 7 != 3).select(
        F.concat(F.lit("M"), (F.col("o_custkey") % 7).cast("string")).alias("modl_wty_cd"),
        F.concat(F.lit("Y"), prio1, F.lit("X")).alias("modl_mktg_cd")).distinct() \
        .withColumn("modl_desc", F.concat(F.lit("MODEL "), F.col("modl_wty_cd"), F.lit("/"), F.col("modl_mktg_cd")))
    platform = o.select(F.concat(F.lit("Y"), prio1, F.lit("X")).alias("model"),
                        F.concat(F.lit("P"), prio1).alias("platform")).distinct() \
        .filter(F.col("model") != "Y5X").withColumn("ord", F.lit(0))
    partmap = p.filter(F.col("p_partkey") % 3 != 0).select(
        F.col("p_partkey").cast("string").alias("part_number"), F.upper("p_name").alias("part_name"),
        F.col("p_partkey").alias("ord"))
    return {"clam": clam, "clm2": clm2, "vdtl": vdtl, "dmdl": dmdl, "cal": month_calendar(spark, sf),
            "mile": quantity_bands(spark, sf), "ptyp": ptyp, "judg": judg, "ctrr": vendor_hierarchy(spark, sf),
            "shop": shop, "item": item, "wrpn": wrpn, "modl": modl, "platform": platform, "partmap": partmap}


WARRANTY_SQL = """
clam AS (SELECT o_orderkey AS clam_issue_no, CASE WHEN o_orderkey % 20 = 0 THEN 'X' ELSE 'D' END AS clam_deind,
       CASE WHEN o_orderkey % 97 = 0 THEN 'CTMT ' ELSE CAST(o_custkey AS VARCHAR) END AS clam_delr_cd,
       'F' AS clam_for_cd, 'O' AS clam_outlet_cd, o_orderstatus AS clam_dup_sl_no,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS clam_shop_floor,
       o_orderpriority AS clam_clam_type_dms,
       CASE WHEN o_orderkey % 50 = 0 THEN 'I400' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS clam_vend_cd,
       CAST(o_custkey % 30 AS VARCHAR) AS clam_plant_no, 'M' || CAST(o_custkey % 7 AS VARCHAR) AS clam_model_cd,
       'Y' || substr(o_orderpriority, 1, 1) || 'X' AS clam_bveh_code, CAST(o_custkey AS VARCHAR) AS clam_vin_no,
       CASE WHEN o_orderkey % 13 = 0 THEN 'F01' ELSE 'F00' END AS clam_judge_cd, 'DLR' AS clam_war_party_type,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 10000) AS INTEGER) END AS clam_odometer,
       CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS clam_credit_amt,
       CAST(o_orderdate AS DATE) - 30 AS clam_register_dt, CAST(o_orderdate AS DATE) AS clam_repair_dt,
       CAST(o_orderdate AS DATE) AS clam_process_dt, CAST(o_orderdate AS DATE) + 10 AS clam_fcok_date,
       CAST(o_orderdate AS DATE) AS clam_sratr_date FROM orders),
clm2 AS (SELECT 'D' AS clm2_deind, CAST(o_custkey AS VARCHAR) AS clm2_delr_cd, 'F' AS clm2_for_cd, 'O' AS clm2_outlet_cd,
       l_linestatus AS clm2_dup_sl_no, l_orderkey AS clm2_issue_no,
       CASE l_returnflag WHEN 'R' THEN 'X' WHEN 'A' THEN 'L' END AS clm2_casual_part,
       CAST(l_partkey AS VARCHAR) AS clm2_part_no,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS clm2_part_type
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
vd1 AS (SELECT CAST(c_custkey AS VARCHAR) AS vdtl_vin,
       CASE c_custkey % 4 WHEN 0 THEN 'petrol' WHEN 1 THEN 'diesel' WHEN 2 THEN 'cng' ELSE 'lpg' END AS vdtl_fuel,
       CASE WHEN c_acctbal > 5000 THEN 'AT' ELSE 'MT' END AS vdtl_tm_type,
       CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'K12' WHEN 2 THEN 'D13' WHEN 3 THEN 'G12' ELSE 'ZZ9' END
         AS vdtl_engi_prefix,
       c_mktsegment || ' K12M G12X ' || c_name AS vdtl_pmod_desc FROM customer),
vdtl AS (SELECT * FROM vd1 UNION ALL SELECT * FROM vd1 WHERE CAST(vdtl_vin AS INTEGER) % 10 = 0),
dm1 AS (SELECT CAST(c_custkey AS VARCHAR) AS delr_cd, 'F' AS for_cd, 'O' AS outlet_cd, n_name AS city,
       r_name AS state, r_name AS region
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dmdl AS (SELECT * FROM dm1 UNION ALL SELECT * FROM dm1),
ptyp AS (SELECT ptyp_part_type, 'type ' || ptyp_part_type AS ptyp_part_desc
         FROM (SELECT DISTINCT l_returnflag AS ptyp_part_type FROM lineitem) UNION ALL SELECT 'X', 'unspecified'),
judg AS (SELECT DISTINCT 'F0' || CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS VARCHAR) AS judg_cd
         FROM orders),
shop AS (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS code, substr(o_orderpriority, 3, 20) AS description FROM orders
         UNION ALL SELECT 'X', 'UNASSIGNED'),
item AS (SELECT CAST(p_partkey AS VARCHAR) AS item_code, CASE WHEN p_partkey % 2 = 0 THEN '01' ELSE '02' END
         AS item_comp_code, p_name AS item_desc FROM part),
wrpn AS (SELECT CAST(n_nationkey AS VARCHAR) AS wrpn_code, n_name AS wrpn_desc FROM nation),
modl AS (SELECT modl_wty_cd, modl_mktg_cd, 'MODEL ' || modl_wty_cd || '/' || modl_mktg_cd AS modl_desc
         FROM (SELECT DISTINCT 'M' || CAST(o_custkey % 7 AS VARCHAR) AS modl_wty_cd,
                      'Y' || substr(o_orderpriority, 1, 1) || 'X' AS modl_mktg_cd FROM orders WHERE o_custkey % 7 <> 3)),
platform AS (SELECT DISTINCT 'Y' || substr(o_orderpriority, 1, 1) || 'X' AS model,
             'P' || substr(o_orderpriority, 1, 1) AS platform FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5'),
partmap AS (SELECT CAST(p_partkey AS VARCHAR) AS part_number, upper(p_name) AS part_name FROM part WHERE p_partkey % 3 <> 0)"""


def line_defect_sources(spark: SparkSession, sf: str) -> dict:
    """Line defects (line items with order and part), model master (part),
    item master, cause codes (region), plants (nation), work centres."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    p = table(spark, sf, "part")
    r = table(spark, sf, "region")
    n = table(spark, sf, "nation")
    j = li.join(o.select("o_orderkey", "o_orderpriority", "o_custkey"), li["l_orderkey"] == o["o_orderkey"]) \
        .join(p.select("p_partkey", "p_type"), li["l_partkey"] == p["p_partkey"])
    ln = F.col("l_linenumber")
    vdes = j.select(
        F.concat(F.lit("Y"), F.substring("p_type", 1, 2), F.col("l_partkey").cast("string")).alias("vdes_semm_model_code"),
        F.col("l_shipdate").alias("vdes_creation_date"),
        F.concat(F.substring("o_orderpriority", 1, 4), (F.col("l_orderkey") % 50).cast("string")).alias("vdes_ctl_no"),
        F.when(ln % 3 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate")).alias("vdes_last_updated_on"),
        F.when(ln == 5, F.lit(None).cast("string")).when(F.col("l_returnflag") == "R", "X")
        .otherwise(F.col("l_linestatus")).alias("vdes_status"),
        F.col("l_partkey").cast("string").alias("vdes_item_part_no"),
        F.col("l_suppkey").cast("string").alias("vdes_ctrr_vend_code"),
        F.concat(F.lit("defect "), F.col("l_returnflag"), F.col("l_linestatus")).alias("vdes_prob_desc"),
        F.col("l_linestatus").alias("vdes_catg"),
        F.when(ln > 3, "Y").otherwise("N").alias("vdes_repeat_flag"),
        F.lpad((F.col("l_suppkey") % 7).cast("string"), 3, "0").alias("vdes_cause_code"),
        (F.col("o_custkey") % 30).cast("string").alias("vdes_psln_plant"),
        ln.cast("string").alias("vdes_section"))
    semm = p.select(
        F.concat(F.lit("Y"), F.substring("p_type", 1, 2), F.col("p_partkey").cast("string")).alias("semm_model_code"),
        F.when(F.col("p_partkey") % 9 == 0, F.lit(" "))
        .otherwise(F.concat(F.lit("Y"), F.substring("p_type", 1, 2), (F.col("p_size") % 10).cast("string")))
        .alias("semm_basic_model"))
    item = p.select(F.col("p_partkey").cast("string").alias("item_code"), F.col("p_name").alias("item_desc")) \
        .unionByName(p.filter(F.col("p_partkey") % 5 == 0).select(
            F.col("p_partkey").cast("string").alias("item_code"), F.upper("p_name").alias("item_desc")))
    dfcc = r.select(F.col("r_regionkey").cast("string").alias("dfcc_code"), F.col("r_name").alias("dfcc_desc"))
    wrpn = n.select(F.col("n_nationkey").cast("string").alias("wrpn_code"), F.col("n_name").alias("wrpn_desc"))
    l2 = li.select(F.col("l_linenumber").alias("k")).distinct()
    k = F.col("k")
    wc = l2.select(F.when(k == 1, "EN-body").when(k == 2, "QA").when(k == 3, " yo paint")
                   .when(k == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit("prod"), k.cast("string")))
                   .alias("wc_dept_code"),
                   F.concat(F.lit("WC"), k.cast("string")).alias("wc_name"), k.cast("string").alias("wc_rec_no"))
    return {"vdes": vdes, "semm": semm, "item": item, "dfcc": dfcc, "wrpn": wrpn, "wc": wc,
            "ctrr": vendor_hierarchy(spark, sf)}


LINE_DEFECT_SQL = """
vdes AS (SELECT 'Y' || substr(p_type, 1, 2) || CAST(l_partkey AS VARCHAR) AS vdes_semm_model_code,
       l_shipdate AS vdes_creation_date,
       substr(o_orderpriority, 1, 4) || CAST(l_orderkey % 50 AS VARCHAR) AS vdes_ctl_no,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate END AS vdes_last_updated_on,
       CASE WHEN l_linenumber = 5 THEN NULL WHEN l_returnflag = 'R' THEN 'X' ELSE l_linestatus END AS vdes_status,
       CAST(l_partkey AS VARCHAR) AS vdes_item_part_no, CAST(l_suppkey AS VARCHAR) AS vdes_ctrr_vend_code,
       'defect ' || l_returnflag || l_linestatus AS vdes_prob_desc, l_linestatus AS vdes_catg,
       CASE WHEN l_linenumber > 3 THEN 'Y' ELSE 'N' END AS vdes_repeat_flag,
       lpad(CAST(l_suppkey % 7 AS VARCHAR), 3, '0') AS vdes_cause_code,
       CAST(o_custkey % 30 AS VARCHAR) AS vdes_psln_plant, CAST(l_linenumber AS VARCHAR) AS vdes_section
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
semm AS (SELECT 'Y' || substr(p_type, 1, 2) || CAST(p_partkey AS VARCHAR) AS semm_model_code,
       CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE 'Y' || substr(p_type, 1, 2) || CAST(p_size % 10 AS VARCHAR) END
         AS semm_basic_model FROM part),
item AS (SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_name AS item_desc FROM part
         UNION ALL SELECT CAST(p_partkey AS VARCHAR), upper(p_name) FROM part WHERE p_partkey % 5 = 0),
dfcc AS (SELECT CAST(r_regionkey AS VARCHAR) AS dfcc_code, r_name AS dfcc_desc FROM region),
wrpn AS (SELECT CAST(n_nationkey AS VARCHAR) AS wrpn_code, n_name AS wrpn_desc FROM nation),
wc AS (SELECT CASE k WHEN 1 THEN 'EN-body' WHEN 2 THEN 'QA' WHEN 3 THEN ' yo paint' WHEN 4 THEN NULL
              ELSE 'prod' || CAST(k AS VARCHAR) END AS wc_dept_code, 'WC' || CAST(k AS VARCHAR) AS wc_name,
              CAST(k AS VARCHAR) AS wc_rec_no FROM (SELECT DISTINCT l_linenumber AS k FROM lineitem))"""
