"""Domain marts (composite plans) as reusable functions.

Each mart takes source DataFrames and parameters and returns the mart
DataFrame; writing it is the caller's (or :mod:`tessera.sinks`) job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import strings as S
from tessera.functions import values as V
from tessera.operators import aggregates as A
from tessera.operators import filters as FL


def production_volume(prod: DataFrame, as_of) -> DataFrame:
    """Monthly production volume per model and control point.

    F06 control-point pattern -> D09 year/month -> D04 label -> X01 model
    prefix -> P11 null-safe sum of the two quantities -> D03 serial id ->
    D02 session -> X07 location -> A01 group sum -> F01 code rule -> D08
    label back to a date -> P03 load time.
    """
    p = prod.filter(FL.code_pattern("pday_ctrlpt_number"))
    y, m = D.year_month("pday_date")
    p = p.select(
        D.month_label_my(m, y).alias("month_year"),
        S.prefix("pday_pmodel_code", 5).alias("model_code"),
        V.sum_measures("pday_quantity_a", "pday_quantity_b").alias("_qty"),
        D.serial_month(m, y).alias("serial_id"),
        D.fiscal_session_my(m, y).alias("session"),
        S.plant_group("pday_ctrlpt_number").alias("location"),
        F.col("pday_ctrlpt_number"))
    keys = ["month_year", "model_code", "serial_id", "session", "location", "pday_ctrlpt_number"]
    g = A.group_sum(p, keys, "_qty", out="count")
    g = g.withColumn("base_model_code", S.prefix("model_code", 3))
    g = FL.filter_codes(g, "model_code", "base_model_code")
    return g.select(
        D.parse_month_label("month_year").alias("month_year"),
        "model_code", F.col("serial_id").cast("int").alias("serial_id"), "session",
        F.round("count", 4).alias("count"),
        D.load_ts_text(as_of).alias("glue_last_updated"),
        "base_model_code", "location", "pday_ctrlpt_number")


def dispatch_sales(invc: DataFrame, dealers: DataFrame, as_of, spec_code: str) -> DataFrame:
    """Monthly dispatch quantity per model, city and state.

    J16 dealer lookup (last duplicate wins, ``Not_Found`` default) -> F03
    spec-code filter -> D09 -> D03 -> D04 -> X01 -> D02 -> A01 -> F01.
    """
    from tessera.operators import joins as J
    x = J.map_lookup(invc.filter(F.col("invc_spec_code") == spec_code), "invc_delr_code", dealers, "delr_cd",
                     ["city", "state"], ["City", "State"], order="ord", default="Not_Found")
    y, m = D.year_month("invc_date")
    x = x.select(
        D.serial_month(m, y).alias("serial_id"),
        D.month_label_my(m, y).alias("month_year"),
        S.prefix("invc_pmod_code", 5).alias("model_code"),
        F.col("invc_pmod_code").alias("model_code_full"),
        D.fiscal_session_my(m, y).alias("session"),
        "City", "State", "invc_qty")
    keys = ["serial_id", "month_year", "model_code", "model_code_full", "session", "City", "State"]
    g = A.group_sum(x, keys, "invc_qty", out="count", cast="bigint")
    g = g.withColumn("glue_last_updated", D.load_ts_text(as_of)) \
        .withColumn("base_model_code", S.prefix("model_code_full", 3))
    g = FL.filter_codes(g, "model_code_full", "base_model_code")
    return g.select("month_year", "model_code", "model_code_full",
                    F.col("serial_id").cast("int").alias("serial_id"), "count", "session",
                    "City", "State", "glue_last_updated", "base_model_code")


def supply_receipts(venp: DataFrame, ctrr: DataFrame, as_of) -> DataFrame:
    """Monthly vendor receipts.

    P01 rename -> F08 not-null quantity -> A03 distinct -> J11 vendor parent
    name (one per code, so after the distinct) -> D09 year/month from ``yyyymm``
    -> D04 label -> D03 serial id -> P03 load time.
    """
    from tessera.operators import joins as J
    x = venp.select(F.col("venp_vend_code").alias("vendor_code"),
                    F.col("venp_root_part").alias("root_part_number"),
                    F.col("venp_item_code").alias("part_number"), "venp_month",
                    F.col("venp_tot_recd_qty").alias("count"))
    x = A.distinct_rows(FL.not_null(x, ["count"]), venp.count())
    x = J.resolve_parent(x, "vendor_code", ctrr, "ctrr_code", "ctrr_parent_vend_code",
                         "ctrr_name", "vendor_name")
    y, m = D.year_month_from_yyyymm("venp_month")
    return x.select("part_number", "root_part_number", "count", "vendor_name", "vendor_code",
                    D.month_label_my(m, y).alias("month_year"), D.serial_month(m, y).alias("serial_id"),
                    D.load_ts_text(as_of).alias("glue_last_updated"))


def audit_findings(chkm: DataFrame, qmmm: DataFrame, chkd: DataFrame, ctrr: DataFrame,
                   cods: DataFrame, as_of, lo: str, hi: str) -> DataFrame:
    """Audit findings.

    J07 OR join of header to model master (two equi-joins) with a type
    filter -> J08 left-join chain (detail, vendor, codes) whose WHERE makes
    it inner -> F03 date window -> X16 model label -> P01 -> X01 -> P03 ->
    D01 session -> D05 month label.
    """
    from tessera.operators import joins as J
    g = qmmm.filter(F.col("qmmm_type") == "O")
    m = J.or_join(chkm, g, "chkm_bveh_code", ("qmmm_code", "qmmm_family_model_code"))
    m = m.filter(F.to_date("chkm_audit_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    x = m.join(chkd, m["chkm_chksht_no"] == chkd["chkd_chksht_no"], "left") \
        .join(ctrr.select("ctrr_code", "ctrr_name"), F.col("ctrr_code") == F.col("chkd_vend_code"), "left") \
        .join(cods, F.col("cods_code") == F.col("chkd_iqs_code"), "left") \
        .filter((F.col("chkd_iqs_code") != "3") & (F.col("cods_type") == "IQS"))
    model = S.model_label("qmmm_desc", F.col("chkm_dom_exp") == "D", F.col("chkm_nissan") == "Y")
    return x.select(S.prefix(model, 3).alias("model"), F.col("chkm_audit_date").alias("audit_date"),
                    F.col("chkd_defect_code").alias("def_code"), F.col("chkd_factor_value").alias("dmt"),
                    F.col("chkd_defect_type").alias("nature_of_defect"), F.col("ctrr_name").alias("vendor"),
                    D.load_ts_text(as_of).alias("glue_last_updated"),
                    D.fiscal_session("chkm_audit_date").alias("session"),
                    D.month_year("chkm_audit_date").alias("pmonth_year"))


def spares_sales(invd: DataFrame, invo: DataFrame, cust: DataFrame, addr: DataFrame,
                 item: DataFrame, as_of, windows) -> DataFrame:
    """Spares sales.

    U05 one scan over the union of fiscal windows -> J14 four-way join on
    composite keys -> J13 correlated max keyed by detail and header columns
    -> P07 null quantity 0 -> D01 session -> P03 load time.
    """
    from tessera.operators import joins as J
    from tessera.operators import sets as U
    h = U.read_windows(invo, "invo_date", [(F.lit(a).cast("date"), F.lit(b).cast("date")) for a, b in windows])
    x = invd.join(h, (invd["invd_cust_ccat_id"] == h["invo_cust_ccat_id"]) & (invd["invd_cust_id"] == h["invo_cust_id"])
                  & (invd["invd_invo_no"] == h["invo_no"])) \
        .join(cust, (F.col("invo_cust_ccat_id") == cust["cust_ccat_id"]) & (F.col("invo_cust_id") == cust["cust_id"])) \
        .join(addr, (F.col("cust_ccat_id") == addr["addr_cust_ccat_id"]) & (F.col("cust_id") == addr["addr_cust_id"]))
    x = J.scalar_max(x, item, {"invd_item_code": "item_code", "invo_comp_code": "item_comp_code"},
                     "item_desc", "item_name")
    return x.select("invd_item_code", "item_name", F.col("invo_date").alias("invoice_date"),
                    F.coalesce(F.col("invd_qty"), F.lit(0.0)).alias("sale_qty"),
                    F.col("addr_city").alias("City"), F.col("addr_in_stat_id").alias("State"),
                    D.load_ts_text(as_of).alias("glue_last_updated"),
                    D.fiscal_session("invo_date").alias("session"))


WARRANTY_OUT = [
    "clam_issue_no", "ptyp_part_type", "clam_odometer", "clam_shop_floor", "clam_clam_type_dms",
    "clam_repair_dt", "clam_sratr_date", "fyear", "ptyp_part_desc", "month", "city", "state",
    "vendor_name", "clam_vend_cd", "mile_desc", "shop_flr_cd", "defect_resp", "clm2_casual_part",
    "clm2_part_no", "region", "plant", "fcok_month", "fcok_year", "clam_fcok_date",
    "clam_process_dt", "model_dsec", "modl_service_code", "vdtl_fuel", "vdtl_tm_type",
    "vdtl_engi_prefix", "vdtl_pmod_desc", "clam_credit_amt", "days_used"]


def warranty_claims(src: dict, as_of, window=("2016-04-01", "2035-03-31"), deind="D",
                    judge="F00", party="DLR", deny_dealer="CTMT", deny_vendor="I400") -> DataFrame:
    """Warranty claims mart.

    Claim filters (F03 F04 F05) -> J01 claim x line on six keys with J10 the
    causal-line pick (per-group line count pre-aggregated) -> J02 vehicle
    detail (distinct) -> dealer (distinct) -> J03 two role-playing calendar
    range joins -> J04 mileage band on ``coalesce(odometer, -1)`` -> J05 part
    type on a defaulted key -> J06 judge-code existence -> J11 vendor parent
    name -> J12 scalar lookups (shop floor, part name, plant, model) -> D11
    -> A03 distinct -> D06 year expansion -> X01 base model -> J16 platform
    and part-name maps -> X08 engine type -> P03 load time -> P04 uid.
    Every dimension join is an equi-join (range/band via buckets); the
    dimensions are broadcast only after a size check.
    """
    from tessera.operators import joins as J
    from tessera.operators import projections as P
    c = src["clam"]
    c = c.filter(c["clam_process_dt"].between(F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date"))
                 & (F.col("clam_deind") == deind) & (F.col("clam_judge_cd") == judge)
                 & (F.col("clam_war_party_type") == party)
                 & FL.trim_ne("clam_delr_cd", deny_dealer) & F.trim("clam_delr_cd").isNotNull()
                 & FL.trim_ne("clam_vend_cd", deny_vendor) & F.trim("clam_vend_cd").isNotNull()
                 & FL.numeric_gt("clam_credit_amt", 0))
    keys_c = ["clam_deind", "clam_delr_cd", "clam_for_cd", "clam_outlet_cd", "clam_dup_sl_no", "clam_issue_no"]
    keys_l = ["clm2_deind", "clm2_delr_cd", "clm2_for_cd", "clm2_outlet_cd", "clm2_dup_sl_no", "clm2_issue_no"]
    x = J.pick_causal_line(c, src["clm2"], keys_c, keys_l,
                           ["clam_delr_cd", "clam_for_cd", "clam_outlet_cd", "clam_issue_no"],
                           ["clm2_delr_cd", "clm2_for_cd", "clm2_outlet_cd", "clm2_issue_no"],
                           "clm2_casual_part", multi_flags=("X",), single_flags=("X", "L"))
    vd = src["vdtl"].distinct()
    x = x.join(vd, x["clam_vin_no"] == vd["vdtl_vin"], "left")
    # dealers grow with the business: no hint, the planner / AQE decide
    dm = src["dmdl"].distinct()
    x = x.join(dm, (x["clam_delr_cd"] == dm["delr_cd"]) & (x["clam_for_cd"] == dm["for_cd"])
               & (x["clam_outlet_cd"] == dm["outlet_cd"]))
    cal = src["cal"].distinct()
    # calendar, bands, part types: bounded by construction (months spanned,
    # value bands, code lists) -> broadcast without a counting job
    fc = F.broadcast(cal.select(F.col("month").alias("fcok_month"), F.col("fyear").alias("fcok_year"),
                                "caln_start_date", "caln_end_date"))
    x = J.range_join(x, fc, "clam_fcok_date", "caln_start_date", "caln_end_date", bounds=c)
    mn = F.broadcast(cal.select("month", "fyear", "start_date", "end_date"))
    x = J.range_join(x, mn, "clam_process_dt", "start_date", "end_date", bounds=c)
    x = J.band_join(x, F.broadcast(src["mile"].distinct()), "clam_odometer", "mile_start_km",
                    "mile_end_km", null_as=-1, bounds=c)
    x = J.join_default_key(x, F.broadcast(src["ptyp"]), "clm2_part_type", "ptyp_part_type", "X")
    x = J.semi_join(x, src["judg"], "clam_judge_cd", "judg_cd")
    x = J.resolve_parent(x, "clam_vend_cd", src["ctrr"], "ctrr_code", "ctrr_parent_vend_code", "ctrr_name",
                         "vendor_name")
    x = x.withColumn("shop_flr_cd", F.coalesce(F.col("clam_shop_floor"), F.lit("X")))
    x = J.scalar_lookup(x, src["shop"], {"shop_flr_cd": "code"}, "description", "defect_resp")
    x = J.scalar_lookup(x, src["wrpn"], {"clam_plant_no": "wrpn_code"}, "wrpn_desc", "plant")
    mk = {"clam_model_cd": "modl_wty_cd", "clam_bveh_code": "modl_mktg_cd"}
    x = J.scalar_lookup(x, src["modl"], mk, ["modl_desc", "modl_mktg_cd"], ["model_dsec", "modl_service_code"],
                        distinct=True)
    x = x.withColumn("days_used", D.days_used("clam_register_dt", "clam_repair_dt"))
    x = x.select(*WARRANTY_OUT).distinct()
    x = x.withColumn("month", D.expand_year("month")) \
        .withColumn("fcok_month", D.expand_year("fcok_month")) \
        .withColumn("base_model_code", S.prefix("modl_service_code", 3))
    x = J.map_lookup(x, "base_model_code", src["platform"], "model", "platform", "platform", order="ord")
    x = x.withColumn("vdtl_engi_prefix", F.coalesce(F.col("vdtl_engi_prefix"), F.lit("XXX"))) \
        .withColumn("engine_type", S.engine_type("vdtl_engi_prefix", "vdtl_pmod_desc"))
    x = J.map_lookup(x, "clm2_part_no", src["partmap"], "part_number", "part_name", "causal_part_name",
                     order="ord", default="")
    x = x.withColumn("glue_last_updated", D.load_ts_text(as_of))
    return P.with_uid(x, WARRANTY_OUT + ["base_model_code", "platform", "engine_type", "causal_part_name"],
                      as_of)


LINE_OUT = ["model_code", "part_number", "part_name", "vendor_code", "vendor_name", "observation",
            "defect_category", "rep_defect", "causes_category", "plant", "pmonth_year", "session", "month",
            "glue_last_updated", "defect_resp", "wc_dept_code", "wc_name", "wc_rec_no", "base_model_code",
            "date", "control_no", "last_update_on", "line_status", "location"]


def line_defects(src: dict, as_of) -> DataFrame:
    """In-line defect register.

    A02 max item name per code -> J11 vendor parent name (over the distinct
    vendor codes) -> J09 six-way left-join star incl. an integer-cast text
    key -> D05 month label/name -> D01 session -> P08/P09 blank model code
    filled from the full code -> W04/W08 keep rows unique on (date, control
    no) or updated -> F02 drop status X keeping nulls -> X04 responsibility
    -> X01 base model -> F08 -> F01 -> X06 location -> P01 projection.
    """
    from tessera.operators import aggregates as A
    from tessera.operators import joins as J
    from tessera.operators import windows as W
    v = src["vdes"]
    item = A.max_per_key(src["item"], "item_code", "item_desc")
    vend = J.resolve_parent(v.select(F.col("vdes_ctrr_vend_code").alias("vendor_code")).distinct(),
                            "vendor_code", src["ctrr"], "ctrr_code", "ctrr_parent_vend_code", "ctrr_name",
                            "vend_name").distinct()
    x = v.join(src["semm"], v["vdes_semm_model_code"] == src["semm"]["semm_model_code"], "left") \
        .join(item, v["vdes_item_part_no"] == item["item_code"], "left")
    x = J.join_cast_key(x, src["dfcc"], "vdes_cause_code", "dfcc_code", how="left")
    x = x.join(vend, x["vdes_ctrr_vend_code"] == vend["vendor_code"], "left") \
        .join(src["wrpn"], x["vdes_psln_plant"] == src["wrpn"]["wrpn_code"], "left") \
        .join(src["wc"], x["vdes_section"] == src["wc"]["wc_rec_no"], "left")
    x = x.select(F.col("semm_basic_model").alias("model_code"), F.col("semm_model_code").alias("full_model_code"),
                 F.col("vdes_creation_date").alias("date"), F.col("vdes_ctl_no").alias("control_no"),
                 F.col("vdes_last_updated_on").alias("last_update_on"), F.col("vdes_status").alias("line_status"),
                 F.col("vdes_item_part_no").alias("part_number"), F.col("item_desc").alias("part_name"),
                 F.col("vdes_ctrr_vend_code").alias("vendor_code"), F.col("vend_name").alias("vendor_name"),
                 F.col("vdes_prob_desc").alias("observation"), F.col("vdes_catg").alias("defect_category"),
                 F.col("vdes_repeat_flag").alias("rep_defect"), F.col("dfcc_desc").alias("causes_category"),
                 F.col("wrpn_desc").alias("plant"), "wc_dept_code", "wc_name", "wc_rec_no")
    x = x.withColumn("pmonth_year", D.month_year("date")).withColumn("session", D.fiscal_session("date")) \
        .withColumn("model_code", V.fill_from("model_code", "full_model_code", 5)).drop("full_model_code") \
        .withColumn("month", D.month_name("date"))
    x = W.dedup_prefer_updated(x, ["date", "control_no"], "last_update_on")
    x = FL.exclude_keep_null(x, "line_status", ["X"])
    x = x.withColumn("glue_last_updated", D.load_ts_text(as_of)) \
        .withColumn("defect_resp", S.responsibility("wc_dept_code")) \
        .withColumn("base_model_code", S.prefix("model_code", 3))
    x = FL.filter_codes(x, "model_code", "base_model_code")
    x = x.withColumn("location", S.location("control_no"))
    return x.select(*LINE_OUT)


def _with_parts(df: DataFrame, key: str, text: str, parts: DataFrame) -> DataFrame:
    from tessera.operators import text as TX
    m = TX.match_part(df.select(key, text), key, text, parts, "p_name", "p_partkey")
    return df.join(m, key, "left")


def field_reports(reports: DataFrame, obs: DataFrame, partmap: DataFrame, as_of) -> DataFrame:
    """Field technical reports.

    S05 appended files (caller) -> P01 -> J16 part name by number (default
    ``''``) -> X15 keyword lists -> C02 subject -> observation type -> D01 ->
    D05 -> P04 uid -> X03 mileage/days digits -> X04 -> X01 -> F08 -> F01.
    """
    from tessera.operators import joins as J
    from tessera.operators import projections as P
    from tessera.operators import text as TX
    x = J.map_lookup(reports, "causal_parts_no", partmap, "part_number", "part_name",
                     "causal_parts_name_english", order="ord", default="")
    x = x.withColumn("subject_english", F.coalesce(F.col("subject_english"), F.lit("")))
    cls = TX.classify_text(x.select("sbpr_no", "subject_english"), "sbpr_no", "subject_english",
                           obs, "observation_type", "keywords", out_label="_obs", out_score="_obs_score")
    x = x.join(cls, "sbpr_no", "left").withColumn("subject_english", F.col("_obs")).drop("_obs", "_obs_score")
    x = x.withColumn("session", D.fiscal_session("date_of_incident")) \
        .withColumn("glue_last_updated", D.load_ts_text(as_of)) \
        .withColumn("pmonth_year", D.month_year("date_of_incident"))
    x = P.with_uid(x, ["sbpr_no"], as_of)
    x = x.withColumn("mileage", S.digits("mileage_using_time")).withColumn("days", S.digits("days_used")) \
        .withColumn("defect_response", S.responsibility("Defect_resp")) \
        .withColumn("base_model_code", S.prefix("product_model_code", 3))
    x = FL.not_null(x, ["product_model_code"])
    return FL.filter_codes(x, "product_model_code", "base_model_code")


def change_notes(notes: DataFrame, parts: DataFrame, as_of) -> DataFrame:
    """Engineering change notes: C03 part from the change text -> X02 dash at
    position 6 dropped from both part numbers -> D01 -> P03."""
    x = _with_parts(notes, "ecn_no", "contents_of_change", parts)
    return x.withColumn("part_num_1", S.remove_dash("part_num_1")) \
        .withColumn("part_num_2", S.remove_dash("part_num_2")) \
        .withColumn("session", D.fiscal_session("reg_dt")) \
        .withColumn("glue_last_updated", D.load_ts_text(as_of))


def problem_register(rows: DataFrame, key: str, text: str, parts: DataFrame, obs: DataFrame, as_of,
                     keep) -> DataFrame:
    """Past-problem / supplier-quality registers: C03 part name, score and
    number, C02 observation type (and its category), P01, P03, X01."""
    from tessera.operators import text as TX
    x = _with_parts(rows, key, text, parts).withColumnRenamed("part_score", "pn_pred_score")
    cls = TX.classify_text(rows.select(key, text), key, text, obs, "observation_type", "keywords",
                           out_label="observation_type", out_score="_s").drop("_s")
    x = x.join(cls, key, "left").join(obs.select("observation_type", "category"), "observation_type", "left")
    x = x.withColumn("glue_last_updated", D.load_ts_text(as_of)) \
        .withColumn("base_model_code", S.prefix("model_code", 3))
    return x.select(*keep, "part_name", "pn_pred_score", "part_number", "observation_type", "category",
                    "glue_last_updated", "base_model_code")


def problem_reports(reports: DataFrame, labels: DataFrame, docs: DataFrame, items: DataFrame, vendors: DataFrame,
                    obs: DataFrame, as_of) -> DataFrame:
    """Summary problem reports.

    J15 left merges on differently named keys with full-row dedup (labels, documents,
    item descriptions, vendor codes) -> D08 date text parsed (bad -> null) -> W07
    forward fill in report order -> X01 -> P12 text of several columns -> C02
    observation type with its category -> X04 -> X02 -> D01 -> P04 uid.
    """
    from tessera.operators import joins as J
    from tessera.operators import projections as P
    from tessera.operators import text as TX
    from tessera.operators import windows as W
    x = J.left_merge_dedup(reports, labels, "conv_id", "label_doc")
    x = J.left_merge_dedup(x, docs, "conv_id", "doc_key")
    x = J.left_merge_dedup(x, items, "item_no", "item_code")
    x = J.left_merge_dedup(x, vendors, "supplier", "vendor_name")
    x = x.withColumn("date", F.to_date(D.parse_date("date_txt", ("dd/MM/yyyy",))))
    x = W.ffill(x, "date", ["conv_id", "turn"])
    x = x.withColumn("model_code", S.prefix("part_no", 3)).withColumn("all", S.join_text("role", "text"))
    cls = TX.classify_text(x.select("report_id", "all"), "report_id", "all", obs, "observation_type",
                           "keywords", out_label="observation_type", out_score="obs_score")
    x = x.join(cls, "report_id", "left") \
        .join(obs.select("observation_type", "category").distinct(), "observation_type", "left") \
        .withColumn("defect_resp", S.responsibility("dept")) \
        .withColumn("part_number", S.remove_dash("part_no")) \
        .withColumn("session", D.fiscal_session("date"))
    x = P.with_uid(x, ["conv_id", "turn"], as_of)
    return x.select("report_id", "conv_id", "turn", "date", "part_number", "model_code", "observation_type",
                    "category", "obs_score", "defect_resp", F.col("item_desc").alias("part_name"), "vendor_code",
                    "session", "uid", "quality", "toxic", "lang")


def defect_log(raw: DataFrame, key: str, text: str, parts: DataFrame, obs: DataFrame, as_of) -> DataFrame:
    """In-plant defect log: X18 column names cleaned -> X04 -> C03 -> C02 ->
    D01 -> D05 -> X01."""
    from tessera.operators import text as TX
    x = raw.toDF(*S.clean_columns_names(raw.columns))
    x = x.withColumn("defect_resp", S.responsibility("resp_dept"))
    x = _with_parts(x, key, text, parts)
    cls = TX.classify_text(x.select(key, text), key, text, obs, "observation_type", "keywords",
                           out_label="observation_type", out_score="obs_score")
    x = x.join(cls, key, "left").withColumn("session", D.fiscal_session("found_on")) \
        .withColumn("pmonth_year", D.month_year("found_on")).withColumn("base_model_code", S.prefix("model_code", 3))
    return x.drop(text)


# Fuel names searched in social posts.
FUEL_NAMES = ["petrol", "diesel", "cng", "lpg"]


def social_features(posts: DataFrame, props: DataFrame, model_terms: DataFrame, model_canon: DataFrame,
                    model_cat: DataFrame, part_terms: DataFrame, part_cat: DataFrame, channels,
                    stop_words=None) -> DataFrame:
    """Social posts, feature part.

    F07 language ``en`` and channel list -> X10 clean text -> X11 model /
    part / fuel terms (leftmost term, canonical name, category; all null when
    a step misses) -> M01 keys of the property map -> M02 sentiment -> X12
    owner falls back to the folder -> F09 spam flag.
    """
    from tessera.operators import text as TX
    from tessera.session import cut_lineage
    p = FL.filter_channel(posts, "sn_type", channels, lang_col="language", lang="en")
    p = p.withColumn("tokens", S.clean_tokens("message", stop_words)) \
        .withColumn("processed_text", F.array_join("tokens", " "))
    # the cleaned posts feed four term searches and the output: clean once
    p = cut_lineage(p)
    m = TX.extract_term(p, "post_id", F.col("tokens"), model_terms, "term", "tpos")
    # a term without a canonical entry keeps its own name; any step that misses
    # (category, owner) nulls all three
    m = m.join(model_canon, "term", "left").withColumn("model_name", F.coalesce("model_name", "term")) \
        .join(model_cat, "model_name", "left")
    hit = F.col("vehicle_category").isNotNull() & F.col("real_oem").isNotNull()
    m = m.select("post_id", *[F.when(hit, F.col(c)).alias(c) for c in ("model_name", "vehicle_category", "real_oem")])
    pt = TX.extract_term(p, "post_id", F.col("tokens"), part_terms, "term", "tpos") \
        .join(part_cat, "term", "left") \
        .select("post_id", F.when(F.col("part_name_category").isNull(), F.lit(None).cast("string"))
                .otherwise(F.col("term")).alias("part_name"),
                F.when(F.col("part_name_category").isNull(), F.lit(None).cast("string"))
                .otherwise(F.col("part_name_type")).alias("part_name_type"), "part_name_category")
    names = F.array(*map(F.lit, FUEL_NAMES))
    fuel_terms = p.sparkSession.range(len(FUEL_NAMES)).select(F.get(names, F.col("id").cast("int")).alias("term"), F.col("id").alias("tpos"))
    fu = TX.extract_term(p, "post_id", F.col("tokens"), fuel_terms, "term", "tpos") \
        .withColumnRenamed("term", "fuel_type")
    p = p.join(m, "post_id", "left").join(pt, "post_id", "left").join(fu, "post_id", "left")
    p = p.join(props, "post_id", "left")
    p = p.withColumn("sentiment", V.norm_sentiment(V.json_get("workflow_properties", "sentiment"))) \
        .withColumn("is_spam", V.json_get("workflow_properties", "isSpam")) \
        .withColumn("is_profane", V.json_get("workflow_properties", "isProfane")) \
        .withColumn("message_category", V.json_get("workflow_properties", "messageCategory")) \
        .withColumn("oem", S.owner("real_oem", "folder_name")) \
        .withColumn("filter_flag", FL.spam_flag("message"))
    # staged boundary (the source writes the features as staged files before
    # scoring and loading): materialise once in the shared checkpoint folder
    return cut_lineage(p.drop("workflow_properties", "tokens"))


def social_scores(feat: DataFrame, phrases: DataFrame, n_phrases: DataFrame, vector_scores: DataFrame,
                  n_classes: int, weights: dict, masks: DataFrame, vocab: DataFrame) -> DataFrame:
    """Only gated posts (F10) are scored; category (masked by the part
    category) and feedback tasks blend the phrase score (C04) of the post's
    top keywords (C06), the better of their raw and spelling-corrected (C05,
    ``vocab``: word, position, keyword flag) forms, and the caller's vector scores (C08: post_id, cls,
    score); ungated posts keep null predictions (left join back)."""
    from tessera.operators import text as TX
    gated = feat.filter(FL.score_gate("model_name", "part_name", "filter_flag", "sentiment")) \
        .select("post_id", "processed_text", "part_name_category")
    kw = TX.top_keywords(gated, "post_id", F.split("processed_text", " "), k=20)
    toks = kw.select("post_id", F.explode(F.split("keywords", ", ")).alias("token"))
    fixed = TX.correct_words_postings(toks, "token", vocab, "v", "vp", vocab.filter("is_kw"), "v")
    corrected = toks.join(fixed, "token").select("post_id", F.col("corrected").alias("token"))
    # both forms of a post scored in one pass, the better kept
    forms = toks.withColumn("form", F.lit(0)).unionByName(corrected.withColumn("form", F.lit(1))) \
        .select(F.struct("post_id", "form").alias("post"), "token")
    ps = TX.phrase_scores(forms, "post", "token", phrases, "cls", "phrase", "pword", n_phrases) \
        .groupBy(F.col("post.post_id").alias("post_id"), "cls").agg(F.max("max_score").alias("max_score"))
    vec = vector_scores.select("post_id", F.col("cls").cast("int").alias("cls"), F.col("score").alias("vec")) \
        .join(gated.select("post_id"), "post_id", "left_semi")
    classes = feat.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("cls"), F.col("id").alias("pos"))
    allowed = gated.join(masks, "part_name_category").select("post_id", "cls")
    out = gated.select("post_id")
    for task, mask in (("category", allowed), ("feedback", None)):
        w1, w2 = weights[task]
        pred = TX.blend_predict(ps.withColumn("cls", F.col("cls").cast("int")), vec, "post_id", "cls",
                                "max_score", "vec", w1, w2, classes, "pos", mask)
        pred = gated.select("post_id").join(pred, "post_id", "left").select(
            "post_id", F.coalesce("label", F.lit(0)).alias(f"{task}_label"),
            F.round(F.coalesce("score", F.lit(0.0)), 6).alias(f"{task}_score"))
        out = out.join(pred, "post_id")
    return feat.join(out, "post_id", "left")


SOCIAL_SCHEMA = [("id", "string"), ("post_id", "bigint"), ("oem", "string"), ("sn_type", "string"),
                 ("message", "string"), ("processed_text", "string"), ("sn_created_time", "timestamp_ntz"),
                 ("model_name", "string"), ("vehicle_category", "string"), ("part_name", "string"),
                 ("part_name_category", "string"), ("part_name_type", "string"), ("fuel_type", "string"),
                 ("sentiment", "int"), ("is_spam", "string"), ("is_profane", "string"),
                 ("message_category", "string"), ("folder_name", "string"), ("real_oem", "string"),
                 ("filter_flag", "int"), ("category_label", "int"), ("category_score", "double"),
                 ("feedback_label", "int"), ("feedback_score", "double"), ("permalink", "string"),
                 ("sn_created_time_month", "date"), ("session", "string"), ("glue_last_updated", "string")]


def social_load(scored: DataFrame, as_of, text_len: int = 4000, link_len: int = 255) -> DataFrame:
    """Social posts, load part: P05 deterministic row id -> D10 month start
    -> D01 -> P02 declared types -> X09 byte-bounded trims -> W05 keep one
    row per message (largest id; null messages untouched) -> U07 redaction
    of neutral posts up to 12 months old and of all older posts."""
    from pyspark.sql import types as T

    from tessera.operators import projections as P
    from tessera.operators import sets as U
    from tessera.operators import windows as W
    x = P.with_row_id(scored, ["post_id", "folder_name"], name="id")
    x = x.withColumn("glue_last_updated", D.load_ts_text(as_of)) \
        .withColumn("sn_created_time_month", D.month_start("sn_created_time")) \
        .withColumn("session", D.fiscal_session("sn_created_time")) \
        .withColumn("filter_flag", F.col("filter_flag").cast("int"))
    x = x.withColumn("message", S.trim_escaped("message", text_len)) \
        .withColumn("processed_text", S.trim_escaped("processed_text", text_len)) \
        .withColumn("permalink", F.substring(F.col("permalink").cast("string"), 1, link_len))
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in SOCIAL_SCHEMA])
    x = P.apply_schema(x, schema)
    x = W.dedup_keep_max(x, "message", "id")
    return U.redact(x, "sn_created_time", "sentiment", ["message", "processed_text"], as_of)
