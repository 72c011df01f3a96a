"""Registered model-operations queries (E*, Z18-Z20) with DuckDB oracle SQL
where the computation has an SQL form."""

from __future__ import annotations

import inspect
import json

from pyspark.sql import functions as F

from tessera import sinks as K
from tessera import sources as SR
from tessera.operators import models as MO
from tessera.operators import quality as Q
from tessera.plans.q_io import scratch
from tessera.plans.registry import query
from tessera.session import cut_lineage, table, written

TOP_N = 200  # fixed value
CATEGORICAL = ["p_type", "l_returnflag"]


def features(spark, sf):
    """Feature rows: one per line item, with part name, region, categorical
    columns, quantity and a probability-like label."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    # orders get their region first: lines are dealt twice (by part and by order), not by customer too
    places = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select("c_custkey", "r_name")
    placed = o.join(places, o["o_custkey"] == places["c_custkey"]).select("o_orderkey", "o_orderpriority", "r_name")
    j = li.join(p, li["l_partkey"] == p["p_partkey"]).join(placed, li["l_orderkey"] == placed["o_orderkey"])
    return j.select("l_orderkey", "l_linenumber", F.col("p_name").alias("part_name"),
                    F.col("r_name").alias("region"), "p_type", "l_returnflag", "o_orderpriority",
                    F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
                    (F.col("l_discount") * 10).alias("part_probability"),
                    (((F.col("l_orderkey") + F.col("l_linenumber")) % 10) == 0).alias("is_test"))


def kept(spark, df, name: str = "features"):
    """Rows that several passes read, joined and written once in the shared folder."""
    return written(df, scratch(spark, name))


def keyed_features(spark, sf, *more):
    """Features with their model keys and the columns of a run, joined once."""
    f = MO.with_keys(features(spark, sf), "part_name", "region")
    return kept(spark, f.select(*KEYS, "l_orderkey", "l_linenumber", "qty", "part_probability", *more))


FEATURES_SQL = """
feat AS (
  SELECT l_orderkey, l_linenumber, p_name AS part_name, r_name AS region, p_type, l_returnflag, o_orderpriority,
         l_quantity AS qty, l_extendedprice AS price, l_discount * 10 AS part_probability,
         (l_orderkey + l_linenumber) % 10 = 0 AS is_test
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""

_P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_FLAGS = ["A", "N", "R"]


@query("E04_E05_M03_feature_prep", sql=f"""
WITH {FEATURES_SQL.strip()},
b AS (SELECT min(qty) AS lo, max(qty) AS hi FROM feat)
SELECT regexp_replace(part_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS pk, 'default' AS mapping, l_orderkey, l_linenumber,
       {", ".join(f"CAST(p_type = '{v}' AS INTEGER) AS p_type_{v}" for v in _P_TYPES)},
       {", ".join(f"CAST(l_returnflag = '{v}' AS INTEGER) AS l_returnflag_{v}" for v in _FLAGS)},
       round(CASE WHEN hi = lo THEN 0.0 ELSE (qty - lo) / (hi - lo) END, 6) AS qty_scaled
FROM feat, b""")
def e04_e05(spark, sf):
    f = features(spark, sf)
    f = MO.with_keys(f, "part_name", "default")
    f = MO.one_hot(f, CATEGORICAL)
    f = MO.minmax(f, "qty", out="qty_scaled").withColumn("qty_scaled", F.round("qty_scaled", 6))
    keep = ["pk", "mapping", "l_orderkey", "l_linenumber", "qty_scaled"] + \
        [c for c in f.columns if c.startswith("p_type_") or c.startswith("l_returnflag_")]
    return f.select(*keep)


@query("E06_A08_manifest", sql=f"""
WITH {FEATURES_SQL.strip()}
SELECT regexp_replace(part_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS pk, region AS mapping, CAST(count(*) AS BIGINT) AS n_rows,
       'run-1' AS run_id,
       '/data/features/pk=' || regexp_replace(part_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') || '/mapping=' || region AS data_path,
       'lr|mean' AS algorithms, 'Submitted' AS status
FROM feat GROUP BY ALL""")
def e06(spark, sf):
    f = MO.with_keys(features(spark, sf), "part_name", "region")
    m = MO.manifest(f, ["pk", "mapping"], "run-1", ["lr", "mean"], "/data/features")
    return m.withColumn("algorithms", F.array_join("algorithms", "|"))


_SPLIT_SQL = ("CAST('0x' || substr(md5('42|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8) "
              "AS BIGINT) % 100 < 10")


@query("E07_split", sql=f"SELECT l_orderkey, l_linenumber, {_SPLIT_SQL} AS is_test FROM lineitem")
def e07(spark, sf):
    """Hash split of every row."""
    f = features(spark, sf).drop("is_test")
    return MO.split(f, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "is_test")


@query("E08_fit_linear", sql="""
SELECT p_name AS part_name, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
       round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, CAST(count(*) AS BIGINT) AS n_train
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name""")
def e08(spark, sf):
    """Per-key least squares from partial-aggregate normal equations (one
    feature here, so the SQL twin is ``regr_slope``/``regr_intercept``)."""
    f = features(spark, sf)
    m = MO.fit_linear(f, ["part_name"], ["qty"], "price")
    return m.select("part_name", F.round("intercept", 3).alias("intercept"),
                    F.round(F.element_at("coef", 1), 3).alias("slope"), "n_train")


def _single_feature_models(f):
    """'lr' (one feature, built-in regr_* aggregates) and 'mean' per key,
    fitted on the training rows."""
    tr = f.filter(~F.col("is_test"))
    lr = tr.groupBy("pk", "mapping").agg(
        F.regr_intercept("part_probability", "qty").alias("intercept"),
        F.regr_slope("part_probability", "qty").alias("slope")) \
        .select("pk", "mapping", F.lit("lr").alias("algoname"), "intercept",
                F.array(F.coalesce("slope", F.lit(0.0))).alias("coef"))
    mean = MO.fit_mean(tr, ["pk", "mapping"], "part_probability") \
        .select("pk", "mapping", "algoname", "intercept", F.array(F.lit(0.0)).alias("coef"))
    return lr.unionByName(mean)


def held_out_predictions(spark, sf):
    f = keyed_features(spark, sf, "is_test")
    models = _single_feature_models(f)
    te = f.filter(F.col("is_test"))
    pred = MO.predict(te, models, ["pk", "mapping"], ["qty"])
    return pred.withColumn("pred", F.round("pred", 6))


_PRED_SQL = f"""
{FEATURES_SQL.strip()},
f AS (SELECT *, regexp_replace(part_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS pk, region AS mapping FROM feat),
lr AS (SELECT pk, mapping, 'lr' AS algoname, regr_intercept(part_probability, qty) AS intercept,
              coalesce(regr_slope(part_probability, qty), 0.0) AS slope FROM f WHERE NOT is_test GROUP BY pk, mapping),
mn AS (SELECT pk, mapping, 'mean' AS algoname, avg(part_probability) AS intercept, 0.0 AS slope
       FROM f WHERE NOT is_test GROUP BY pk, mapping),
models AS (SELECT * FROM lr UNION ALL SELECT * FROM mn),
pred AS (SELECT f.l_orderkey, f.l_linenumber, f.pk, f.mapping, m.algoname, f.part_probability,
                round(m.intercept + coalesce(m.slope * f.qty, 0.0), 6) AS pred
         FROM f JOIN models m ON f.pk = m.pk AND f.mapping = m.mapping WHERE f.is_test)"""


@query("E10_E11_predict", sql=f"""
WITH {_PRED_SQL.strip()}
SELECT l_orderkey, l_linenumber, pk, mapping, algoname, pred FROM pred""")
def e10_e11(spark, sf):
    return held_out_predictions(spark, sf).select("l_orderkey", "l_linenumber", "pk", "mapping", "algoname", "pred")


_OVERLAP_SQL = f"""
{_PRED_SQL.strip()},
tp AS (SELECT DISTINCT pk, mapping, algoname FROM (
         SELECT *, rank() OVER (PARTITION BY mapping, algoname ORDER BY pred DESC) AS rk FROM pred WHERE pred IS NOT NULL) WHERE rk <= {TOP_N}),
ta AS (SELECT DISTINCT pk, mapping, algoname FROM (
         SELECT *, rank() OVER (PARTITION BY mapping, algoname ORDER BY part_probability DESC) AS rk FROM pred WHERE part_probability IS NOT NULL) WHERE rk <= {TOP_N}),
per_mapping AS (SELECT mapping, algoname, CAST(count(*) AS BIGINT) AS metric_value, 'Intersection' AS metric_name,
              round(count(*) * 100.0 / {TOP_N}, 4) AS metric_percent
       FROM tp JOIN ta USING (pk, mapping, algoname) GROUP BY mapping, algoname),
ov AS (SELECT algoname, CAST(sum(metric_value) AS BIGINT) AS metric_value, 'Intersection' AS metric_name,
              round(avg(metric_percent), 4) AS metric_percent FROM per_mapping GROUP BY algoname)"""


def overlap_metrics(spark, sf):
    """Overlap ranked per (mapping, algorithm)."""
    pred = held_out_predictions(spark, sf)
    return MO.topk_overlap(pred, ["pk"], ["mapping", "algoname"], "pred", "part_probability", TOP_N)


def overlap_by_algorithm(spark, sf):
    return MO.overlap_rollup(overlap_metrics(spark, sf))


@query("E01_J20_topk_overlap", sql=f"""
WITH {_OVERLAP_SQL.strip()}
SELECT mapping, algoname, metric_value, metric_name, metric_percent FROM per_mapping""")
def e01(spark, sf):
    return overlap_metrics(spark, sf).select("mapping", "algoname", "metric_value", "metric_name", "metric_percent")


@query("E02_winner", sql=f"""
WITH {_OVERLAP_SQL.strip()}
SELECT CAST(metric_value AS VARCHAR) AS winningalgometric, algoname AS winningalgo FROM ov
ORDER BY metric_value DESC, algoname LIMIT 1""")
def e02(spark, sf):
    return MO.winner(overlap_by_algorithm(spark, sf))


_THR_SQL = ", ".join(f"('{u}', '{m}', '{un}', {b}, {c}, '{e}')" for u, m, un, b, c, e in MO.THRESHOLDS)


@query("E03_Z20_traffic_light", sql=f"""
WITH {_OVERLAP_SQL.strip()},
thr AS (SELECT * FROM (VALUES {_THR_SQL}) t(usecase, metric_name, unit, base_threshold, critical_threshold, expected_value))
SELECT ov.metric_name, unit, expected_value, metric_percent AS actual_value, algoname, base_threshold, critical_threshold,
       CASE WHEN metric_percent >= base_threshold THEN 'Green'
            WHEN metric_percent >= critical_threshold THEN 'Amber'
            WHEN metric_percent < critical_threshold THEN 'Red' END AS status, 'Training' AS source
FROM ov JOIN thr ON ov.metric_name = thr.metric_name""")
def e03(spark, sf):
    m = overlap_by_algorithm(spark, sf)
    t = MO.traffic_light(m, MO.thresholds(spark), value="metric_percent")
    return t.select("metric_name", "unit", "expected_value", F.col("metric_percent").alias("actual_value"),
                    "algoname", "base_threshold", "critical_threshold", "status",
                    F.lit("Training").alias("source"))


@query("E12_status_rollup", sql=f"""
WITH {_PRED_SQL.strip()}
SELECT algoname, CAST(count(*) AS BIGINT) AS total_jobs,
       CAST(count(*) FILTER (WHERE intercept IS NOT NULL AND NOT isnan(intercept)) AS BIGINT) AS succeeded_jobs,
       CAST(count(*) FILTER (WHERE intercept IS NULL OR isnan(intercept)) AS BIGINT) AS failed_jobs
FROM models GROUP BY algoname""")
def e12(spark, sf):
    f = keyed_features(spark, sf, "is_test")
    st = MO.status_log(_single_feature_models(f), ["pk", "mapping"], "run-1")
    return st.groupBy("algoname").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(F.col("status") == "Succeeded").alias("succeeded_jobs"),
        F.count_if(F.col("status") == "Failed").alias("failed_jobs"))


@query("Z20_inference_quality", sql=f"""
WITH {_PRED_SQL.strip()},
inf AS (SELECT DISTINCT pk, mapping, algoname FROM (
          SELECT *, rank() OVER (PARTITION BY algoname ORDER BY pred DESC) AS rk FROM pred WHERE pred IS NOT NULL) WHERE rk <= {TOP_N}),
gt0 AS (SELECT pk AS partname, mapping AS region, avg(part_probability) AS actual_failure_probabilty
        FROM f GROUP BY ALL),
gt AS (SELECT DISTINCT partname, region FROM (
         SELECT *, rank() OVER (ORDER BY actual_failure_probabilty DESC) AS rk FROM gt0) WHERE rk <= {TOP_N}),
ov AS (SELECT algoname, CAST(count(*) AS BIGINT) AS metric_value, 'Intersection' AS metric_name,
              round(count(*) * 100.0 / {TOP_N}, 4) AS metric_percent
       FROM gt JOIN inf ON inf.pk = gt.partname AND inf.mapping = gt.region GROUP BY algoname),
thr AS (SELECT * FROM (VALUES {_THR_SQL}) t(usecase, metric_name, unit, base_threshold, critical_threshold, expected_value))
SELECT ov.metric_name, metric_percent AS actual_value, algoname,
       CASE WHEN metric_percent >= base_threshold THEN 'Green'
            WHEN metric_percent >= critical_threshold THEN 'Amber'
            WHEN metric_percent < critical_threshold THEN 'Red' END AS status, 'Inference' AS source
FROM ov JOIN thr ON ov.metric_name = thr.metric_name""")
def z20(spark, sf):
    """Inference monitoring: top-N scored keys per algorithm vs the top-N of
    a ground-truth table (mean label per part and region)."""
    pred = held_out_predictions(spark, sf)
    f = MO.with_keys(features(spark, sf), "part_name", "region")
    gt = f.groupBy(F.col("pk").alias("partname"), F.col("mapping").alias("region")) \
        .agg(F.avg("part_probability").alias("actual_failure_probabilty"))
    m = MO.topk_overlap(pred, ["pk", "mapping"], ["algoname"], "pred", "actual_failure_probabilty", TOP_N,
                        actual=gt, actual_keys=["partname", "region"], actual_part=[])
    t = MO.traffic_light(m, MO.thresholds(spark), value="metric_percent")
    return t.select("metric_name", F.col("metric_percent").alias("actual_value"), "algoname", "status",
                    F.lit("Inference").alias("source"))


KEYS = ["pk", "mapping"]
ALGORITHMS = ["lr", "mean", "gbt"]
MAPPING_DOC = {"mapping_json_data": {
    "primary_key": "part_name",
    "Training": {"mappingColumn": "region", "all_algorithms": ALGORITHMS},
    "Inference": {"mappingColumn": "region", "all_algorithms": [],
                  "mapping": {"AFRICA": ["lr"], "AMERICA": ["lr", "mean", "gbt"], "ASIA": ["mean"], "EUROPE": ["lr", "mean"],
                              "MIDDLE EAST": ["lr", "gbt"]}}}}


def mapping_document(spark):
    """The mapping document written as JSON and read back."""
    path = scratch(spark, "mapping")
    spark.createDataFrame([(json.dumps(MAPPING_DOC),)], "value string").write.text(path)
    return SR.read_mapping(spark, path)


def run_features(spark, sf):
    """Gate, mapping check, keyed features written and read back, manifest."""
    f = keyed_features(spark, sf, "l_returnflag")
    run = {"corelation_id": "run-1", "source": "features", "year": "2024", "month": "02", "day": "01"}
    outcomes = Q.with_overall(Q.evaluate(f, [Q.is_complete("pk"), Q.values_between("qty", 0, 1000)], run), run)
    if Q.gate(outcomes.withColumn("audittimestamp", F.current_timestamp())).first()["gate"] != "Passed":
        raise ValueError("the data-quality gate failed")
    mapping = mapping_document(spark)
    if not MO.check_mapping(mapping, ALGORITHMS, ALGORITHMS).first()["valid"]:
        raise ValueError("the mapping document is not valid")
    f = MO.one_hot(MO.minmax(f, "qty", out="qty_scaled"), ["l_returnflag"])
    f = f.select(*KEYS, "l_orderkey", "l_linenumber", "qty_scaled", *[c for c in f.columns if c.startswith("l_returnflag_")], "part_probability")
    path = scratch(spark, "keyed_features")
    K.write_keyed(f, path, KEYS)
    f = SR.read_run(spark, path).withColumns({k: F.col(k).cast("string") for k in KEYS})
    return MO.split(f, ["l_orderkey", "l_linenumber"]), mapping, MO.manifest(f, KEYS, "run-1", ALGORITHMS, path)


# The scoring run's trees: one cut on one flag.  The training run's have all features and the operator's own rounds, rate and bins.
SCORING_TREES = {"features": ["l_returnflag_R"], "rounds": 1, "rate": 1.0}


def tree_features(f) -> list[str]:
    return ["qty_scaled", *sorted(c for c in f.columns if c.startswith("l_returnflag_"))]


def train_models(spark, f, trees=None):
    """The linear algorithms and the trees on the training rows, stored and read back.  Without ``trees`` (features
    and parameters) these are grown on all features by the defaults of ``fit_trees``; no features, no trees."""
    tr = f.filter(~F.col("is_test"))
    lr = MO.fit_linear(tr, KEYS, ["qty_scaled"], "part_probability")
    mean = MO.fit_mean(tr, KEYS, "part_probability").withColumn("coef", F.array(F.lit(0.0)))
    linear, grown = scratch(spark, "models"), scratch(spark, "tree_models")
    MO.store_models(lr.select(*KEYS, "algoname", "intercept", "coef").unionByName(
        mean.select(*KEYS, "algoname", "intercept", "coef")), linear)
    given = {"features": tree_features(f)} if trees is None else dict(trees)
    if given["features"]:
        MO.store_models(MO.fit_trees(tr, KEYS, label="part_probability", **given), grown)
        return MO.load_models(spark, linear, from_path=True), MO.load_models(spark, grown, from_path=True)
    return MO.load_models(spark, linear), None


def score_all(f, linear, trees, features):
    """Rows scored by every model of their key; ``features`` are those of the trees."""
    cols = [*KEYS, "l_orderkey", "l_linenumber", "part_probability", "algoname", "pred"]
    return MO.predict(f, linear, KEYS, ["qty_scaled"]).select(*cols).unionByName(
        MO.predict_trees(f, trees, KEYS, features).select(*cols))


def model_status(linear, trees, run_id="run-1"):
    return MO.status_log(linear.select(*KEYS, "algoname", "intercept").unionByName(
        trees.select(*KEYS, "algoname", F.col("base").alias("intercept"))), KEYS, run_id)


_RUN_SQL = f"""
{FEATURES_SQL.strip()},
bounds AS (SELECT min(qty) AS lo, max(qty) AS hi FROM feat),
f AS (SELECT regexp_replace(part_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS pk, region AS mapping, l_orderkey, l_linenumber,
             part_probability AS y, CASE WHEN hi = lo THEN 0.0 ELSE (qty - lo) / (hi - lo) END AS x, {_SPLIT_SQL} AS is_test,
             l_returnflag = 'R' AS r
      FROM feat, bounds),
fit AS (SELECT pk, mapping, avg(y) AS my, avg(x) AS mx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
               min(x) = max(x) AS flat FROM f WHERE NOT is_test GROUP BY ALL),
models AS (SELECT pk, mapping, 'mean' AS algoname, my AS intercept, 0.0 AS slope FROM fit
           UNION ALL SELECT pk, mapping, 'lr', CASE WHEN flat THEN my / (1 + mx * mx) ELSE a END,
                            CASE WHEN flat THEN my * mx / (1 + mx * mx) ELSE b END FROM fit)"""

# one tree of one cut on a flag, at full rate: the mean of the flag's rows, for a flag not seen that of the key
_SCORED_SQL = """
cut AS (SELECT pk, mapping, r, avg(y) AS my FROM f WHERE NOT is_test GROUP BY ALL),
scored AS (SELECT f.*, algoname, intercept + slope * x AS p FROM f JOIN models USING (pk, mapping)
           UNION ALL SELECT f.*, 'gbt', coalesce(cut.my, fit.my) FROM f JOIN fit USING (pk, mapping) LEFT JOIN cut USING (pk, mapping, r))"""


# boosted stumps on all features, by the defaults of fit_trees: cells of rows between the cuts, a round after the other
_ROUNDS, _RATE, _BINS = (inspect.signature(MO.fit_trees).parameters[p].default for p in ("rounds", "rate", "bins"))
_BOOSTED_SQL = f"""
g AS (SELECT regexp_replace(part_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS pk, region AS mapping, part_probability AS y, {_SPLIT_SQL} AS is_test,
             [qty, {", ".join(f"CAST(l_returnflag = '{v}' AS DOUBLE)" for v in _FLAGS)}] AS xs FROM feat),
cuts AS (SELECT feature, list_sort(list_distinct(quantile_disc(xs[feature], [{", ".join(f"{k} / {_BINS}" for k in range(1, _BINS))}]))) AS steps
         FROM g, range(1, {2 + len(_FLAGS)}) t(feature) WHERE NOT is_test GROUP BY feature),
cand AS (SELECT feature, unnest(range(len(steps))) AS k FROM cuts),
placed AS (SELECT pk, mapping, y, is_test, list_transform(xs, lambda x, i: len(list_filter(every[i], lambda c: x > c))) AS bins
           FROM g, (SELECT list(steps ORDER BY feature) AS every FROM cuts)),
bases AS (SELECT pk, mapping, avg(y) AS base FROM g WHERE NOT is_test GROUP BY ALL),
cells0 AS MATERIALIZED (SELECT pk, mapping, bins, n, s - n * base AS r, base AS p FROM (
    SELECT pk, mapping, bins, count(*) FILTER (NOT is_test) AS n, coalesce(sum(y) FILTER (NOT is_test), 0) AS s FROM placed GROUP BY ALL) JOIN bases USING (pk, mapping)),
""" + "".join(f"""
sums{i} AS (SELECT pk, mapping, feature, k, sum(n) AS na, sum(r) AS ra, coalesce(sum(n) FILTER (bins[feature] <= k), 0) AS nl,
                   coalesce(sum(r) FILTER (bins[feature] <= k), 0) AS rl FROM cells{i}, cand GROUP BY ALL),
means{i} AS (SELECT *, CASE WHEN nl > 0 THEN rl / nl ELSE 0 END AS ml, CASE WHEN na > nl THEN (ra - rl) / (na - nl) ELSE 0 END AS mr FROM sums{i}),
cut{i} AS MATERIALIZED (SELECT * FROM means{i}
    QUALIFY row_number() OVER (PARTITION BY pk, mapping ORDER BY round(rl * ml + (ra - rl) * mr, 9) DESC, feature, k) = 1),
cells{i + 1} AS MATERIALIZED (SELECT pk, mapping, bins, n, r - n * d AS r, p + d AS p FROM (
    SELECT c.*, {_RATE} * CASE WHEN bins[feature] <= k THEN ml ELSE mr END AS d FROM cells{i} c JOIN cut{i} USING (pk, mapping))),""" for i in range(_ROUNDS)) + f"""
scored AS (SELECT pk, mapping, algoname, is_test, y, intercept + slope * x AS p FROM f JOIN models USING (pk, mapping)
           UNION ALL SELECT pk, mapping, 'gbt', is_test, y, p FROM placed JOIN cells{_ROUNDS} USING (pk, mapping, bins))"""


@query("Z18_training_run", sql=f"""
WITH {_RUN_SQL.strip()},
{_BOOSTED_SQL.strip()},
pred AS (SELECT * REPLACE (round(p, 6) AS p) FROM scored WHERE is_test),
tp AS (SELECT DISTINCT pk, mapping, algoname FROM pred QUALIFY rank() OVER (PARTITION BY mapping, algoname ORDER BY p DESC) <= {TOP_N}),
ta AS (SELECT DISTINCT pk, mapping, algoname FROM pred QUALIFY rank() OVER (PARTITION BY mapping, algoname ORDER BY y DESC) <= {TOP_N}),
pm AS (SELECT mapping, algoname, count(*) AS n FROM tp JOIN ta USING (pk, mapping, algoname) GROUP BY ALL),
m AS (SELECT algoname, CAST(sum(n) AS BIGINT) AS metric_value, round(avg(round(n * 100.0 / {TOP_N}, 4)), 4) AS metric_percent FROM pm GROUP BY ALL)
SELECT algoname, metric_value, metric_percent, CASE WHEN metric_percent >= 30 THEN 'Green' WHEN metric_percent >= 20 THEN 'Amber' ELSE 'Red' END AS status,
       (SELECT algoname FROM m ORDER BY metric_value DESC, algoname LIMIT 1) AS winner_algo,
       (SELECT CAST(count(*) AS BIGINT) FROM models) + (SELECT CAST(count(*) AS BIGINT) FROM fit) AS total_jobs, CAST(0 AS BIGINT) AS failed_jobs,
       (SELECT CAST(count(DISTINCT pk || '|' || mapping) AS BIGINT) FROM f) AS work_items
FROM m""")
def z18(spark, sf):
    """Training run, in the order of its steps: gate, mapping document and its
    check, one-hot and keyed features, manifest, three algorithms per key (trees boosted on all features), stored models,
    status log, held-out predictions, overlap per (mapping, algorithm),
    traffic lights, winner, run record; a row per algorithm."""
    f, mapping, work = run_features(spark, sf)
    models = train_models(spark, f)
    status = model_status(*models)
    pred = kept(spark, score_all(f.filter("is_test"), *models, tree_features(f)).select(
        *KEYS, "algoname", "part_probability", F.round("pred", 6).alias("pred")), "held_out")
    m = MO.overlap_rollup(MO.topk_overlap(pred, ["pk"], ["mapping", "algoname"], "pred", "part_probability", TOP_N))
    m = cut_lineage(m)
    lights = MO.traffic_light(m, MO.thresholds(spark), value="metric_percent")
    record = MO.run_record(m, MO.winner(m), "run-1", "part-failures", {"preprocessing": (0, 1), "training": (1, 2)}, status)
    path = scratch(spark, "run_record")
    K.write_ndjson(record, path)
    back = SR.read_run_tables(spark, path)
    scores = back.select("winner_algo", "total_jobs", "failed_jobs", F.explode("algo_scores").alias("s"))
    n = work.agg(F.count(F.lit(1))).scalar()
    return scores.join(lights, F.col("s.algo_name") == F.col("algoname")).select(
        "algoname", F.col("s.algo_score").cast("bigint").alias("metric_value"), "metric_percent", "status", "winner_algo",
        "total_jobs", "failed_jobs", n.alias("work_items"))


@query("Z19_scoring_run", sql=f"""
WITH {_RUN_SQL.strip()},
allowed(mapping, algoname) AS (VALUES {", ".join(f"('{r}', '{a}')" for r, algos in
    MAPPING_DOC["mapping_json_data"]["Inference"]["mapping"].items() for a in algos)}),
{_SCORED_SQL.strip()},
p AS (SELECT pk, mapping, algoname, p FROM scored JOIN allowed USING (mapping, algoname))
SELECT pk, mapping, algoname, round(avg(p), 6) AS mean_score, CAST(count(*) AS BIGINT) AS n_scored, 'Succeeded' AS status
FROM p GROUP BY ALL""")
def z19(spark, sf):
    """Scoring run: gate, mapping document, one-hot and keyed features, stored models (named by their paths) of the
    algorithms its document lists for each mapping, scores of every row
    written by key; mean score and job status per key and algorithm."""
    f, mapping, work = run_features(spark, sf)
    jobs = SR.algorithms_by_key(work.select(*KEYS), mapping, "mapping").select(*KEYS, F.explode("algorithms").alias("algoname"))
    # from files their size is known, so that scoring may broadcast them
    models = [kept(spark, m.join(jobs, [*KEYS, "algoname"]), "chosen_models") for m in train_models(spark, f, SCORING_TREES)]
    pred = score_all(f, *models, SCORING_TREES["features"])
    path = scratch(spark, "scores")
    K.write_keyed(pred.select(*KEYS, "algoname", "l_orderkey", "l_linenumber", "pred"), path, KEYS)
    back = SR.read_run(spark, path).withColumns({k: F.col(k).cast("string") for k in KEYS})
    status = model_status(*models).drop("run_id")
    return back.groupBy(*KEYS, "algoname").agg(F.round(F.avg("pred"), 6).alias("mean_score"), F.count(F.lit(1)).alias("n_scored")) \
        .join(status, [*KEYS, "algoname"])


@query("E09_fit_trees", sql=f"""
WITH {_RUN_SQL.strip()}
SELECT pk, mapping, 'gbt' AS algoname, CAST(count(*) FILTER (WHERE NOT is_test) AS BIGINT) AS n_train,
       CAST(count(*) FILTER (WHERE is_test) AS BIGINT) AS n_scored, TRUE AS no_worse
FROM f GROUP BY ALL HAVING count(*) FILTER (WHERE NOT is_test) > 0""")
def e09(spark, sf):
    """Boosted trees per key on the training rows, all rows scored; ``no_worse``:
    squared error on the training rows at most that of the key's mean."""
    f = MO.split(keyed_features(spark, sf, "price"), ["l_orderkey", "l_linenumber"])
    models = MO.fit_trees(f.filter(~F.col("is_test")), KEYS, ["qty", "price"], "part_probability", rounds=5)
    pred = MO.predict_trees(f, models, KEYS, ["qty", "price"]).join(models.select(*KEYS, "base", "n_train"), KEYS)
    y, train = F.col("part_probability"), ~F.col("is_test")
    return pred.groupBy(*KEYS, "algoname").agg(
        F.max("n_train").alias("n_train"), F.count_if(F.col("is_test")).alias("n_scored"),
        (F.sum(F.when(train, F.pow(y - F.col("pred"), 2))) <= F.sum(F.when(train, F.pow(y - F.col("base"), 2))) + 1e-6).alias("no_worse"))


@query("E11_stored_models", sql=f"""
WITH {_RUN_SQL.strip()}
SELECT l_orderkey, l_linenumber, pk, mapping, algoname, round(intercept + slope * x, 6) AS pred FROM f JOIN models USING (pk, mapping)""")
def e11(spark, sf):
    """Coefficients stored by key and algorithm, read back, every row scored."""
    f = MO.split(MO.minmax(keyed_features(spark, sf), "qty", out="qty_scaled"), ["l_orderkey", "l_linenumber"])
    return MO.predict(f, train_models(spark, f, {"features": []})[0], KEYS, ["qty_scaled"]).select(
        "l_orderkey", "l_linenumber", *KEYS, "algoname", F.round("pred", 6).alias("pred"))


@query("E13_check_mapping", sql=f"""
SELECT CAST(1 AS BIGINT) AS n_rows, TRUE AS training_ok, TRUE AS inference_ok, TRUE AS superset_ok, TRUE AS column_ok, TRUE AS valid,
       (SELECT CAST(count(DISTINCT r_name) AS BIGINT) FROM region) AS regions,
       (SELECT CAST(count(*) AS BIGINT) FROM region WHERE r_name IN ('AFRICA', 'AMERICA', 'EUROPE', 'MIDDLE EAST')) AS with_lr""")
def e13(spark, sf):
    """Mapping document check, and the algorithms it gives each region."""
    m = mapping_document(spark)
    r = table(spark, sf, "region").select(F.col("r_name").alias("mapping"))
    a = SR.algorithms_by_key(r, m, "mapping").agg(F.struct(
        F.count_distinct("mapping").alias("n"), F.count_if(F.array_contains("algorithms", "lr")).alias("lr"))).scalar()
    return MO.check_mapping(m, ALGORITHMS, ALGORITHMS).withColumns({"regions": a.getField("n"), "with_lr": a.getField("lr")})


@query("E08_wide_least_squares", sql="""
SELECT l_orderkey, l_linenumber, r_name AS region,
       round(ln(avg(l_extendedprice) OVER (PARTITION BY r_name, l_suppkey)), 6) AS log_pred
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def e08_wide(spark, sf):
    """Least squares on a category per supplier, a model per region, by conjugate
    gradients; the closed form of one category is its mean."""
    li, o, c, n, r = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    f = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"]) \
        .join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]) \
        .select("l_orderkey", "l_linenumber", F.col("r_name").alias("region"), "l_suppkey", "l_extendedprice")
    f = MO.sparse_one_hot(f, ["l_suppkey"], out="vector")
    pred = MO.predict_sparse(f, MO.fit_sparse(f, ["region"], "vector", "l_extendedprice"), ["region"], "vector")
    return pred.select("l_orderkey", "l_linenumber", "region", F.round(F.log("pred"), 6).alias("log_pred"))


@query("E09_deep_trees", sql=f"""
WITH {FEATURES_SQL.strip()},
f AS (SELECT *, region AS mapping, (qty > 25)::INT AS large, (l_returnflag = 'R')::INT AS returned, {_SPLIT_SQL} AS test FROM feat)
SELECT l_orderkey, l_linenumber, mapping, round(m.y, 6) AS pred
FROM f JOIN (SELECT mapping, large, returned, avg(part_probability) AS y FROM f WHERE NOT test GROUP BY ALL) m USING (mapping, large, returned)""")
def e09_deep(spark, sf):
    """Trees of depth two on two flags, a model per region: at full rate one tree
    parts all four cases, so the score is their mean."""
    f = features(spark, sf).drop("is_test").withColumns({
        "mapping": F.col("region"), "large": (F.col("qty") > 25).cast("int"), "returned": (F.col("l_returnflag") == "R").cast("int")})
    f = kept(spark, f.select("l_orderkey", "l_linenumber", "mapping", "large", "returned", "part_probability"))
    f = MO.split(f, ["l_orderkey", "l_linenumber"])
    models = MO.fit_trees(f.filter(~F.col("is_test")), ["mapping"], ["large", "returned"], "part_probability", rounds=1, rate=1.0, depth=2)
    return MO.predict_trees(f, models, ["mapping"], ["large", "returned"]).select(
        "l_orderkey", "l_linenumber", "mapping", F.round("pred", 6).alias("pred"))


@query("E10_registered_algorithms", sql=f"""
WITH {_RUN_SQL.strip()},
every AS (SELECT * FROM models UNION ALL
          SELECT pk, mapping, 'median', median(y), 0.0 FROM f WHERE NOT is_test GROUP BY pk, mapping)
SELECT l_orderkey, l_linenumber, pk, mapping, algoname, round(intercept + slope * x, 6) AS pred
FROM f JOIN every USING (pk, mapping) WHERE is_test""")
def e10_registered(spark, sf):
    """Three registered algorithms trained per key, models stored as binary rows
    and read back, held-out rows scored by co-grouped batches."""
    from tessera.operators import algorithms as AL
    f = MO.split(MO.minmax(keyed_features(spark, sf), "qty", out="qty_scaled"), ["l_orderkey", "l_linenumber"])
    models = AL.fit_registered(f.filter(~F.col("is_test")), KEYS, ["qty_scaled"], "part_probability", ["lr", "mean", "median"])
    path = scratch(spark, "plugged_models")
    K.write_keyed(models, path, ("mapping", "algoname"))
    stored = MO.load_models(spark, path)
    out = AL.predict_registered(f.filter("is_test"), stored, KEYS, ["qty_scaled"], ["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", *KEYS, "algoname", F.round("pred", 6).alias("pred"))
