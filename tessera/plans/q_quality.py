"""Registered data-quality queries (Q*, Z16, Z17) with DuckDB oracle SQL.

Rule sets are written once as small specs; :func:`spark_rules` turns a spec
into :mod:`tessera.operators.quality` rules and :func:`_outcomes_sql`
writes the same checks as plain SQL for the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans.registry import query
from tessera.session import table
from tessera.sources import read_projected

AS_OF = dt.datetime(2024, 2, 1)
RUN = {"corelation_id": "wf-2024-02-01", "year": "2024", "month": "02", "day": "01",
       "audit_ts": "2024-02-01 00:00:00"}
RUN_OLD = {"corelation_id": "wf-2024-01-31", "year": "2024", "month": "01", "day": "31",
           "audit_ts": "2024-01-31 00:00:00"}

# source -> (table, spark select list, duckdb select list, rule specs)
DQ_SOURCES = {
    "lineitem": (
        "lineitem",
        "l_orderkey, l_linenumber, l_returnflag, l_quantity, l_discount, l_shipdate, "
        "concat(l_orderkey, '-', l_linenumber) AS concat_primary, "
        "date_format(l_shipdate, 'yyyy-MM-dd') AS ship_txt, "
        "CAST(l_extendedprice AS STRING) AS price_txt",
        "l_orderkey, l_linenumber, l_returnflag, l_quantity, l_discount, l_shipdate, "
        "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS concat_primary, "
        "strftime(l_shipdate, '%Y-%m-%d') AS ship_txt, CAST(l_extendedprice AS VARCHAR) AS price_txt",
        [("pk", "concat_primary"), ("pk", "l_orderkey"), ("complete", "l_returnflag"),
         ("type", "ship_txt", "Date"), ("between", "l_shipdate", dt.date(1996, 1, 1), None),
         ("type", "price_txt", "Float"),
         ("all", ("complete", "l_quantity"), ("cmp", "l_quantity", "<=", 45)),
         ("completeness", "l_discount", ">", 0.95), ("distinct", "l_returnflag", 0, 4),
         ("custom", "select count(*) from primary where l_discount > 0.09", 0, 100000)]),
    "orders": (
        "orders",
        "o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS STRING) AS price_txt",
        "o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS VARCHAR) AS price_txt",
        [("pk", "o_orderkey"), ("complete", "o_custkey"), ("type", "price_txt", "Float"),
         ("all", ("complete", "o_orderdate"), ("cmp", "o_orderdate", "<=", None))]),
    "customer": (
        "customer",
        "c_custkey, c_name, c_mktsegment, c_acctbal",
        "c_custkey, c_name, c_mktsegment, c_acctbal",
        [("pk", "c_custkey"), ("complete", "c_name"), ("completeness", "c_mktsegment", ">", 0.99),
         ("cmp", "c_acctbal", ">", 0)]),
    "part": (
        "part",
        "p_partkey, p_brand, p_type, p_name",
        "p_partkey, p_brand, p_type, p_name",
        [("pk", "p_partkey"), ("complete", "p_brand"), ("distinct", "p_type", 0, 10),
         ("pk", "p_name")]),
    "supplier": (
        "supplier",
        "s_suppkey, s_name, s_acctbal",
        "s_suppkey, s_name, s_acctbal",
        [("pk", "s_suppkey"), ("cmp", "s_acctbal", ">", -1000),
         ("custom", "select count(*) from primary where s_acctbal < 0", -1, 1000)]),
}


def spark_rule(spec, as_of=AS_OF):
    kind = spec[0]
    if kind == "pk":
        return Q.is_primary_key(spec[1])
    if kind == "complete":
        return Q.is_complete(spec[1])
    if kind == "completeness":
        return Q.completeness(spec[1], spec[2], spec[3])
    if kind == "type":
        return Q.has_type(spec[1], spec[2])
    if kind == "between":
        return Q.values_between(spec[1], spec[2], spec[3], as_of=as_of)
    if kind == "cmp":
        return Q.values_cmp(spec[1], spec[2], spec[3], as_of=as_of)
    if kind == "distinct":
        return Q.distinct_count(spec[1], spec[2], spec[3])
    if kind == "custom":
        return Q.custom_sql(spec[1], spec[2], spec[3])
    if kind == "all":
        return Q.all_of(*[spark_rule(s, as_of) for s in spec[1:]])
    raise ValueError(kind)


def spark_rules(specs, as_of=AS_OF):
    return [spark_rule(s, as_of) for s in specs]


def dq_input(spark, sf, source):
    tbl, cols, _, _ = DQ_SOURCES[source]
    return read_projected(table(spark, sf, tbl), cols)


def outcomes(spark, sf, source, run=RUN, as_of=AS_OF):
    specs = DQ_SOURCES[source][3]
    return Q.evaluate(dq_input(spark, sf, source), spark_rules(specs, as_of), dict(run, source=source))


# ----------------------------------------------------------------- oracle SQL

def _lit(v) -> str:
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
    if isinstance(v, dt.date):
        return f"DATE '{v:%Y-%m-%d}'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _txt(v) -> str:
    return f'"{v}"' if isinstance(v, str) else str(v)


_DUCK_TYPES = {"date": "DATE", "float": "DOUBLE", "integer": "INTEGER"}


def _rule_sql(spec, as_of):
    """(rule text, [(metric name, agg sql)], check sql over metric aliases
    placeholder {m0}.., row-pass sql or None, [key-count columns], custom sql)."""
    k = spec[0]
    if k == "pk":
        c = spec[1]
        return (f'IsPrimaryKey "{c}"',
                [(f"Column.{c}.Completeness", f"count({c}) / count(*)"),
                 (f"Column.{c}.Uniqueness", f"count(DISTINCT {c}) / count(*)")],
                "({m0} = 1.0 AND {m1} = 1.0)", f"({c} IS NOT NULL AND kc_{c} = 1)", [c], None)
    if k == "complete":
        c = spec[1]
        return (f'IsComplete "{c}"', [(f"Column.{c}.Completeness", f"count({c}) / count(*)")],
                "({m0} = 1.0)", f"({c} IS NOT NULL)", [], None)
    if k == "completeness":
        c, op, t = spec[1:]
        return (f'Completeness "{c}" {op} {t}', [(f"Column.{c}.Completeness", f"count({c}) / count(*)")],
                f"({{m0}} {op} {t})", None, [], None)
    if k == "type":
        c, t = spec[1:]
        ok = f"({c} IS NULL OR TRY_CAST(CAST({c} AS VARCHAR) AS {_DUCK_TYPES[t.lower()]}) IS NOT NULL)"
        return (f'ColumnDataType "{c}" = "{t}"',
                [(f"Column.{c}.ColumnDataType.Compliance", f"count(*) FILTER (WHERE {ok}) / count(*)")],
                "({m0} = 1.0)", ok, [], None)
    if k == "between":
        c, lo, hi = spec[1:]
        hv = hi if hi is not None else as_of
        ok = f"coalesce({c} BETWEEN {_lit(lo)} AND {_lit(hv)}, false)"
        text_hi = "now()" if hi is None else _txt(hi)
        return (f'ColumnValues "{c}" between {_txt(lo)} and {text_hi}',
                [(f"Column.{c}.ColumnValues.Compliance", f"count(*) FILTER (WHERE {ok}) / count(*)")],
                "({m0} = 1.0)", ok, [], None)
    if k == "cmp":
        c, op, v = spec[1:]
        vv = v if v is not None else as_of
        ok = f"coalesce({c} {op} {_lit(vv)}, false)"
        text_v = "now()" if v is None else _txt(v)
        return (f'ColumnValues "{c}" {op} {text_v}',
                [(f"Column.{c}.ColumnValues.Compliance", f"count(*) FILTER (WHERE {ok}) / count(*)")],
                "({m0} = 1.0)", ok, [], None)
    if k == "distinct":
        c, lo, hi = spec[1:]
        return (f'DistinctValuesCount "{c}" between {lo} and {hi}',
                [(f"Column.{c}.DistinctValuesCount", f"CAST(count(DISTINCT {c}) AS DOUBLE)")],
                f"({{m0}} > {lo} AND {{m0}} < {hi})", None, [], None)
    if k == "custom":
        sql, lo, hi = spec[1:]
        return (f'CustomSql "{sql}" between {lo} and {hi}', [("Dataset.*.CustomSQL", None)],
                f"({{m0}} > {lo} AND {{m0}} < {hi})", None, [], sql.replace(" primary", " t"))
    if k == "all":
        parts = [_rule_sql(s, as_of) for s in spec[1:]]
        metrics, checks, rows, keys, custom = [], [], [], [], None
        for p in parts:
            off = len(metrics)
            metrics += p[1]
            chk = p[2]
            for j in reversed(range(len(p[1]))):
                chk = chk.replace("{m%d}" % j, "{m%d}" % (j + off))
            checks.append(chk)
            rows.append(p[3])
            keys += p[4]
            custom = custom or p[5]
        row = " AND ".join(rows) if all(r is not None for r in rows) else None
        return (" and ".join(f"({p[0]})" for p in parts), metrics, "(" + " AND ".join(checks) + ")",
                row, keys, custom)
    raise ValueError(k)


def _outcomes_sql(source: str, run=RUN, as_of=AS_OF, spec=None) -> str:
    tbl, _, cols, specs = spec or DQ_SOURCES[source]
    rules = [_rule_sql(s, as_of) for s in specs]
    keys = sorted({k for r in rules for k in r[4]})
    kc = "".join(f", count(*) OVER (PARTITION BY {k}) AS kc_{k}" for k in keys)
    aggs, selects = [], []
    for i, (text, metrics, check, row, _, custom) in enumerate(rules):
        names = []
        for j, (mname, expr) in enumerate(metrics):
            alias = f"m{i}_{j}"
            if expr is None:
                expr = f"({custom})"
            aggs.append(f"CAST({expr} AS DOUBLE) AS {alias}")
            names.append((mname, alias))
        if row is not None:
            aggs.append(f"count(*) FILTER (WHERE {row}) AS p{i}")
            aggs.append(f"count(*) FILTER (WHERE NOT ({row})) AS f{i}")
        chk = check
        for j, (_, alias) in enumerate(names):
            chk = chk.replace("{m%d}" % j, alias)
        ok = f"coalesce({chk}, false)"
        mtext = "'{' || " + " || ', ' || ".join(
            f"'{mn} -> ' || CAST(round({al}, 6) AS VARCHAR)" for mn, al in names) + " || '}'"
        actual = "'NA'" if len(names) > 1 else f"CAST(round({names[0][1]}, 6) AS VARCHAR)"
        rule_lit = _lit(text)
        selects.append(
            f"SELECT {rule_lit} AS rule, CASE WHEN {ok} THEN 'Passed' ELSE 'Failed' END AS outcome, "
            f"CASE WHEN {ok} THEN NULL ELSE {_lit('Rule failed: ' + text)} END AS failurereason, "
            f"{actual} AS actual_value, {mtext} AS evaluatedmetrics, "
            + (f"CAST(p{i} AS BIGINT) AS passcnt, CAST(f{i} AS BIGINT) AS failcnt"
               if row is not None else "CAST(NULL AS BIGINT) AS passcnt, CAST(NULL AS BIGINT) AS failcnt")
            + f", '{run['corelation_id']}' AS corelation_id, '{source}' AS source, '{run['year']}' AS year, "
            f"'{run['month']}' AS month, '{run['day']}' AS day, "
            f"TIMESTAMP '{run['audit_ts']}' AS audittimestamp FROM a")
    return (f"(WITH t AS (SELECT {cols} FROM {tbl}), k AS (SELECT *{kc} FROM t), "
            f"a AS (SELECT {', '.join(aggs)} FROM k) " + " UNION ALL ".join(selects) + ")")


# ----------------------------------------------------------------- queries

@query("Q10_evaluate_rules", sql=_outcomes_sql("lineitem"))
def q10(spark, sf):
    """Consolidated outcomes of the line rule set (Q01-Q08 kinds, one pass)."""
    return outcomes(spark, sf, "lineitem")


@query("Q09_Q10_one_pass", sql=_outcomes_sql("lineitem"))
def q09_q10(spark, sf):
    """The line rule set again: row outcomes written and metrics observed in one pass."""
    from tessera.plans.q_io import scratch
    return Q.evaluate_rows(dq_input(spark, sf, "lineitem"), spark_rules(DQ_SOURCES["lineitem"][3]), scratch(spark, "line_outcomes"),
                           dict(RUN, source="lineitem"))


_ROW_RULES_LINE = [s for s in DQ_SOURCES["lineitem"][3] if s[0] in ("pk", "complete", "type", "between", "all")]


def _row_outcomes_sql() -> str:
    rules = [_rule_sql(s, AS_OF) for s in _ROW_RULES_LINE]
    keys = sorted({k for r in rules for k in r[4]})
    kc = "".join(f", count(*) OVER (PARTITION BY {k}) AS kc_{k}" for k in keys)
    _, _, cols, _ = DQ_SOURCES["lineitem"]
    pas = "[" + ", ".join(f"CASE WHEN {r[3]} THEN {_lit(r[0])} END" for r in rules if r[3]) + "]"
    fai = "[" + ", ".join(f"CASE WHEN NOT ({r[3]}) THEN {_lit(r[0])} END" for r in rules if r[3]) + "]"
    return (f"WITH t AS (SELECT {cols} FROM lineitem), k AS (SELECT *{kc} FROM t), "
            f"o AS (SELECT concat_primary, list_filter({pas}, lambda x: x IS NOT NULL) AS ps, "
            f"list_filter({fai}, lambda x: x IS NOT NULL) AS fs FROM k) "
            "SELECT concat_primary, array_to_string(ps, '|') AS passed, array_to_string(fs, '|') AS failed, "
            "CASE WHEN len(fs) = 0 THEN 'Passed' ELSE 'Failed' END AS dataqualityevaluationresult, "
            f"'{RUN['corelation_id']}' AS corelation_id FROM o")


@query("Q09_row_outcomes", sql=_row_outcomes_sql())
def q09(spark, sf):
    rows = Q.row_outcomes(dq_input(spark, sf, "lineitem"), spark_rules(_ROW_RULES_LINE), RUN)
    return rows.select("concat_primary", F.array_join("dataqualityrulespass", "|").alias("passed"),
                       F.array_join("dataqualityrulesfail", "|").alias("failed"),
                       "dataqualityevaluationresult", "corelation_id")


def _overall_sql(union_sql: str, run=RUN) -> str:
    return (f"WITH u AS ({union_sql}) SELECT * FROM u UNION ALL "
            f"SELECT '{Q.OVERALL_RULE}' AS rule, CASE WHEN sum(CASE WHEN outcome = 'Failed' THEN 1 ELSE 0 END) >= 1 "
            "THEN 'Failed' ELSE 'Passed' END AS outcome, NULL AS failurereason, NULL AS actual_value, "
            "NULL AS evaluatedmetrics, NULL AS passcnt, NULL AS failcnt, "
            f"'{run['corelation_id']}' AS corelation_id, source, '{run['year']}' AS year, '{run['month']}' AS month, "
            f"'{run['day']}' AS day, TIMESTAMP '{run['audit_ts']}' AS audittimestamp FROM u GROUP BY source")


def quality_run(spark, sf, run=RUN, as_of=AS_OF):
    """Five table rule sets evaluated, overall row per source appended."""
    from functools import reduce
    # each source's outcomes are written once (as the source writes them before the
    # overall status is derived); a rule set that cannot be evaluated is a Failed row
    outs = [Q.evaluate_or_fail(dq_input(spark, sf, s), spark_rules(DQ_SOURCES[s][3], as_of), dict(run, source=s)) for s in DQ_SOURCES]
    allo = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outs)
    return Q.with_overall(allo, run)


_Z16_SQL = _overall_sql(" UNION ALL ".join(_outcomes_sql(s) for s in DQ_SOURCES))


@query("Z16_Q11_quality_run", sql=_Z16_SQL)
def z16(spark, sf):
    return quality_run(spark, sf)


@query("Q13_run_complete", sql=f"""
WITH o AS ({_Z16_SQL})
SELECT CAST(count(DISTINCT source) AS BIGINT) AS completed_job_cnt, CAST(5 AS BIGINT) AS expected_job_cnt,
       count(DISTINCT source) >= 5 AS run_complete
FROM o WHERE corelation_id = '{RUN['corelation_id']}'""")
def q13(spark, sf):
    return Q.run_complete(quality_run(spark, sf), RUN["corelation_id"], 5)


@query("Q14_run_report", sql=f"""
WITH o AS ({_Z16_SQL})
SELECT source, day || '-' || month || '-' || year AS run_date,
       CASE WHEN sum(CASE WHEN outcome = 'Passed' THEN 0 WHEN outcome = 'Failed' THEN 1 END) >= 1
            THEN 'Failed' ELSE 'Passed' END AS result
FROM o WHERE corelation_id = '{RUN['corelation_id']}' GROUP BY source, day, month, year""")
def q14(spark, sf):
    return Q.run_report(quality_run(spark, sf), RUN["corelation_id"])


_OLD_AS_OF = dt.datetime(1998, 1, 1)


@query("Q16_gate", sql=f"""
WITH o AS (SELECT * FROM ({_Z16_SQL}) UNION ALL SELECT * FROM ({_overall_sql(" UNION ALL ".join(
    _outcomes_sql(s, RUN_OLD, _OLD_AS_OF) for s in DQ_SOURCES), RUN_OLD)})),
ov AS (SELECT source, outcome, audittimestamp FROM o WHERE rule = '{Q.OVERALL_RULE}'),
l AS (SELECT * FROM ov WHERE audittimestamp = (SELECT max(audittimestamp) FROM ov x WHERE x.source = ov.source))
SELECT CAST(count(*) FILTER (WHERE outcome = 'Failed') AS BIGINT) AS failed_sources,
       CAST(count(DISTINCT source) AS BIGINT) AS sources,
       CASE WHEN count(*) FILTER (WHERE outcome = 'Failed') > 0 THEN 'Failed' ELSE 'Passed' END AS gate
FROM l""")
def q16(spark, sf):
    """Gate over two runs: an older run (rules as of 1998) and the current
    run; only each source's latest overall status counts."""
    new = quality_run(spark, sf)
    old = quality_run(spark, sf, RUN_OLD, _OLD_AS_OF)
    return Q.gate(new.unionByName(old))


# feature-quality dashboard (Z17): rule metadata joined to outcomes
FEATURE_META = [
    ("part_name", "count", "Number", 1.0, 4000.0, ("distinct", "part_name", 0, 4000)),
    ("data_from", "count", "Number", 1.0, 4000.0, ("distinct", "data_from", 0, 4)),
    ("part_probability", "min", "Number", 0.1, 1.0,
     ("custom", "select min(part_probability) from primary", -0.000001, 1.000001)),
]
FEATURE_SOURCE = (
    "lineitem",
    "p_name AS part_name, l_returnflag AS data_from, l_discount * 10 AS part_probability",
    "p_name AS part_name, l_returnflag AS data_from, l_discount * 10 AS part_probability",
    [m[5] for m in FEATURE_META])


def _features_input(spark, sf):
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    return j.select(F.col("p_name").alias("part_name"), F.col("l_returnflag").alias("data_from"),
                    (F.col("l_discount") * 10).alias("part_probability"))


def _meta_values_sql() -> str:
    rows = []
    for v, rt, unit, lo, hi, spec in FEATURE_META:
        text = _rule_sql(spec, AS_OF)[0]
        rows.append(f"({_lit(v)}, {_lit(rt)}, {_lit(unit)}, {lo}, {hi}, {_lit(text)})")
    return ", ".join(rows)


_FEAT_OUT = _outcomes_sql("features", spec=FEATURE_SOURCE).replace("FROM lineitem)", "FROM lineitem JOIN part ON l_partkey = p_partkey)", 1)


@query("Z17_Q15_feature_quality", sql=f"""
WITH o AS {_FEAT_OUT},
meta AS (SELECT * FROM (VALUES {_meta_values_sql()})
         m(variablename, ruletype, unit, minthreshold, maxthreshold, rule))
SELECT meta.*, source, outcome, failurereason, evaluatedmetrics, actual_value, passcnt, failcnt, audittimestamp,
       'weekly' AS job_frequency, 'forecast' AS solution_type, 'quality' AS solution_category
FROM meta JOIN o ON o.rule = meta.rule""")
def z17(spark, sf):
    rules = [spark_rule(m[5]) for m in FEATURE_META]
    out = Q.evaluate(_features_input(spark, sf), rules, dict(RUN, source="features"))
    meta = spark.createDataFrame(
        [(v, rt, unit, lo, hi, r.text) for (v, rt, unit, lo, hi, _), r in zip(FEATURE_META, rules)],
        "variablename string, ruletype string, unit string, minthreshold double, maxthreshold double, rule string")
    e = Q.enrich_outcomes(out, meta, "weekly", "forecast", "quality")
    return e.select("variablename", "ruletype", "unit", "minthreshold", "maxthreshold", "rule", "source",
                    "outcome", "failurereason", "evaluatedmetrics", "actual_value", "passcnt", "failcnt",
                    "audittimestamp", "job_frequency", "solution_type", "solution_category")



@query("Q12_failed_evaluation", sql=f"""
SELECT 'wf-2024-02-01' AS corelation_id, 'nation' AS source, '{Q.OVERALL_RULE}' AS rule, 'Failed' AS outcome, TRUE AS has_reason,
       (SELECT CAST(count(*) AS BIGINT) FROM nation WHERE n_nationkey IS NOT NULL) AS good_passcnt""")
def q12(spark, sf):
    """A rule set over a column that is not there gives one failure row; the
    same table's good rule set still evaluates."""
    n = table(spark, sf, "nation")
    bad = Q.evaluate_or_fail(n, [Q.is_complete("no_such_column")], dict(RUN, source="nation"))
    good = Q.evaluate_or_fail(n, [Q.is_complete("n_nationkey")], dict(RUN, source="nation"))
    cnt = good.agg(F.max("passcnt")).scalar()
    return bad.select("corelation_id", "source", "rule", "outcome", (F.length("failurereason") > 0).alias("has_reason"),
                      cnt.alias("good_passcnt"))
