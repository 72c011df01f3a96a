"""Declarative data-quality rules.

A :class:`Rule` carries aggregate metric expressions, an outcome test over
those metrics, and (for row-level rules) a per-row pass predicate.  A rule set is
evaluated with one aggregate over the input, one map-side combined count per column
that a rule counts by key (from which a primary-key rule takes its pass count
without joining back), and one scalar query per custom-SQL rule.

Rule kinds (after the public rule language the source system used):
``IsComplete``, ``Completeness``, ``IsPrimaryKey``, ``ColumnDataType``,
``ColumnValues``, ``DistinctValuesCount``, ``CustomSql`` and the
conjunction of rules in one line.  The evaluator itself is not in the
source; these choices are ours: nulls are ignored by ``ColumnDataType`` and
fail ``ColumnValues``; ``ColumnValues ... between`` is inclusive,
``DistinctValuesCount``/``CustomSql ... between`` are exclusive; only
row-level rules get pass/fail counts.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.readers import read_query

from tessera.functions import values as V
from tessera.operators import windows as W

OVERALL_RULE = "dq_overall_status"


@dataclass
class Rule:
    text: str
    metrics: list[tuple[str, Column]]
    check: Callable[[dict[str, Column]], Column]
    row: Column | None = None
    key_counts: list[str] = field(default_factory=list)
    custom_sql: str | None = None
    unique_key: str | None = None  # the row rule is "not null and unique" of this column


def _q(c: str) -> str:
    return f'"{c}"'


def _cmp(x: Column, op: str, v) -> Column:
    v = F.lit(v)
    return {">": x > v, ">=": x >= v, "<": x < v, "<=": x <= v, "=": x == v, "!=": x != v}[op]


def _fmt(v) -> str:
    return f'"{v}"' if isinstance(v, str) else str(v)


def is_complete(c: str) -> Rule:
    m = f"Column.{c}.Completeness"
    return Rule(f"IsComplete {_q(c)}",
                [(m, F.count(c) / F.count(F.lit(1)))],
                lambda ms: ms[m] == 1.0,
                row=F.col(c).isNotNull())


def completeness(c: str, op: str, t: float) -> Rule:
    m = f"Column.{c}.Completeness"
    return Rule(f"Completeness {_q(c)} {op} {t}",
                [(m, F.count(c) / F.count(F.lit(1)))],
                lambda ms: _cmp(ms[m], op, t))


def is_primary_key(c: str) -> Rule:
    mc, mu = f"Column.{c}.Completeness", f"Column.{c}.Uniqueness"
    return Rule(f"IsPrimaryKey {_q(c)}",
                [(mc, F.count(c) / F.count(F.lit(1))),
                 (mu, ("distinct_ratio", c))],
                lambda ms: (ms[mc] == 1.0) & (ms[mu] == 1.0),
                row=F.col(c).isNotNull() & (F.col(f"_kc_{c}") == 1),
                key_counts=[c], unique_key=c)


_TYPES = {"date": "date", "float": "double", "integer": "int", "int": "int",
          "timestamp": "timestamp", "string": "string", "long": "bigint"}


def has_type(c: str, t: str) -> Rule:
    to = _TYPES[t.lower()]
    ok = F.col(c).isNull() | F.col(c).cast("string").try_cast(to).isNotNull()
    m = f"Column.{c}.ColumnDataType.Compliance"
    return Rule(f"ColumnDataType {_q(c)} = {_fmt(t)}",
                [(m, F.count_if(ok) / F.count(F.lit(1)))],
                lambda ms: ms[m] == 1.0, row=ok)


def values_between(c: str, lo, hi, as_of=None) -> Rule:
    """``ColumnValues c between lo and hi`` (inclusive); ``hi=None`` means
    the run time ``as_of`` (the source wrote ``now()``)."""
    hi_v = hi if hi is not None else as_of
    x = F.col(c)
    ok = F.coalesce(x.between(_typed(F.lit(lo), lo), _typed(F.lit(hi_v), hi_v)), F.lit(False))
    m = f"Column.{c}.ColumnValues.Compliance"
    text_hi = "now()" if hi is None else _fmt(hi)
    return Rule(f"ColumnValues {_q(c)} between {_fmt(lo)} and {text_hi}",
                [(m, F.count_if(ok) / F.count(F.lit(1)))],
                lambda ms: ms[m] == 1.0, row=ok)


def values_cmp(c: str, op: str, v=None, as_of=None) -> Rule:
    """``ColumnValues c <op> v``; ``v=None`` means ``now()`` (= ``as_of``)."""
    val = v if v is not None else as_of
    ok = F.coalesce(_cmp(F.col(c), op, _typed(F.lit(val), val)), F.lit(False))
    m = f"Column.{c}.ColumnValues.Compliance"
    text_v = "now()" if v is None else _fmt(v)
    return Rule(f"ColumnValues {_q(c)} {op} {text_v}",
                [(m, F.count_if(ok) / F.count(F.lit(1)))],
                lambda ms: ms[m] == 1.0, row=ok)


def distinct_count(c: str, lo, hi) -> Rule:
    m = f"Column.{c}.DistinctValuesCount"
    return Rule(f"DistinctValuesCount {_q(c)} between {lo} and {hi}",
                [(m, ("distinct", c))],
                lambda ms: (ms[m] > lo) & (ms[m] < hi), key_counts=[c])


def custom_sql(sql: str, lo, hi) -> Rule:
    """``CustomSql "<select over primary>" between lo and hi`` (exclusive)."""
    m = "Dataset.*.CustomSQL"
    return Rule(f"CustomSql {_q(sql)} between {lo} and {hi}", [(m, None)],
                lambda ms: (ms[m] > lo) & (ms[m] < hi), custom_sql=sql)


def all_of(*rules: Rule) -> Rule:
    """Conjunction of rules on one rule line: ``(r1) and (r2)``."""
    checks = [r.check for r in rules]
    rows = [r.row for r in rules]
    row = reduce(lambda a, b: a & b, rows) if all(r is not None for r in rows) else None
    return Rule(" and ".join(f"({r.text})" for r in rules),
                [m for r in rules for m in r.metrics],
                lambda ms: reduce(lambda a, b: a & b, [c(ms) for c in checks]),
                row=row, key_counts=[k for r in rules for k in r.key_counts],
                custom_sql=next((r.custom_sql for r in rules if r.custom_sql), None))


def _typed(c: Column, v) -> Column:
    if isinstance(v, _dt.datetime):
        return c.cast("timestamp_ntz")
    if isinstance(v, _dt.date):
        return c.cast("date")
    return c


def _groups(df: DataFrame, rules) -> dict:
    """One ``groupBy(c).count()`` per column that a rule counts by key; it
    serves the row-level primary-key test (joined back) and the distinct
    count (a scalar subquery over it), so no ``count(DISTINCT)`` expands
    the rows."""
    keys = sorted({k for r in rules for k in r.key_counts})
    return {k: df.groupBy(k).agg(F.count(F.lit(1)).alias(f"_kc_{k}")) for k in keys}


def _prepare(df: DataFrame, rules, groups: dict | None = None) -> DataFrame:
    groups = _groups(df, rules) if groups is None else groups
    for k, g in groups.items():
        if any(k in r.key_counts and r.row is not None for r in rules):
            g2 = g.withColumnRenamed(k, f"_gk_{k}")
            df = df.join(g2, df[k].eqNullSafe(g2[f"_gk_{k}"]), "inner").drop(f"_gk_{k}")
    return df


def row_outcomes(df: DataFrame, rules, run: dict | None = None) -> DataFrame:
    """Per row: arrays of passed / failed row-level rules and an overall
    row result, plus run columns."""
    return _row_results(_prepare(df, rules), rules, run)


def _row_results(p: DataFrame, rules, run: dict | None) -> DataFrame:
    rr = [r for r in rules if r.row is not None]
    passed = F.filter(F.array(*[F.when(r.row, F.lit(r.text)) for r in rr]), lambda x: x.isNotNull())
    failed = F.filter(F.array(*[F.when(~r.row, F.lit(r.text)) for r in rr]), lambda x: x.isNotNull())
    out = p.withColumn("dataqualityrulespass", passed).withColumn("dataqualityrulesfail", failed) \
        .withColumn("dataqualityevaluationresult",
                    F.when(F.size("dataqualityrulesfail") == 0, "Passed").otherwise("Failed"))
    out = out.drop(*[c for c in out.columns if c.startswith("_kc_")])
    return _with_run(out, run)


def _with_run(df: DataFrame, run: dict | None) -> DataFrame:
    if not run:
        return df
    cols = {}
    if "corelation_id" in run:
        cols["corelation_id"] = F.lit(run["corelation_id"])
    for k in ("source", "year", "month", "day"):
        if k in run:
            cols[k] = F.lit(run[k])
    if "audit_ts" in run:
        cols["audittimestamp"] = F.lit(run["audit_ts"]).cast("timestamp_ntz")
    return df.withColumns(cols)


def evaluate(df: DataFrame, rules, run: dict | None = None, digits: int = 6) -> DataFrame:
    """Consolidated outcomes: one row per rule with outcome, failure reason,
    evaluated metrics (text of the metric map), actual value, pass and fail
    counts (row-level rules only) and run columns.  Key counts are joined back to the
    rows only for a conjunction that holds a primary-key rule.
    """
    spark = df.sparkSession
    groups = _groups(df, rules)
    p = _prepare(df, [r for r in rules if not r.unique_key], groups)
    # per counted column: distinct values, and rows whose value is unique
    keys = {c: g.agg(F.struct(F.count(c).alias("distinct"), F.count_if(
        F.col(c).isNotNull() & (F.col(f"_kc_{c}") == 1)).alias("unique"))).scalar() for c, g in groups.items()}
    aggs, names, later = [F.count(F.lit(1)).alias("_rows")], {}, {}
    for i, r in enumerate(rules):
        for j, (mname, expr) in enumerate(r.metrics):
            alias = f"_m{i}_{j}"
            names[(i, j)] = alias
            if expr is None or isinstance(expr, tuple):
                later[alias] = expr
                continue
            aggs.append(expr.cast("double").alias(alias))
        if r.row is not None and not r.unique_key:
            aggs.append(F.count_if(r.row).alias(f"_p{i}"))
            aggs.append(F.count_if(~r.row).alias(f"_f{i}"))
    one = p.agg(*aggs)
    for i, r in enumerate(rules):
        if r.unique_key:
            one = one.withColumn(f"_p{i}", keys[r.unique_key].getField("unique")) \
                .withColumn(f"_f{i}", F.col("_rows") - F.col(f"_p{i}"))
    # values that are not aggregates of the rows: scalar subqueries (distinct
    # counts over the key-group tables, custom SQL over the view "primary")
    for i, r in enumerate(rules):
        for j, (mname, expr) in enumerate(r.metrics):
            alias = names[(i, j)]
            if alias not in later:
                continue
            if expr is None:
                val = read_query(spark, r.custom_sql, {"primary": df})
                col = val.select(F.col(val.columns[0]).cast("double")).scalar()
            else:
                kind, c = expr
                col = keys[c].getField("distinct").cast("double")
                if kind == "distinct_ratio":
                    col = col / F.col("_rows")
            one = one.withColumn(alias, col)
    return _outcomes(one, rules, names, run, digits)


def _outcomes(one: DataFrame, rules, names: dict, run: dict | None, digits: int) -> DataFrame:
    """A row per rule from the one row of metrics and counts."""
    structs = []
    for i, r in enumerate(rules):
        raw = {mname: F.col(names[(i, j)]) for j, (mname, _) in enumerate(r.metrics)}
        ms = {k: F.round(v, digits) for k, v in raw.items()}
        ok = F.coalesce(r.check(raw), F.lit(False))
        mmap = F.create_map(*[x for k, v in ms.items() for x in (F.lit(k), v)])
        structs.append(F.struct(
            F.lit(r.text).alias("rule"),
            F.when(ok, "Passed").otherwise("Failed").alias("outcome"),
            F.when(ok, F.lit(None).cast("string"))
            .otherwise(F.lit("Rule failed: " + r.text)).alias("failurereason"),
            mmap.alias("m"),
            (F.col(f"_p{i}") if r.row is not None else F.lit(None)).cast("bigint").alias("passcnt"),
            (F.col(f"_f{i}") if r.row is not None else F.lit(None)).cast("bigint").alias("failcnt")))
    res = one.select(F.explode(F.array(*structs)).alias("o")).select("o.*")
    res = res.select("rule", "outcome", "failurereason",
                     V.actual_value("m").alias("actual_value"),
                     F.col("m").cast("string").alias("evaluatedmetrics"), "passcnt", "failcnt")
    return _with_run(res, run)


def evaluate_rows(df: DataFrame, rules, path: str, run: dict | None = None, digits: int = 6) -> DataFrame:
    """:func:`row_outcomes` written to ``path`` and :func:`evaluate` returned, from
    one pass over the rows: the metrics are observed while the rows are written.

    Besides that pass there is one map-side combined count per column that a rule
    counts by key, and a query per custom SQL.  What reaches the driver is a number
    per metric.  A write that fails gives no outcomes."""
    from tessera.session import cut_lineage
    groups = {k: cut_lineage(g) for k, g in _groups(df, rules).items()}
    p = _prepare(df, rules, groups)
    aggs, names, later = [F.count(F.lit(1)).alias("_rows")], {}, {}
    for i, r in enumerate(rules):
        for j, (_, expr) in enumerate(r.metrics):
            names[(i, j)] = alias = f"_m{i}_{j}"
            if expr is None or isinstance(expr, tuple):
                later[alias] = (r, expr)
            else:
                aggs.append(expr.cast("double").alias(alias))
        if r.row is not None:
            aggs += [F.count_if(r.row).alias(f"_p{i}"), F.count_if(~r.row).alias(f"_f{i}")]
    seen = Observation()
    rows = _row_results(p.observe(seen, *aggs), rules, run)
    rows.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    if spark.read.schema(rows.schema).parquet(path).isEmpty():
        return evaluate(df, rules, run, digits)  # the observation of a plan known to be empty never ends
    values = seen.get
    one = spark.range(1).select(*[F.lit(values[a]).cast("bigint" if a[1] in "rpf" else "double").alias(a)
                                  for a in ("_rows", *names.values(), *(f"_{k}{i}" for i, r in enumerate(rules) if r.row is not None for k in "pf"))
                                  if a not in later])
    for alias, (r, expr) in later.items():
        if expr is None:
            val = read_query(spark, r.custom_sql, {"primary": df})
            one = one.withColumn(alias, val.select(F.col(val.columns[0]).cast("double")).scalar())
        else:
            kind, c = expr
            distinct = groups[c].agg(F.count(c).cast("double")).scalar()
            one = one.withColumn(alias, distinct / F.col("_rows") if kind == "distinct_ratio" else distinct)
    return _outcomes(one, rules, names, run, digits)


def with_overall(outcomes: DataFrame, run: dict | None = None,
                 rule_name: str = OVERALL_RULE) -> DataFrame:
    """Append one overall-status row per source: Failed if any rule failed."""
    st = outcomes.groupBy("source").agg(
        F.sum(F.when(F.col("outcome") == "Failed", 1).otherwise(0)).alias("_s"))
    overall = st.select("source", F.lit(rule_name).alias("rule"),
                        F.when(F.col("_s") >= 1, "Failed").otherwise("Passed").alias("outcome"))
    overall = _with_run(overall, {k: v for k, v in (run or {}).items() if k != "source"})
    from tessera.operators.sets import union_overall
    return union_overall(outcomes, overall)


def evaluate_or_fail(df: DataFrame, rules, run: dict, digits: int = 6) -> DataFrame:
    """:func:`evaluate` written to the shared checkpoint folder; if the
    evaluation fails (a rule names a column that is not there, custom SQL does not
    run), the single failure row instead, so that a run always has an outcome."""
    from tessera.session import cut_lineage
    try:
        return cut_lineage(evaluate(df, rules, run, digits))
    except Exception as e:  # noqa: BLE001  any failure of the evaluation is the outcome
        return failure_row(df.sparkSession, run, f"{type(e).__name__}: {str(e).splitlines()[0][:200]}")


def failure_row(spark, run: dict, reason: str) -> DataFrame:
    """The single outcome row written when the evaluation itself fails."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (
        "corelation_id", "source", "actual_value", "rule", "outcome", "failurereason",
        "evaluatedmetrics")] + [T.StructField("passcnt", T.LongType()),
                                T.StructField("failcnt", T.LongType())] +
        [T.StructField(n, T.StringType()) for n in ("year", "month", "day")])
    row = (run.get("corelation_id"), run.get("source"), None, OVERALL_RULE, "Failed", reason,
           None, None, None, run.get("year"), run.get("month"), run.get("day"))
    return spark.createDataFrame([row], schema)


def run_complete(outcomes: DataFrame, run_id: str, expected: int) -> DataFrame:
    """Distinct sources finished in a run vs the expected count (one row)."""
    return outcomes.filter(F.col("corelation_id") == run_id).agg(
        F.count_distinct("source").cast("bigint").alias("completed_job_cnt")) \
        .withColumn("expected_job_cnt", F.lit(expected).cast("bigint")) \
        .withColumn("run_complete", F.col("completed_job_cnt") >= F.col("expected_job_cnt"))


def run_report(outcomes: DataFrame, run_id: str) -> DataFrame:
    """Passed/Failed per source and run date (``d-m-yyyy`` text)."""
    x = outcomes.filter(F.col("corelation_id") == run_id)
    g = x.groupBy("source", "day", "month", "year").agg(
        F.sum(F.when(F.col("outcome") == "Passed", 0).when(F.col("outcome") == "Failed", 1)).alias("_v"))
    return g.select("source", F.concat_ws("-", F.col("day").cast("string"), F.col("month").cast("string"),
                                          F.col("year").cast("string")).alias("run_date"),
                    F.when(F.col("_v") >= 1, "Failed").otherwise("Passed").alias("result"))


def enrich_outcomes(outcomes: DataFrame, meta: DataFrame, job_frequency: str,
                    solution_type: str, solution_category: str) -> DataFrame:
    """Join outcomes with rule metadata (thresholds, units) on the rule text
    and add job descriptors."""
    # rule metadata: one row per declared rule (configuration, fixed size)
    m = F.broadcast(meta)
    return m.join(outcomes, "rule", "inner").withColumns({
        "job_frequency": F.lit(job_frequency), "solution_type": F.lit(solution_type),
        "solution_category": F.lit(solution_category)})


def gate(outcomes: DataFrame, rule_name: str = OVERALL_RULE) -> DataFrame:
    """Latest overall status per source (by audit time); the gate fails when
    any source's latest status is Failed.  One row: failed source count,
    source count and the gate result.

    One aggregation, no self-join: per source ``max_by(failed, (ts, failed))``
    is 1 when any row at the latest audit time failed (ties as ``rank() = 1``).
    """
    ov = outcomes.filter(F.col("rule") == rule_name) \
        .select("source", F.when(F.col("outcome") == "Failed", 1).otherwise(0).alias("_f"),
                "audittimestamp")
    per = ov.groupBy("source").agg(
        F.max_by(F.col("_f"), F.struct(F.col("audittimestamp"), F.col("_f"))).alias("_lf"))
    return per.agg(F.sum("_lf").cast("bigint").alias("failed_sources"),
                   F.count(F.lit(1)).cast("bigint").alias("sources")) \
        .withColumn("failed_sources", F.coalesce(F.col("failed_sources"), F.lit(0).cast("bigint"))) \
        .withColumn("gate", F.when(F.col("failed_sources") > 0, "Failed").otherwise("Passed"))
