"""Aggregations.  All are ``groupBy().agg()`` plans, so Spark runs a
partial (map-side) aggregate before the shuffle: a hot key is reduced to
one row per map task before it moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_sum(df: DataFrame, keys, measure: str, out: str = "count",
              cast: str | None = None) -> DataFrame:
    """pandas ``groupby(keys).sum()``: rows with a null key are dropped, a
    group whose measures are all null sums to 0."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    s = F.coalesce(F.sum(measure), F.lit(0))
    if cast:
        s = s.cast(cast)
    return df.filter(cond).groupBy(*keys).agg(s.alias(out))


def max_per_key(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(out or value))


def count_distinct(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.agg(F.countDistinct(col).cast("bigint").alias(out))


def failed_flag(outcome: str = "outcome") -> Column:
    """1 for Failed, 0 for Passed, null otherwise."""
    o = F.col(outcome)
    return F.when(o == "Failed", 1).when(o == "Passed", 0)


def status_rollup(df: DataFrame, keys, outcome: str = "outcome", out: str = "result") -> DataFrame:
    """Passed/Failed per group: Failed when any row failed."""
    return df.groupBy(*keys).agg(F.sum(failed_flag(outcome)).alias("_val")) \
        .withColumn(out, F.when(F.col("_val") >= 1, "Failed").otherwise("Passed")).drop("_val")


def duplicate_groups(df: DataFrame, keys, out: str = "n") -> DataFrame:
    """``GROUP BY keys HAVING count(*) > 1``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def count_exploded(df: DataFrame, array_col: str, out_key: str, out: str = "n") -> DataFrame:
    """Explode an array column and count rows per element."""
    return df.select(F.explode(array_col).alias(out_key)).groupBy(out_key) \
        .agg(F.count(F.lit(1)).alias(out))


def group_size(df: DataFrame, keys, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def metrics(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Global metrics (one row) from named aggregate expressions."""
    return df.agg(*[e.alias(n) for n, e in exprs.items()])


def run_summary(status: DataFrame, status_col: str = "status", ok: str = "Succeeded",
                failed: str = "Failed", start: str = "start_time", end: str = "end_time",
                model_col: str | None = None, keys=()) -> DataFrame:
    """Run totals: jobs, succeeded, failed, distinct models, elapsed seconds."""
    aggs = [F.count(F.lit(1)).alias("total_jobs"),
            F.count_if(F.col(status_col) == ok).alias("succeeded_jobs"),
            F.count_if(F.col(status_col) == failed).alias("failed_jobs"),
            (F.max(end) - F.min(start)).alias("elapsed_seconds")]
    if model_col:
        aggs.append(F.countDistinct(model_col).cast("bigint").alias("models"))
    g = status.groupBy(*keys) if keys else status
    return g.agg(*aggs)


def count_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a change and their difference (one row;
    both counts are scalar subqueries, no join)."""
    b = before.agg(F.count(F.lit(1))).scalar()
    a = after.agg(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(
        b.alias("rows_before"), a.alias("rows_after"), (b - a).alias("rows_removed"))


DISTINCT_ROWS = 250_000  # rows that a task of distinct_rows compares


def distinct_rows(df: DataFrame, n_rows: int) -> DataFrame:
    """A03 for rows that hardly repeat: dealt by all columns to as many tasks as ``n_rows`` (at least the
    rows of ``df``) need, so that what a task holds does not grow with the table and no
    column's hot value meets in one."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // DISTINCT_ROWS))
    return df.repartition(n, *df.columns).distinct()
