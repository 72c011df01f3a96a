"""Window-style operators, written so that no group is gathered whole
into one task where an aggregate + join-back does the same job.

* per-key counts / maxima: ``groupBy`` (partial aggregation) + join back,
  which AQE's skew-join handling can split when one key is hot;
* keep-one-row-per-key: ``max_by`` aggregation (partial) instead of
  ``row_number() = 1`` over a partition;
* top-N per group: ``rank() <= N`` — Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
  N ranks per group;
* forward fill: split each key into ordered buckets, fill inside buckets,
  carry the last value of earlier buckets from a small per-bucket table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _null_safe_on(a: DataFrame, b: DataFrame, keys, b_keys=None) -> Column:
    b_keys = b_keys or keys
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[bk]) for k, bk in zip(keys, b_keys)])


def topn_rank(df: DataFrame, part, order: str, n: int, keys=None,
              ascending: bool = False) -> DataFrame:
    """``rank() over (partition by part order by order desc) <= n``; ties at
    rank n are kept (may exceed n); optional distinct projection ``keys``."""
    o = F.col(order).asc() if ascending else F.col(order).desc()
    w = Window.partitionBy(*part).orderBy(o)
    out = df.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") <= n).drop("_rk")
    return out.select(*keys).distinct() if keys else out


def winner(df: DataFrame, metric: str, name: str, keys=()) -> DataFrame:
    """Best row by ``metric`` (desc), ties broken by ``name`` (asc); rows with
    a null metric never win.

    Global: ``orderBy().limit(1)`` plans as TakeOrderedAndProject (top-1 per
    partition, then merge).  Per key: ``min_by`` aggregation (partial).
    """
    df = df.filter(F.col(metric).isNotNull())
    if not keys:
        return df.orderBy(F.col(metric).desc(), F.col(name).asc()).limit(1)
    cols = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*cols), F.struct(-F.col(metric), F.col(name)))
    return df.groupBy(*keys).agg(best.alias("_w")).select(*keys, "_w.*")


def latest_per(df: DataFrame, keys, ts: str) -> DataFrame:
    """Rows holding the latest ``ts`` per key (ties kept, as ``rank() = 1``)."""
    latest = df.groupBy(*[F.col(k).alias(f"_lp{i}") for i, k in enumerate(keys)]) \
        .agg(F.max(ts).alias("_lpts"))
    cond = _null_safe_on(df, latest, keys, [f"_lp{i}" for i in range(len(keys))]) \
        & (df[ts] == latest["_lpts"])
    return df.join(latest, cond, "left_semi")


def with_group_count(df: DataFrame, keys, out: str = "_n") -> DataFrame:
    """``count(*) over (partition by keys)`` as aggregate + null-safe join back."""
    cnt = df.groupBy(*[F.col(k).alias(f"_gc{i}") for i, k in enumerate(keys)]) \
        .agg(F.count(F.lit(1)).alias(out))
    cond = _null_safe_on(df, cnt, keys, [f"_gc{i}" for i in range(len(keys))])
    return df.join(cnt, cond, "inner").drop(*[f"_gc{i}" for i in range(len(keys))])


def dedup_prefer_updated(df: DataFrame, keys, ts: str) -> DataFrame:
    """Rows unique on ``keys`` stay; rows of duplicate groups stay only when
    ``ts`` is not null (null keys group together, as in pandas)."""
    return with_group_count(df, keys, "_n") \
        .filter((F.col("_n") == 1) | F.col(ts).isNotNull()).drop("_n")


def dedup_keep_max(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """One row per non-null ``key``: the one with the largest id; rows with a
    null key are untouched."""
    mx = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_dk")) \
        .agg(F.max(id_col).alias("_dmax"))
    j = df.join(mx, df[key] == mx["_dk"], "left")
    return j.filter(F.col("_dmax").isNull() | (F.col(id_col) == F.col("_dmax"))) \
        .drop("_dk", "_dmax")


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """Last row per key set by ``order`` (a column name or list; the list
    should make the order total).  ``max_by`` aggregation, partial per task."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [c for c in df.columns if c not in keys]
    ok = F.struct(*[F.col(o) for o in order])  # a struct is never null: rows with null order values come first
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), ok).alias("_kl")) \
        .select(*keys, *[F.col(f"_kl.{c}").alias(c) for c in cols])


def ffill(df: DataFrame, col: str, order, part=(), bucket: Column | None = None,
          out: str | None = None) -> DataFrame:
    """Forward fill of nulls in ``order`` within ``part``.

    The rows are cut into stretches of the order that tasks fill by themselves,
    so no task holds a whole key: by ``bucket`` (e.g. ``date_trunc('day', ts)``), which must
    be monotone in the order, else by range partitioning on key and order.  What
    a stretch lacks at its start is the last value before it, looked up in the
    key's list of the stretches' last values (one entry a stretch).
    """
    order = [order] if isinstance(order, str) else list(order)
    out = out or col
    part = list(part)
    if bucket is None:
        from tessera.session import cut_lineage
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # materialised, for the ranges come from a sample
        b = cut_lineage(df.repartitionByRange(n, *part, *order).withColumn("_fb", F.spark_partition_id()))
    else:
        b = df.withColumn("_fb", bucket)
    w_in = Window.partitionBy(*part, "_fb").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = b.withColumn("_fin", F.last(col, ignorenulls=True).over(w_in))
    okey = F.struct(*[F.col(o) for o in order]) if len(order) > 1 else F.col(order[0])
    last = b.filter(F.col(col).isNotNull()).groupBy(*part, "_fb").agg(F.max_by(F.col(col), okey).alias("_fv"))
    # null buckets come first, as in the order
    ends = F.array_sort(F.collect_list(F.struct(F.col("_fb").isNotNull().alias("ok"), F.col("_fb").alias("b"), F.col("_fv").alias("v"))))
    if part:
        # null part keys are groups like any other
        names = [f"_fk{i}" for i in range(len(part))]
        lists = last.groupBy(*[F.col(c).alias(k) for c, k in zip(part, names)]).agg(ends.alias("_fe"))
        res = inside.join(lists, _null_safe_on(inside, lists, part, names), "left").drop(*names)
    else:
        res = inside.withColumn("_fe", last.agg(ends).scalar())
    before = F.filter("_fe", lambda e: F.when(F.col("_fb").isNull(), F.lit(False)).otherwise(~e["ok"] | (e["b"] < F.col("_fb"))))
    carry = F.get(before, F.size(before) - 1)["v"]
    return res.withColumn(out, F.when(F.col("_fin").isNotNull(), F.col("_fin")).when(F.size("_fe") > 0, carry)) \
        .drop("_fb", "_fin", "_fe")


def best_label(scores: DataFrame, keys, label: str, score: str, pos: str | None = None,
               out_label: str = "label", out_score: str = "score") -> DataFrame:
    """Best label per key by score desc; ties -> lowest dictionary position
    (``pos``), else smallest label.  ``min_by`` aggregation (partial)."""
    tie = F.col(pos) if pos else F.col(label)
    order_key = F.struct(F.coalesce(-F.col(score), F.lit(float("inf"))), tie)
    best = F.min_by(F.struct(F.col(label).alias("l"), F.col(score).alias("s")), order_key)
    return scores.groupBy(*keys).agg(best.alias("_b")) \
        .select(*keys, F.col("_b.l").alias(out_label), F.col("_b.s").alias(out_score))


def top_k(df: DataFrame, part, order_cols, k: int) -> DataFrame:
    """``row_number() <= k`` per group (WindowGroupLimit applies)."""
    w = Window.partitionBy(*part).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
