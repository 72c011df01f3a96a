"""Join operators.

Design rules used throughout:

* equi-joins only — range, band and OR conditions are rewritten into
  equi-joins on a bucket or on each branch, so no nested-loop join;
* a side is broadcast only after :func:`bounded_broadcast` has checked the
  optimizer's size estimate against a byte bound; otherwise the join is left to the
  planner (sort-merge, and AQE may still switch to broadcast with runtime sizes);
* per-key statistics that a correlated subquery would compute are
  pre-aggregated with ``groupBy`` (map-side partial aggregation) and joined
  back, never computed with a one-partition window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Byte bound under which a dimension is broadcast (Spark's own limit is 8 GB).
DEFAULT_BROADCAST_BYTES = 64 << 20
# Rows of one key that a spread join leaves together.
CHUNK_ROWS = 200_000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a plan: read from its statistics each
    time, no job is run and nothing is remembered."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its estimated size is at most ``max_bytes``.

    Beyond the bound the frame is returned unchanged (shuffle join; AQE may
    still pick a broadcast from runtime sizes).  The result is the same either way.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether :func:`bounded_broadcast` would broadcast ``df``."""
    return estimated_bytes(df) <= max_bytes


def _on(a: DataFrame, b: DataFrame, a_keys, b_keys) -> Column:
    return reduce(lambda x, y: x & y, [a[k1] == b[k2] for k1, k2 in zip(a_keys, b_keys)])


def join(a: DataFrame, b: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Inner (or other) equi join on same-named keys."""
    return a.join(b, on=list(keys), how=how)


def left_distinct(a: DataFrame, b: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join to ``SELECT DISTINCT *`` of ``b`` (dedup before join)."""
    return a.join(b.distinct(), on=list(keys), how=how)


def left_chain(a: DataFrame, steps) -> DataFrame:
    """Left joins one after the other: ``steps`` are (table, key so far, its key)."""
    return reduce(lambda x, s: x.join(s[0], x[s[1]] == s[0][s[2]], "left"), steps, a)


def join_default_key(a: DataFrame, b: DataFrame, a_key: str, b_key: str,
                     default: str, how: str = "inner") -> DataFrame:
    """Equi join on ``coalesce(a_key, default) = b_key``; rows without a key all meet the
    default's, so a ``b`` too large to broadcast is joined by :func:`spread_join`."""
    if how not in ("inner", "left") or fits_broadcast(b):
        return a.join(bounded_broadcast(b), F.coalesce(a[a_key], F.lit(default)) == b[b_key], how)
    dealt = a.withColumn("_default_key", F.coalesce(a[a_key], F.lit(default)))
    return spread_join(dealt, b.withColumn("_default_key", F.col(b_key)), ["_default_key"], a.columns, how).drop("_default_key")


def spread_join(facts: DataFrame, other: DataFrame, keys, by, how: str = "inner", chunk_rows: int | None = None) -> DataFrame:
    """Inner or left equi join on same-named ``keys``, any of which may hold most of ``facts``.

    Keys of more than ``chunk_rows`` rows are counted (map-side) and listed: at most
    the rows divided by ``chunk_rows``, so the list is broadcast.  Their rows are dealt to
    chunks by the hash of the columns ``by``, which should tell rows apart, and their rows of ``other`` are
    repeated for each chunk; all other keys are joined as they are."""
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be spread")
    keys, chunk_rows = list(keys), chunk_rows or CHUNK_ROWS
    hot = facts.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("_chunks")).filter("_chunks > 1")
    dealt = facts.join(F.broadcast(hot), keys, "left") \
        .withColumn("_chunk", F.coalesce(F.pmod(F.xxhash64(*by), "_chunks"), F.lit(0).cast("bigint"))).drop("_chunks")
    spread = other.join(F.broadcast(hot), keys, "left") \
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_chunks", F.lit(1).cast("bigint")) - 1))).drop("_chunks")
    return dealt.join(spread, [*keys, "_chunk"], how).drop("_chunk")


def semi_join(a: DataFrame, b: DataFrame, a_key: str, b_key: str | None = None) -> DataFrame:
    """Inner join used only as an existence test -> LEFT SEMI."""
    b_key = b_key or a_key
    return a.join(b, a[a_key] == b[b_key], "left_semi")


def anti_join(a: DataFrame, b: DataFrame, a_key: str, b_key: str | None = None) -> DataFrame:
    b_key = b_key or a_key
    return a.join(b, a[a_key] == b[b_key], "left_anti")


def range_join(facts: DataFrame, ranges: DataFrame, x: str, lo: str, hi: str,
               bucket: str = "month", width: float | None = None,
               how: str = "inner", bounds: DataFrame | None = None, clamp: bool = True) -> DataFrame:
    """Join each fact to every range with ``lo <= x <= hi`` via an equi bucket.

    Ranges are exploded into the buckets they touch (``month`` buckets for
    dates/timestamps, or numeric buckets of ``width``; by default the median width
    of the ranges), clamped to the facts' own minimum and maximum (a scalar subquery), so an open-ended
    range has no more buckets than the facts span; ``bounds`` names a cheaper table
    with the same column ``x`` (the facts before other joins) to take them from, and
    ``clamp=False`` spares that scan where all ranges are known to be short (a calendar).  Facts carry their own
    bucket; the join is an equi-join on the bucket with the exact ``between``
    as a residual filter.  A fact with a null ``x`` matches nothing (inner)
    or keeps null range columns (left).
    """
    if bucket == "month":
        fb = F.trunc(F.to_date(F.col(x)), "month")
        low, high, step = F.trunc(F.to_date(F.col(lo)), "month"), F.trunc(F.to_date(F.col(hi)), "month"), F.expr("interval 1 month")
    else:
        if width is None:
            span = ranges.agg(F.percentile_approx(F.col(hi).cast("double") - F.col(lo).cast("double"), 0.5)).scalar()
            w = F.when(span > 0, span).otherwise(F.lit(1.0))
        elif width <= 0:
            raise ValueError("the bucket width must be positive")
        else:
            w = F.lit(float(width))
        number = lambda c: F.floor(F.col(c) / w).cast("bigint")
        fb, low, high, step = number(x), number(lo), number(hi), F.lit(1).cast("bigint")
    f = facts.withColumn("_fbucket", fb)
    if clamp:
        seen = (facts if bounds is None else bounds).agg(F.struct(F.min(fb).alias("lo"), F.max(fb).alias("hi"))).scalar()
        low, high = F.greatest(low, seen.getField("lo")), F.least(high, seen.getField("hi"))
    r = ranges.withColumns({"_rlo": low, "_rhi": high})
    r = r.filter("_rlo <= _rhi").withColumn("_rbucket", F.explode(F.sequence("_rlo", "_rhi", step))).drop("_rlo", "_rhi")
    cond = (f["_fbucket"] == r["_rbucket"]) & f[x].between(r[lo], r[hi])
    return f.join(r, cond, how).drop("_fbucket", "_rbucket")


def band_join(facts: DataFrame, bands: DataFrame, x: str, lo: str, hi: str,
              width: float | None = None, null_as: float | None = -1, how: str = "inner",
              bounds: DataFrame | None = None) -> DataFrame:
    """Band join on a numeric value, null mapped to ``null_as`` first."""
    tmp = "_band_x"
    val = F.col(x) if null_as is None else F.coalesce(F.col(x), F.lit(null_as))
    f = facts.withColumn(tmp, val.cast("double"))
    b = None if bounds is None else bounds.withColumn(tmp, val.cast("double"))
    return range_join(f, bands, tmp, lo, hi, bucket="numeric", width=width, how=how, bounds=b).drop(tmp)


def or_join(a: DataFrame, b: DataFrame, a_key: str, b_keys: tuple[str, str],
            how: str = "inner") -> DataFrame:
    """``a.k = b.k1 OR a.k = b.k2`` as one equi-join (no nested loop): each row
    of ``b`` is exploded into its distinct non-null keys, so a pair appears once."""
    k1, k2 = b_keys
    keys = F.array_compact(F.array_distinct(F.array(b[k1], b[k2])))
    kb = b.withColumn("_or_key", F.explode(keys))
    return a.join(kb, a[a_key] == kb["_or_key"], how).drop("_or_key")


def join_cast_key(a: DataFrame, b: DataFrame, a_key: str, b_key: str,
                  how: str = "left", to: str = "int") -> DataFrame:
    """Equi join on text keys compared as integers (bad text -> no match)."""
    return a.join(b, a[a_key].try_cast(to) == b[b_key].try_cast(to), how)


def pick_causal_line(claims: DataFrame, lines: DataFrame, claim_keys, line_keys,
                     claim_count_keys, line_count_keys, flag: str,
                     multi_flags=("X",), single_flags=("X", "L")) -> DataFrame:
    """Choose the causal line of each claim (correlated count in JOIN ON).

    Group of more than one line (counted on ``count_keys`` over **all**
    lines): keep the line flagged in ``multi_flags``; exactly one line: keep
    it if flagged in ``single_flags``.  Rewritten as a pre-aggregated count
    (``groupBy`` with partial aggregation) joined to the lines, then an
    equi join with a CASE filter.
    """
    counts = lines.groupBy(*[F.col(c).alias(f"_ck{i}") for i, c in enumerate(line_count_keys)]) \
        .agg(F.count(F.lit(1)).alias("_n_lines"))
    lc = lines.join(counts, _on(lines, counts, line_count_keys,
                                [f"_ck{i}" for i in range(len(line_count_keys))]), "inner") \
        .drop(*[f"_ck{i}" for i in range(len(line_count_keys))])
    cond = _on(claims, lc, claim_keys, line_keys)
    picked = claims.join(lc, cond, "inner").filter(
        ((F.col("_n_lines") > 1) & F.col(flag).isin(list(multi_flags)))
        | ((F.col("_n_lines") == 1) & F.col(flag).isin(list(single_flags))))
    return picked.drop("_n_lines")


def resolve_parent(df: DataFrame, code: str, hierarchy: DataFrame, h_code: str,
                   h_parent: str, h_name: str, out: str) -> DataFrame:
    """Parent-name resolution: ``coalesce(max(parent.name), max(own.name))``
    over hierarchy rows of the code whose parent exists; default the code.

    The hierarchy is pre-aggregated to one row per code, then left-joined; one that fits a
    broadcast leaves the rows of ``df`` where they are.
    """
    own = hierarchy.select(F.col(h_code).alias("_c"), F.col(h_parent).alias("_p"),
                           F.col(h_name).alias("_own"))
    parents = hierarchy.select(F.col(h_code).alias("_pc"), F.col(h_name).alias("_pn")).distinct()
    resolved = own.join(parents, own["_p"] == parents["_pc"], "inner") \
        .groupBy("_c").agg(F.coalesce(F.max("_pn"), F.max("_own")).alias("_resolved"))
    # one row per code: at most the hierarchy's rows
    resolved = F.broadcast(resolved) if fits_broadcast(hierarchy) else resolved
    return df.join(resolved, df[code] == resolved["_c"], "left") \
        .withColumn(out, F.coalesce(F.col("_resolved"), F.col(code).cast("string"))) \
        .drop("_c", "_resolved")


def scalar_lookup(df: DataFrame, lookup: DataFrame, keys: dict[str, str], value, out, default=None,
                  distinct: bool = False) -> DataFrame:
    """Scalar subqueries without aggregate: labels by key, optional default.

    ``value`` and ``out`` are a column name or equally long lists of them (one
    join fetches all).  A key with more than one (distinct) match is an error once a
    row of ``df`` refers to it, as in SQL; the check is part of the plan
    (``raise_error`` after the join), not an action of its own.
    """
    values, outs = ([value], [out]) if isinstance(value, str) else (list(value), list(out))
    lk = lookup.select(*[F.col(v).alias(f"_lk{i}") for i, v in enumerate(keys.values())],
                       F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]).alias("_lv"))
    if distinct:
        lk = lk.distinct()
    agg = lk.groupBy(*[f"_lk{i}" for i in range(len(keys))]).agg(
        F.count(F.lit(1)).alias("_ln"), F.first("_lv").alias("_lv"))
    cond = _on(df, agg, list(keys.keys()), [f"_lk{i}" for i in range(len(keys))])
    res = df.join(agg, cond, "left")
    error = F.raise_error(F.lit("scalar lookup returned more than one row"))
    for i, o in enumerate(outs):
        val = F.when(F.col("_ln") > 1, error).otherwise(F.col("_lv").getField(f"v{i}"))
        res = res.withColumn(o, val if default is None else F.coalesce(val, F.lit(default)))
    return res.drop("_lv", "_ln", *[f"_lk{i}" for i in range(len(keys))])


def scalar_max(df: DataFrame, lookup: DataFrame, keys: dict[str, str], value: str,
               out: str) -> DataFrame:
    """Correlated ``max`` keyed by columns of (possibly several) outer tables."""
    agg = lookup.groupBy(*[F.col(v).alias(f"_mk{i}") for i, v in enumerate(keys.values())]) \
        .agg(F.max(value).alias(out))
    cond = _on(df, agg, list(keys.keys()), [f"_mk{i}" for i in range(len(keys))])
    return df.join(agg, cond, "left").drop(*[f"_mk{i}" for i in range(len(keys))])


def left_merge_dedup(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """pandas-style left merge on differently named keys, full-row dedup,
    drop the right key.  Null keys do not match (SQL equality)."""
    return a.join(b, a[a_key] == b[b_key], "left").drop(b[b_key]).dropDuplicates()


def map_lookup(df: DataFrame, key: str, lookup: DataFrame, l_key: str, l_value, out,
               order: str | None = None, default=None,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Dictionary lookup: **last duplicate wins** (largest ``order``), the
    default applies only when the key has no entry (a null value stays null).

    ``l_value`` and ``out`` are a column name or equally long lists of them: one
    join fetches all.  The lookup is reduced to one row per key with ``max_by``
    (partial aggregation), then broadcast if within the bound.
    """
    values, outs = ([l_value], [out]) if isinstance(l_value, str) else (list(l_value), list(out))
    row = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    order_col = F.struct(order) if order else row
    dedup = lookup.filter(F.col(l_key).isNotNull()).groupBy(F.col(l_key).alias("_mk")).agg(
        F.max_by(row, order_col).alias("_mv"))
    dedup = bounded_broadcast(dedup, max_broadcast_bytes)
    res = df.join(dedup, df[key] == dedup["_mk"], "left")
    for i, o in enumerate(outs):
        val = F.col("_mv").getField(f"v{i}")
        res = res.withColumn(o, val if default is None else F.when(F.col("_mk").isNull(), F.lit(default)).otherwise(val))
    return res.drop("_mk", "_mv")


def full_outer_counts(p: DataFrame, f: DataFrame, key: str, p_val: str, f_val: str) -> DataFrame:
    """Full outer join of two count tables with a coalesced key, nulls -> 0."""
    j = p.alias("p").join(f.alias("f"), F.col(f"p.{key}") == F.col(f"f.{key}"), "full_outer")
    return j.select(F.coalesce(F.col(f"p.{key}"), F.col(f"f.{key}")).alias(key),
                    F.coalesce(F.col(f"p.{p_val}"), F.lit(0)).cast("bigint").alias(p_val),
                    F.coalesce(F.col(f"f.{f_val}"), F.lit(0)).cast("bigint").alias(f_val))


def join_meta(df: DataFrame, meta: DataFrame, key: str, meta_key: str | None = None,
              max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Inner join with a small metadata table on a text key (bounded broadcast)."""
    meta_key = meta_key or key
    m = bounded_broadcast(meta, max_broadcast_bytes)
    if meta_key == key:
        return df.join(m, key, "inner")
    return df.join(m, df[key] == m[meta_key], "inner")
