"""Feature preparation, per-key training, scoring, evaluation and monitoring.

Per-key models are fitted from **sufficient statistics**: the normal
equations ``X'X b = X'y`` of each (pk, mapping) group are sums of products of
features not 0, added up with map-side partial aggregation, so a key holding
a third of all rows is reduced before the shuffle.  Only the small
systems — one row per key — reach Python, where numpy
solves them with a pseudo-inverse (the minimum-norm least-squares answer,
as ``lstsq`` on the raw rows gives).  Scoring is a join of rows with the
coefficient table and a dot product in SQL expressions.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import strings as S
from tessera.functions import values as V
from tessera.operators.joins import fits_broadcast, spread_join

# Model-quality thresholds as the source ships them
# (usecase, metric_name, unit, base_threshold, critical_threshold, expected_value).
THRESHOLDS = [
    ("DCP", "Intersection", "Percentage", 30.0, 20.0, ">=30"),
    ("DCP", "R2", "Number", 0.75, 0.7, ">-0.75"),
]


def minmax(df: DataFrame, col: str, part=(), out: str | None = None) -> DataFrame:
    """Min-max scaling of one column, globally or per ``part``; a constant
    column (or group) scales to 0.

    The bounds are a (partial) aggregate; globally it is a scalar subquery
    (computed once) — no one-partition window, no join.
    """
    out = out or col
    part = list(part)
    if part:
        b = df.groupBy(*part).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
        j = df.join(b, part, "left")
    else:
        b = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
        j = df.withColumns({"_lo": b.getField("lo"), "_hi": b.getField("hi")})
    return j.withColumn(out, V.minmax_expr(col, "_lo", "_hi")).drop("_lo", "_hi")


# ------------------------------------------------------------------ E04 / E05

def category_table(df: DataFrame, cols) -> DataFrame:
    """(column, value) of every category seen (the training vocabulary)."""
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
             .filter(F.col("value").isNotNull()).distinct() for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def one_hot(df: DataFrame, cols, categories: DataFrame | None = None, keep=False, max_columns: int = 2000) -> DataFrame:
    """One-hot encode ``cols`` (originals dropped unless ``keep``), one
    integer column ``<col>_<value>`` per category.

    The category list is fixed by ``categories`` (from training) so scoring
    builds the same columns; unseen values get all zeros.  Columns have names,
    so the list comes to the driver; more than ``max_columns`` of them are an
    error: for many categories use :func:`sparse_one_hot`, which has no list.
    """
    cats = categories if categories is not None else category_table(df, cols)
    by_col: dict[str, list[str]] = {}
    listed = cats.limit(max_columns + 1).collect()
    if len(listed) > max_columns:
        raise ValueError(f"more than {max_columns} categories: use sparse_one_hot")
    for r in listed:
        by_col.setdefault(r["column"], []).append(r["value"])
    new = {}
    for c in cols:
        for v in sorted(by_col.get(c, [])):
            new[feature_name(c, v)] = (F.col(c).cast("string") == F.lit(v)).cast("int")
    out = df.withColumns(new) if new else df
    return out if keep else out.drop(*cols)


def feature_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def with_keys(df: DataFrame, pk: str, mapping: str) -> DataFrame:
    """Mapping column (constant ``default`` or a copy of a column) and the
    model key = letters and digits of the primary key."""
    m = F.lit("default") if mapping == "default" else F.col(mapping).cast("string")
    return df.withColumn("mapping", m).withColumn("pk", S.alnum_key(F.col(pk).cast("string")))


# ------------------------------------------------------------------ E06 / E07

def manifest(df: DataFrame, keys, run_id: str, algorithms, data_root: str) -> DataFrame:
    """One work row per (pk, mapping): rows, data path, algorithms, status."""
    algos = F.array(*[F.lit(a) for a in algorithms])
    path = F.concat(F.lit(data_root.rstrip("/") + "/"),
                    F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k)) for k in keys]))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).select(
        *keys, "n_rows", F.lit(run_id).alias("run_id"), path.alias("data_path"),
        algos.alias("algorithms"), F.lit("Submitted").alias("status"))


def split(df: DataFrame, id_cols, test_pct: int = 10, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Deterministic train/test split: the first 32 bits of
    ``md5(seed|ids...)`` modulo 100 below ``test_pct``."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols])), 1, 8), 16, 10)
    return df.withColumn(out, h.cast("bigint") % 100 < test_pct)


# ------------------------------------------------------------------ E08

def sparse_one_hot(df: DataFrame, cols, numeric=(), out: str = "x") -> DataFrame:
    """One array column of (i, x) entries: 1.0 per categorical value and the
    numeric columns that are not 0.  A feature's number is the hash of its
    :func:`feature_name`, so any number of categories needs no list of them,
    and scoring rows get the numbers of training rows."""
    entries = [F.when(F.col(c).isNotNull(), F.struct(
        F.xxhash64(F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))).alias("i"), F.lit(1.0).alias("x"))) for c in cols]
    entries += [F.when(F.col(c) != 0, F.struct(F.xxhash64(F.lit(c)).alias("i"), F.col(c).cast("double").alias("x")))
                for c in numeric]
    return df.withColumn(out, F.array_compact(F.array(*entries)))


_ONE, _LABEL = -1, -2  # numbers of the constant and of the label in the products


def normal_equations(df: DataFrame, keys, vector: str, label: str) -> DataFrame:
    """(keys, i, j, s): sums of products of the features not 0, of the
    constant and of the label; a row of n entries gives (n + 2)(n + 3) / 2 products,
    added up map-side."""
    extra = F.array(F.struct(F.lit(_ONE).cast("bigint").alias("i"), F.lit(1.0).alias("x")),
                    F.struct(F.lit(_LABEL).cast("bigint").alias("i"), F.col(label).cast("double").alias("x")))
    v = df.filter(F.col(label).isNotNull()).select(
        *keys, F.concat(F.col(vector).cast("array<struct<i:bigint,x:double>>"), extra).alias("_v"))
    pairs = F.flatten(F.transform("_v", lambda a: F.transform(
        F.filter("_v", lambda b: b["i"] >= a["i"]),
        lambda b: F.struct(a["i"].alias("i"), b["i"].alias("j"), (a["x"] * b["x"]).alias("s")))))
    return (v.select(*keys, F.explode(pairs).alias("_p")).groupBy(*keys, F.col("_p.i").alias("i"), F.col("_p.j").alias("j"))
            .agg(F.sum("_p.s").alias("s")))


def solve_key(i, j, s) -> tuple[float, dict[int, float], float, int]:
    """Minimum-norm least squares of one key from its products."""
    names = np.unique(np.concatenate((i, j)))
    a = np.zeros((len(names), len(names)))
    r, c = np.searchsorted(names, i), np.searchsorted(names, j)
    a[r, c] = s
    a[c, r] = s
    y, one = int(np.searchsorted(names, _LABEL)), int(np.searchsorted(names, _ONE))
    x = np.array([k for k in range(len(names)) if k != y])
    xx, xy, yy, n, ysum = a[np.ix_(x, x)], a[x, y], a[y, y], a[one, one], a[one, y]
    coef = np.linalg.pinv(xx) @ xy
    sse, sst = yy - 2 * coef @ xy + coef @ xx @ coef, yy - ysum * ysum / n
    at = int(np.flatnonzero(x == one)[0])
    weights = {int(names[k]): float(w) for k, w in zip(x, coef) if k != one}
    return float(coef[at]), weights, float(1 - sse / sst) if sst > 0 else float("nan"), int(round(n))


def fit_sparse(df: DataFrame, keys, vector: str, label: str, algo: str = "lr", tol: float = 1e-15, rounds: int = 500) -> DataFrame:
    """Per-key ordinary least squares on sparse vectors, in rows: (keys, algoname,
    i, weight, r2, n_train), a row per feature number; number -1 is the constant.

    The normal equations are solved by conjugate gradients for all keys at once:
    a round multiplies the products by each key's direction (a join on
    key and feature number, summed map-side) and updates a row per key and feature, so
    no key's features meet in a task or a row.  From zero the rounds end in the
    minimum-norm answer, also where categories and constant depend on each other.
    They end when each key's residual is ``tol`` of its start, or after ``rounds``
    (then with an error, not a half-solved table).
    """
    from tessera.session import checkpoint_dir, cut_lineage, delete_folder, written
    keys = list(keys)
    spark = df.sparkSession
    ne = cut_lineage(normal_equations(df, keys, vector, label))

    def named(mark: str):
        """The keys under names of their own, and the condition that they are the same."""
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{mark}{n}")) for n, k in enumerate(keys)])
        return [F.col(k).alias(f"{mark}{n}") for n, k in enumerate(keys)], same

    sum_keys, same_key = named("_k")
    at_keys, same_at = named("_a")
    both = F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))))
    square = ne.where((F.col("i") != _LABEL) & (F.col("j") != _LABEL)).select(*keys, both.alias("_e"), "s") \
        .select(*keys, "_e.i", "_e.j", "s").repartition(*keys, "j").persist()  # read every round, shuffled once
    other = F.when(F.col("i") == _LABEL, F.col("j")).otherwise(F.col("i"))
    b = ne.where(((F.col("i") == _LABEL) | (F.col("j") == _LABEL)) & (F.col("i") != F.col("j"))) \
        .select(*keys, other.alias("i"), F.col("s").alias("b"))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/least-squares-{uuid.uuid4().hex}"
    state = written(b.select(*keys, "i", "b", F.lit(0.0).alias("x"), F.col("b").alias("r"), F.col("b").alias("p")), f"{folder}/0")
    try:
        for n in range(1, rounds + 1):
            left = state.groupBy(*keys).agg(F.sum(F.col("r") * F.col("r")).alias("rr"), F.sum(F.col("b") * F.col("b")).alias("bb"))
            if left.where(F.col("rr") > tol * tol * F.col("bb")).isEmpty():
                break
            p = state.select(*at_keys, F.col("i").alias("_j"), "p")
            q = square.join(p, same_at & (F.col("j") == F.col("_j"))).groupBy(*keys, "i").agg(F.sum(F.col("s") * F.col("p")).alias("q"))
            q = q.select(*at_keys, F.col("i").alias("_i"), "q")
            at = state.join(q, same_at & (F.col("i") == F.col("_i"))).select(*state.columns, "q")
            product = lambda x, y: F.sum(F.col(x) * F.col(y))
            sums = at.groupBy(*sum_keys).agg(product("r", "r").alias("rr"), product("p", "q").alias("pq"), product("r", "q").alias("rq"),
                                             product("q", "q").alias("qq"), product("b", "b").alias("bb"))
            go = (F.col("pq") > 0) & (F.col("rr") > tol * tol * F.col("bb"))
            step = F.when(go, F.col("rr") / F.col("pq")).otherwise(0.0)
            ahead = F.col("rr") - 2 * F.col("a") * F.col("rq") + F.col("a") * F.col("a") * F.col("qq")
            sums = sums.withColumn("a", step).withColumn("turn", F.when(go, F.greatest(F.lit(0.0), ahead) / F.col("rr")).otherwise(0.0))
            moved = at.join(sums, same_key).select(
                *keys, "i", "b", (F.col("x") + F.col("a") * F.col("p")).alias("x"), (F.col("r") - F.col("a") * F.col("q")).alias("r"), "p", "turn")
            moved = moved.withColumn("p", F.col("r") + F.col("turn") * F.col("p")).drop("turn")
            state = written(moved, f"{folder}/{n}")
            if n > 1:
                delete_folder(spark, f"{folder}/{n - 2}")
        else:
            raise RuntimeError(f"least squares not solved to {tol} in {rounds} rounds")
        state = cut_lineage(state)
    finally:
        square.unpersist()
        delete_folder(spark, folder)
    diag = lambda k: F.max(F.when((F.col("i") == k) & (F.col("j") == k), F.col("s")))
    about = ne.groupBy(*sum_keys).agg(
        diag(_ONE).alias("n"), diag(_LABEL).alias("yy"),
        F.max(F.when((F.least("i", "j") == _LABEL) & (F.greatest("i", "j") == _ONE), F.col("s"))).alias("ysum"))
    fit = state.groupBy(*at_keys).agg(F.sum(F.col("x") * F.col("b")).alias("xb"), F.sum(F.col("x") * F.col("r")).alias("xr"))
    sst = F.col("yy") - F.col("ysum") * F.col("ysum") / F.col("n")
    r2 = F.when(sst > 0, 1 - (F.col("yy") - F.col("xb") - F.col("xr")) / sst).otherwise(F.lit(float("nan")))
    return state.join(fit, same_at).join(about, same_key).select(
        *keys, F.lit(algo).alias("algoname"), "i", F.col("x").alias("weight"), r2.alias("r2"), F.round("n").cast("long").alias("n_train"))


DENSE_FEATURES = 8  # so many listed features have their products added up as columns


def fit_linear(df: DataFrame, keys, features, label: str, algo: str = "lr") -> DataFrame:
    """Per-key ordinary least squares on columns: (keys, algoname, intercept, coef[]
    in the order of ``features``, r2, n_train).  A key's products are one row of as many
    numbers as ``features`` squared; for categories use :func:`fit_sparse`."""
    # few features: a sum per product, no rows are made; more: only the products of those not 0
    x = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    if len(features) <= DENSE_FEATURES:
        named = [(k, F.col(f"_x{k}"), F.col(f"_x{k}") != 0) for k in range(len(features))] + [
            (_ONE, F.lit(1.0), F.lit(True)), (_LABEL, F.col("_y"), F.lit(True))]
        pairs = [(a, b) for n, a in enumerate(named) for b in named[n:]]
        sums = [F.sum(F.when(p & q, c * d).otherwise(0.0)).alias(f"_s{n}") for n, ((_, c, p), (_, d, q)) in enumerate(pairs)]
        product = lambda n: F.struct(F.lit(pairs[n][0][0]).cast("bigint").alias("i"), F.lit(pairs[n][1][0]).cast("bigint").alias("j"),
                                     F.col(f"_s{n}").alias("s"))
        rows = df.filter(F.col(label).isNotNull()).select(
            *keys, *[c.alias(f"_x{k}") for k, c in enumerate(x)], F.col(label).cast("double").alias("_y"))
        per = rows.groupBy(*keys).agg(*sums).select(*keys, F.array(*[product(n) for n in range(len(pairs))]).alias("_p"))
    else:
        v = F.filter(F.array(*[F.struct(F.lit(k).cast("bigint").alias("i"), c.alias("x")) for k, c in enumerate(x)]), lambda e: e["x"] != 0)
        ne = normal_equations(df.withColumn("_vector", v), keys, "_vector", label)
        per = ne.groupBy(*keys).agg(F.collect_list(F.struct("i", "j", "s")).alias("_p"))
    schema = T.StructType([f for f in per.schema.fields if f.name in keys] + [
        T.StructField("intercept", T.DoubleType()), T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("r2", T.DoubleType()), T.StructField("n_train", T.LongType())])
    n_features = len(features)

    def solve(batches):
        for pdf in batches:
            rows = []
            for head, p in zip(pdf[list(keys)].itertuples(index=False, name=None), pdf["_p"]):
                i, j, s = (np.array([e[f] for e in p]) for f in ("i", "j", "s"))
                intercept, weights, r2, n = solve_key(i, j, s)
                rows.append((*head, intercept, [weights.get(k, 0.0) for k in range(n_features)], r2, n))
            yield pd.DataFrame(rows, columns=[*keys, "intercept", "coef", "r2", "n_train"])

    return per.mapInPandas(solve, schema).withColumn("algoname", F.lit(algo))


def predict_sparse(df: DataFrame, models: DataFrame, keys, vector: str, out: str = "pred") -> DataFrame:
    """Score rows of sparse vectors with the weight rows of :func:`fit_sparse`:
    each row's entries join their weights and are added up (features without a
    weight count 0), so no key's weights travel with a row."""
    from tessera.session import cut_lineage
    keys = list(keys)
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    one = F.array(F.struct(F.lit(_ONE).cast("bigint").alias("i"), F.lit(1.0).alias("x")))
    entries = rows.select("_row", *keys, F.explode(F.concat(F.col(vector).cast("array<struct<i:bigint,x:double>>"), one)).alias("_e"))
    entries = entries.select("_row", *keys, "_e.i", "_e.x")
    # the constant, and a frequent category, is an entry of very many rows
    score = spread_join(entries, models.select(*keys, "algoname", "i", "weight"), [*keys, "i"], ["_row"]) \
        .groupBy("_row", "algoname").agg(F.sum(F.col("x") * F.col("weight")).alias(out))
    return rows.join(score, "_row").drop("_row")


def store_models(models: DataFrame, path: str, folders=("mapping", "algoname")) -> None:
    """Coefficient table, a row per key, under ``mapping=/algoname=`` folders (not a
    folder and file per key); a rerun replaces the folders it fitted."""
    from tessera.sinks.writers import write_keyed
    write_keyed(models, path, keys=folders)


def load_models(spark, path: str, folders=("mapping", "algoname"), from_path: bool = False) -> DataFrame:
    """The stored table; with ``from_path`` the folders' values are cut from each
    row's file path (for readers that got paths and no table layout)."""
    if from_path:
        m = spark.read.option("recursiveFileLookup", True).parquet(path)
        return m.withColumns({k: F.url_decode(S.path_part(F.col("_metadata.file_path"), k)) for k in folders})
    m = spark.read.option("basePath", path).parquet(path)
    return m.withColumns({k: F.col(k).cast("string") for k in folders})


MODELS_BROADCAST_BYTES = 8 << 20


def with_models(df: DataFrame, models: DataFrame, keys) -> DataFrame:
    """Rows with the models of their key.  Few models are broadcast, so that rows stay where they are;
    else the rows of a key that holds many of them are dealt to chunks (:func:`spread_join`)."""
    if fits_broadcast(models, MODELS_BROADCAST_BYTES):
        return df.join(F.broadcast(models), list(keys))
    by = [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return spread_join(df, models, keys, by or list(keys))


def fit_mean(df: DataFrame, keys, label: str, algo: str = "mean") -> DataFrame:
    """Baseline per-key model: the mean label (intercept only)."""
    return df.groupBy(*keys).agg(F.avg(label).alias("intercept"), F.count(F.lit(1)).alias("n_train")) \
        .withColumn("coef", F.array().cast("array<double>")).withColumn("r2", F.lit(None).cast("double")) \
        .withColumn("algoname", F.lit(algo))


def predict(df: DataFrame, models: DataFrame, keys, features, out: str = "pred") -> DataFrame:
    """Score rows with the per-key coefficient table: intercept + coef . x
    (a keyed join; the dot product is a SQL expression)."""
    xs = F.array(*[F.col(f).cast("double") for f in features]) if features else F.array().cast("array<double>")
    j = with_models(df, models.select(*keys, "algoname", "intercept", "coef"), keys)
    dot = F.aggregate(F.zip_with(F.col("coef"), xs, lambda c, x: F.coalesce(c * x, F.lit(0.0))),
                      F.lit(0.0), lambda s, v: s + v)
    return j.withColumn(out, F.col("intercept") + dot).drop("intercept", "coef")


def fit_trees(df: DataFrame, keys, features, label: str, algo: str = "gbt", rounds: int = 10,
              rate: float = 0.3, bins: int = 16, depth: int = 1) -> DataFrame:
    """Boosted regression trees, a model per key: (keys, algoname, base, n_train)
    and, for ``depth`` 1, steps: array of struct(feature, cut, left, right), else
    trees: array of map(node, struct(feature, cut, value)), children of node k being 2k
    (value <= cut) and 2k + 1, a leaf's feature null.

    Features are cut at their approximate quantiles (``bins`` of them); rows of a
    key in the same cell of cuts are one row of counts and sums from then
    on.  All keys' trees grow together, a level a pass: cells are added up to a
    histogram per (key, node, feature) with map-side combining, and the best cut of
    each node moves its cells to the children.  Below the root only the smaller
    child is added up; its sibling is the parent less it.  No key's rows meet in
    one task, and the number of keys has no bound.  At depth 1 every round makes its cut; deeper
    trees cut a node only where that lessens the error.
    """
    from tessera.session import checkpoint_dir, cut_lineage, written
    keys = list(keys)
    qs = [k / bins for k in range(1, bins)]
    cuts = df.agg(*[F.percentile_approx(F.col(f).cast("double"), qs).alias(f"q{i}") for i, f in enumerate(features)]).first()
    cuts = [[float(c) for c in sorted(set(cuts[i] or []))] for i in range(len(features))]  # at most bins - 1 numbers per feature
    cell = [sum((F.coalesce(F.col(f).cast("double") > c, F.lit(True)).cast("int") for c in cuts[i]), F.lit(0)).alias(f"b{i}")
            for i, f in enumerate(features)]
    cols = [f"b{i}" for i in range(len(features))]
    cells = df.filter(F.col(label).isNotNull()).select(*keys, *cell, F.col(label).cast("double").alias("_y")) \
        .groupBy(*keys, *cols).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("r"))
    cells = cut_lineage(cells)  # the rows are read once from here on
    base = cells.groupBy(*keys).agg((F.sum("r") / F.sum("n")).alias("base"), F.sum("n").alias("n_train"))
    model = base.withColumn("steps" if depth == 1 else "trees", F.array().cast(_STEPS if depth == 1 else _TREES))
    cells = cells.join(base, keys).withColumn("r", F.col("r") - F.col("n") * F.col("base")).drop("base", "n_train")
    for _ in range(rounds if any(cuts) else 0):
        grown = cells.withColumns({"node": F.lit(1), "value": F.lit(0.0), "small": F.lit(True)})
        parents, splits = None, []
        for level in range(depth):
            found = _histograms(grown, keys, cols, cuts, parents)
            if level + 1 < depth:
                found = parents = cut_lineage(found)
            best = _best_cuts(found, keys, cuts, rate, always=depth == 1)
            left, split = _bin_of(cols) <= F.col("c.at"), F.col("c").isNotNull()
            grown = cut_lineage(grown.drop("small", "was", "c").join(best, [*keys, "node"], "left").select(
                *keys, *cols, "n", "r", F.col("node").alias("was"), "c",
                F.when(~split, F.col("node")).when(left, 2 * F.col("node")).otherwise(2 * F.col("node") + 1).alias("node"),
                F.when(~split, F.col("value")).when(left, F.col("c.left")).otherwise(F.col("c.right")).alias("value"),
                (split & (left == (F.col("c.nl") <= F.col("c.na") - F.col("c.nl")))).alias("small")))
            splits.append(grown.groupBy(*keys, "was").agg(F.first("c").alias("c")))
        if depth == 1:
            step = splits[0].select(*keys, F.array(F.struct("c.feature", "c.cut", "c.left", "c.right")).alias("_s"))
            model = model.join(step, keys).withColumn("steps", F.concat("steps", "_s")).drop("_s")
        else:
            model = model.join(_trees_of(splits, keys), keys).withColumn("trees", F.concat("trees", F.array("_t"))).drop("_t")
            model = cut_lineage(model)
        cells = grown.select(*keys, *cols, "n", (F.col("r") - F.col("n") * F.col("value")).alias("r"))
    # from a file its size is known, so that scoring may broadcast it
    return written(model, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/trees-{uuid.uuid4().hex}").withColumn("algoname", F.lit(algo))


_STEPS = "array<struct<feature:int,cut:double,left:double,right:double>>"
_TREES = "array<map<int,struct<feature:int,cut:double,value:double>>>"


def _trees_of(splits: list[DataFrame], keys) -> DataFrame:
    """(keys, _t): map of node to (feature, cut, value) from the levels' cuts."""
    none = lambda t: F.lit(None).cast(t)
    nodes = reduce(DataFrame.unionByName, [s.select(*keys, F.explode(F.when(F.col("c").isNull(), F.array(
        F.struct(F.col("was").alias("node"), none("int").alias("feature"), none("double").alias("cut"),
                 F.when(F.col("was") == 1, 0.0).alias("value")))).otherwise(F.array(
        F.struct(F.col("was").alias("node"), F.col("c.feature").alias("feature"), F.col("c.cut").alias("cut"), none("double").alias("value")),
        *[F.struct((2 * F.col("was") + k).alias("node"), none("int").alias("feature"), none("double").alias("cut"),
                   F.col(f"c.{side}").alias("value")) for k, side in enumerate(("left", "right"))]))).alias("e")) for s in splits])
    one = nodes.groupBy(*keys, F.col("e.node").alias("node")).agg(
        F.max("e.feature").alias("feature"), F.max("e.cut").alias("cut"), F.max("e.value").alias("value"))
    one = one.select(*keys, "node", F.struct("feature", "cut", F.when(F.col("feature").isNull(), F.col("value")).alias("value")).alias("t"))
    return one.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("node", "t"))).alias("_t"))


def _bin_of(cols) -> Column:
    return F.coalesce(*[F.when(F.col("c.feature") == k, F.col(c)) for k, c in enumerate(cols)])


def _histograms(cells: DataFrame, keys, cols, cuts, parents: DataFrame | None) -> DataFrame:
    """(keys, node, feature, hn, hr): counts and residual sums by bin.  With
    ``parents`` (the level above) only cells marked small are added up."""
    width = max(map(len, cuts)) + 1
    e = cells.where("small").select(*keys, "node", "n", "r", F.posexplode(F.array(*cols)).alias("feature", "bin"))

    def sums(c, zero):
        return F.expr("array(" + ", ".join(f"sum(if(bin = {k}, {c}, {zero}))" for k in range(width)) + ")")

    own = e.groupBy(*keys, "node", "feature").agg(sums("n", "0L").alias("hn"), sums("r", "0D").alias("hr"))
    if parents is None:
        return own
    less = own.select(*keys, F.floor(F.col("node") / 2).cast("int").alias("node"), "feature", F.col("node").alias("_small"),
                      F.col("hn").alias("_n"), F.col("hr").alias("_r"))
    rest = parents.join(less, [*keys, "node", "feature"]).select(
        *keys, (4 * F.col("node") + 1 - F.col("_small")).cast("int").alias("node"), "feature",
        F.zip_with("hn", "_n", lambda a, b: a - b).alias("hn"), F.zip_with("hr", "_r", lambda a, b: a - b).alias("hr"))
    return own.unionByName(rest)


def _best_cuts(found: DataFrame, keys, cuts, rate: float, always: bool) -> DataFrame:
    """(keys, node, c): the best cut of each node, first feature and lowest
    cut among equals; without ``always`` only where both sides have rows and the error falls."""
    mean = lambda s, n: F.when(n > 0, s / n).otherwise(0.0)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v)
    x = found.withColumns({"na": total("hn").cast("long"), "ra": total("hr")})
    cut_of = F.get(F.lit(cuts).cast("array<array<double>>"), F.col("feature"))

    def candidate(cut, k):
        nl, rl = total(F.slice("hn", F.lit(1), k + 1)).cast("long"), total(F.slice("hr", F.lit(1), k + 1))
        nr, rr = F.col("na") - nl, F.col("ra") - rl
        gain = F.round(rl * mean(rl, nl) + rr * mean(rr, nr), 9)
        return F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-k).alias("k"), cut.alias("cut"), nl.alias("nl"), rl.alias("rl"))

    x = x.withColumn("_c", F.transform(cut_of, candidate))
    if not always:
        before = F.round(F.col("ra") * mean(F.col("ra"), F.col("na")), 9)
        x = x.withColumn("_c", F.filter("_c", lambda c: (c["nl"] > 0) & (c["nl"] < F.col("na")) & (c["gain"] > before)))
    x = x.where(F.size("_c") > 0).select(*keys, "node", "na", "ra", F.array_max("_c").alias("_c"))
    best = x.groupBy(*keys, "node").agg(F.max(F.struct("_c", "na", "ra")).alias("b"))
    nl, rl = F.col("b._c.nl"), F.col("b._c.rl")
    return best.select(*keys, "node", F.struct(
        (-F.col("b._c.f")).alias("feature"), (-F.col("b._c.k")).alias("at"), F.col("b._c.cut").alias("cut"),
        (rate * mean(rl, nl)).alias("left"), (rate * mean(F.col("b.ra") - rl, F.col("b.na") - nl)).alias("right"),
        nl.alias("nl"), F.col("b.na").alias("na")).alias("c"))


def predict_trees(df: DataFrame, models: DataFrame, keys, features, out: str = "pred") -> DataFrame:
    """Score rows with :func:`fit_trees` models; a missing value goes right."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    kind = "steps" if "steps" in models.columns else "trees"
    j = with_models(df.withColumn("_x", x), models.select(*keys, "algoname", "base", kind), keys)
    goes_left = lambda t: F.coalesce(F.get("_x", t["feature"]) <= t["cut"], F.lit(False))
    if kind == "steps":
        add = F.aggregate("steps", F.lit(0.0), lambda s, t: s + F.when(goes_left(t), t["left"]).otherwise(t["right"]))
    else:
        # a tree's nodes on the way down: as many steps as the tree has nodes end at a leaf
        def leaf(tree):
            def down(node, _):
                t = F.try_element_at(tree, node)
                return F.when(t["feature"].isNull(), node).when(goes_left(t), 2 * node).otherwise(2 * node + 1)
            levels = F.ceil(F.log2(F.array_max(F.map_keys(tree)) + 1)).cast("int")
            return F.aggregate(F.sequence(F.lit(1), levels), F.lit(1), down)
        add = F.aggregate("trees", F.lit(0.0), lambda s, tree: s + F.try_element_at(tree, leaf(tree))["value"])
    return j.withColumn(out, F.col("base") + add).drop("_x", "base", kind)


# ------------------------------------------------------------------ E01 / E02 / E03

def topk_overlap(pred: DataFrame, keys, part, pred_col: str, actual_col: str, n: int,
                 actual: DataFrame | None = None, actual_keys=None, actual_part=None) -> DataFrame:
    """Intersection metric: per ``part`` (e.g. algorithm) the number of keys
    in both the top-``n`` by prediction and the top-``n`` by actual value
    (``rank() <= n``, ties kept), and that count as a percent of ``n``.

    ``actual`` defaults to the prediction rows themselves (held-out rows
    carry both values); with a separate ground-truth table its top-``n`` is
    taken per ``actual_part`` and joined on the keys only."""
    def top(df, order, p, ks):
        # the n-th largest distinct value that rank() <= n reaches, from counts
        # per value (map-side combined): ties of any number stay where they are
        value = F.col(order).cast("double")
        per = df.filter(value.isNotNull()).groupBy(*p, value.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
        # each value counts one row at least, so the bound lies among the n greatest
        # values of a group: the running count sees no more of them
        if p:
            w = Window.partitionBy(*p).orderBy(F.col("_v").desc())
            near = per.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
        else:
            w = Window.orderBy(F.col("_v").desc())
            near = per.orderBy(F.col("_v").desc()).limit(n)
        bound = near.withColumn("_before", F.sum("_c").over(w) - F.col("_c")).filter(F.col("_before") < n)
        if not p:
            low = bound.agg(F.min("_v")).scalar()
            return df.filter(value >= low).select(*ks).distinct()
        bound = bound.groupBy(*[F.col(c).alias(f"_p_{c}") for c in p]).agg(F.min("_v").alias("_low"))
        on = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in p]
        return df.join(bound, reduce(lambda a, b: a & b, on)).filter(value >= F.col("_low")).select(*ks, *p).distinct()
    tp = top(pred, pred_col, list(part), list(keys))
    if actual is None:
        ta = top(pred, actual_col, list(part), list(keys))
        j = tp.join(ta, list(keys) + list(part))
    else:
        ak = list(actual_keys or keys)
        ta = top(actual, actual_col, list(actual_part or []), ak)
        j = tp.join(ta.select(*[F.col(a).alias(k) for a, k in zip(ak, keys)]), list(keys))
    return j.groupBy(*part).agg(F.count(F.lit(1)).cast("bigint").alias("metric_value")) \
        .withColumn("metric_name", F.lit("Intersection")) \
        .withColumn("metric_percent", F.round(F.col("metric_value") * 100.0 / n, 4))


def overlap_rollup(metrics: DataFrame) -> DataFrame:
    """Overlap per algorithm: its mappings' counts added, percents averaged."""
    return metrics.groupBy("algoname").agg(
        F.sum("metric_value").cast("bigint").alias("metric_value"), F.first("metric_name").alias("metric_name"),
        F.round(F.avg("metric_percent"), 4).alias("metric_percent"))


def winner(metrics: DataFrame, metric: str = "metric_value", name: str = "algoname") -> DataFrame:
    from tessera.operators.windows import winner as _w
    return _w(metrics, metric, name).select(F.col(metric).cast("string").alias("winningalgometric"),
                                            F.col(name).alias("winningalgo"))


def thresholds(spark) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "usecase string, metric_name string, unit string, "
                                             "base_threshold double, critical_threshold double, "
                                             "expected_value string")


def traffic_light(metrics: DataFrame, thresholds_df: DataFrame, value: str = "metric_value") -> DataFrame:
    """Green at or above base, Amber at or above critical, else Red.

    The threshold table (configuration) becomes a map of metric name to its
    rows in a scalar subquery, and each metric gets a row per threshold row of its
    name (several use cases may share a metric); metrics without a threshold are
    dropped, as an inner join would.  No join, so no plan shape depends on the
    literal metric name.
    """
    cols = [c for c in thresholds_df.columns if c != "metric_name"]
    per = thresholds_df.groupBy("metric_name").agg(F.collect_list(F.struct(*cols)).alias("rows"))
    m = per.agg(F.map_from_entries(F.collect_list(F.struct("metric_name", "rows")))).scalar()
    j = metrics.withColumn("_thr", F.explode(F.element_at(m, F.col("metric_name")))) \
        .withColumns({c: F.col("_thr").getField(c) for c in cols}).drop("_thr")
    v = F.col(value)
    return j.withColumn("status", F.when(v >= F.col("base_threshold"), "Green")
                        .when(v >= F.col("critical_threshold"), "Amber")
                        .when(v < F.col("critical_threshold"), "Red"))


# ------------------------------------------------------------------ E12 / E13 / E14

def status_log(models: DataFrame, keys, run_id: str) -> DataFrame:
    """One status row per (key, algorithm): Succeeded when a model exists."""
    ok = F.col("intercept").isNotNull() & ~F.isnan(F.col("intercept"))
    return models.select(*keys, "algoname", F.lit(run_id).alias("run_id"),
                         F.when(ok, "Succeeded").otherwise("Failed").alias("status"))


def check_mapping(mapping: DataFrame, required_training, required_inference) -> DataFrame:
    """Config integrity, one row: exactly one mapping row, required algorithms
    are listed, the training algorithms include every inference algorithm, and the
    training mapping column is the inference one or ``default``."""
    req_t = F.array(*[F.lit(a) for a in required_training])
    req_i = F.array(*[F.lit(a) for a in required_inference])
    return mapping.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.size(F.array_except(req_t, F.col("training_algorithms"))) == 0).alias("training_ok"),
        F.bool_and(F.size(F.array_except(req_i, F.col("inference_algorithms"))) == 0).alias("inference_ok"),
        F.bool_and(F.size(F.array_except("inference_algorithms", "training_algorithms")) == 0).alias("superset_ok"),
        F.bool_and((F.col("training_mapping_column") == F.col("inference_mapping_column"))
                   | (F.col("training_mapping_column") == "default")).alias("column_ok"),
    ).withColumn("valid", (F.col("n_rows") == 1) & F.col("training_ok") & F.col("inference_ok")
                 & F.col("superset_ok") & F.col("column_ok"))


def run_record(metrics: DataFrame, win: DataFrame, run_id: str, usecase: str, stages: dict,
               status: DataFrame | None = None) -> DataFrame:
    """One nested run-lineage record: algorithm scores as an array of
    structs, stage epochs as structs, job totals."""
    scores = metrics.agg(F.array_sort(F.collect_list(F.struct(
        F.col("algoname").alias("algo_name"), F.col("metric_value").cast("double").alias("algo_score"))))
        .alias("algo_scores"))
    rec = scores.withColumn("winningalgo", win.select("winningalgo").scalar())
    for stage, (start, end) in stages.items():
        rec = rec.withColumn(stage, F.struct(F.lit(int(start)).cast("bigint").alias("start_time"),
                                             F.lit(int(end)).cast("bigint").alias("end_time")))
    if status is not None:
        tot = status.agg(F.struct(F.count(F.lit(1)).alias("t"),
                                  F.count_if(F.col("status") == "Failed").alias("f"))).scalar()
        rec = rec.withColumns({"total_jobs": tot.getField("t"), "failed_jobs": tot.getField("f")})
    return rec.select(F.lit(run_id).alias("stepjobid"), F.lit(usecase).alias("usecase_name"),
                      F.lit("Completed").alias("status"), F.col("winningalgo").alias("winner_algo"),
                      "algo_scores", *stages.keys(),
                      *([c for c in ("total_jobs", "failed_jobs")] if status is not None else []))
