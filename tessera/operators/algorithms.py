"""Algorithms as plug-ins for per-key training and scoring.

An algorithm is a pair of functions over numpy arrays, registered under a name:
``fit(x, y) -> bytes`` and ``predict(model, x) -> y``.  Training hands each
key's rows to every algorithm asked for, as one Arrow batch; models are a table with a
binary column, a row per key and algorithm.  Scoring co-groups rows and models.

Every row of a key counts.  A key too large for a task is fitted by the algorithm's
form for large keys, if it has one (least squares from triangles, means from sums, medians from
counts: no task holds the key's rows); without one all of the key's rows reach ``fit``
in one task.  Scoring cuts a key's rows into chunks that each meet the key's models.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

__all__ = ["ALGORITHMS", "LARGE", "register", "fit_registered", "predict_registered"]

ALGORITHMS: dict[str, tuple[Callable, Callable]] = {}
LARGE: dict[str, Callable] = {}  # forms for large keys, of the algorithms that have one


def register(name: str, fit: Callable[[np.ndarray, np.ndarray], bytes], predict: Callable[[bytes, np.ndarray], np.ndarray],
             large: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> None:
    """Add or replace an algorithm.  The functions travel to the workers with
    the job, so they may be defined anywhere.

    ``large(rows, features)`` fits keys of any size, to the model that ``fit`` gives on all their rows:
    from rows (``_key`` a number, features, ``_y``) to a row (``_key``, model, reason) a key."""
    ALGORITHMS[name] = fit, predict
    LARGE.pop(name, None)
    if large:
        LARGE[name] = large


_FITTED = "_key long, model binary, reason string"


def _least_squares(a: np.ndarray, y: np.ndarray, n: float) -> bytes:
    """Minimum-norm least squares of ``n`` rows or of their triangle.  A column that the others give
    already is left with the rounding of so many rows: that is no direction of its own."""
    return pickle.dumps(np.linalg.pinv(a, rcond=8 * np.finfo(float).eps * max(n, 1) ** 0.5) @ y)


def _fit_lr(x: np.ndarray, y: np.ndarray) -> bytes:
    return _least_squares(np.column_stack((np.ones(len(x)), np.nan_to_num(x))), y, len(x))


def _predict_lr(model: bytes, x: np.ndarray) -> np.ndarray:
    w = pickle.loads(model)
    return w[0] + np.nan_to_num(x) @ w[1:]


def _large_lr(rows: DataFrame, features: list[str]) -> DataFrame:
    """Least squares of (1, x) to y are those of the triangle of (1, x, y), and a triangle of triangles is that
    of all their rows: each task gives one for each of its keys, and those of a key are put together."""
    width = len(features) + 2

    def triangles(batches):
        import pyarrow as pa
        schema = pa.schema([("_key", pa.int64()), ("r", pa.list_(pa.float64()))])
        key, r = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([key]), pa.array([r.ravel()], schema.field("r").type)], schema=schema)
        for batch in batches:
            ids = batch.column("_key").to_numpy()
            a = np.column_stack((np.ones(len(ids)), np.nan_to_num(_matrix(batch, features)), _matrix(batch, ["_y"])))
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1), len(ids)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo < hi and ids[lo] != key:
                    if key is not None:
                        yield done()
                    key, r = ids[lo], np.zeros((0, width))
                r = np.linalg.qr(np.vstack((r, a[lo:hi])), mode="r") if lo < hi else r
        if key is not None:
            yield done()

    def solve(key, table):
        import pyarrow as pa
        r = np.linalg.qr(table.column("r").combine_chunks().flatten().to_numpy().reshape(-1, width), mode="r")
        try:
            model, reason = _least_squares(r[:, :-1], r[:, -1], r[0, 0] ** 2), None  # the first column is of ones
        except Exception as e:
            model, reason = None, f"{type(e).__name__}: {e}"
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([model], pa.binary()), pa.array([reason], pa.string())],
                        names=["_key", "model", "reason"])

    # rows stay where they are: sorted in each task, not moved
    return rows.select("_key", *features, "_y").sortWithinPartitions("_key").mapInArrow(triangles, "_key long, r array<double>") \
        .groupBy("_key").applyInArrow(solve, _FITTED)


def _pickled(df: DataFrame, value: str) -> DataFrame:
    """(_key, model, reason) of models that are one number."""
    def dump(batches):
        import pyarrow as pa
        for b in batches:
            models = [pickle.dumps(v) for v in b.column("_v").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_key"), pa.array(models, pa.binary()), pa.nulls(len(models), pa.string())],
                                             names=["_key", "model", "reason"])
    return df.select("_key", F.col(value).cast("double").alias("_v")).mapInArrow(dump, _FITTED)


def _large_mean(rows: DataFrame, features: list[str]) -> DataFrame:
    return _pickled(rows.groupBy("_key").agg(F.avg("_y").alias("mean")), "mean")


def _large_median(rows: DataFrame, features: list[str]) -> DataFrame:
    """The exact median.  Two values close to the middle part a key's rows in three; how many rows
    each part has tells which holds the middle ones, and only its different values are ordered.  However the two
    are chosen the answer is the same: their distance sets how many values are ordered."""
    around = rows.groupBy("_key").agg(F.percentile_approx("_y", [0.499, 0.501], 10_000).alias("_b"), F.count(F.lit(1)).alias("_n"),
                                      F.max(F.isnan("_y")).alias("_nan"))
    y, b = F.col("_y"), F.col("_b")
    # large keys are few: at most the rows divided by those of a task
    parted = rows.join(F.broadcast(around), "_key").withColumn("_part", F.when(y < b[0], 0).when(y <= b[1], 1).otherwise(2))
    parts = parted.groupBy("_key").agg(F.count_if(F.col("_part") == 0).alias("_below"), F.count_if(F.col("_part") < 2).alias("_upto"))
    begin = F.when(F.col("_part") == 0, 0).when(F.col("_part") == 1, F.col("_below")).otherwise(F.col("_upto"))
    end = F.when(F.col("_part") == 0, F.col("_below")).when(F.col("_part") == 1, F.col("_upto")).otherwise(F.col("_n"))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    middle = parted.join(F.broadcast(parts), "_key").filter((begin <= high) & (end > low))
    values = middle.groupBy("_key", "_part", "_y", "_n", "_nan", begin.alias("_begin")).agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy("_key", "_part").orderBy("_y")
    placed = values.withColumn("_end", F.col("_begin") + F.sum("_c").over(order))
    at = lambda rank: F.max(F.when((F.col("_end") > rank) & (F.col("_end") - F.col("_c") <= rank), y))
    found = placed.groupBy("_key").agg(((at(low) + at(high)) / 2).alias("_m"), F.max("_nan").alias("_nan"))
    return _pickled(found.withColumn("_m", F.when(F.col("_nan"), float("nan")).otherwise(F.col("_m"))), "_m")


def _constant(of: Callable) -> tuple[Callable, Callable]:
    return (lambda x, y: pickle.dumps(float(of(y)))), (lambda model, x: np.full(len(x), pickle.loads(model)))


register("lr", _fit_lr, _predict_lr, _large_lr)
register("mean", *_constant(np.mean), _large_mean)
register("median", *_constant(np.median), _large_median)


def _matrix(table, columns) -> np.ndarray:
    return np.column_stack([table.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns]) \
        if columns else np.zeros((table.num_rows, 0))


def _chosen(algorithms) -> dict[str, tuple[Callable, Callable]]:
    if missing := [a for a in algorithms if a not in ALGORITHMS]:
        raise ValueError(f"not registered: {missing}")
    return {a: ALGORITHMS[a] for a in algorithms}


TASK_ROWS = 100_000  # a key of more rows is large


def fit_registered(df: DataFrame, keys, features, label: str, algorithms, max_rows: int | None = None) -> DataFrame:
    """(keys, algoname, model, n_rows, n_train, status, reason), a row per key and
    algorithm.  An algorithm that raises is a row with status Failed, the
    reason and no model; the others of its key go on.  Rows with a null label
    are left out; null features reach the algorithm as NaN.

    All rows of a key are trained on, those of a key of more than ``TASK_ROWS`` by the algorithm's form for
    large keys.  Only a caller that names ``max_rows`` gets models of so many rows of a
    key (those with the smallest hash, so a rerun takes the same); ``n_train`` tells."""
    keys, features = list(keys), list(features)
    use = _chosen(algorithms)
    rows = df.where(F.col(label).isNotNull()).select(
        *keys, *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("_y"))
    names = [f"_x{i}" for i in range(len(features))]
    total = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    schema = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], T.StructField("algoname", T.StringType()),
                           T.StructField("model", T.BinaryType()), T.StructField("n_train", T.LongType()),
                           T.StructField("status", T.StringType()), T.StructField("reason", T.StringType())])

    def trained(part: DataFrame, chosen) -> DataFrame:
        """A key's rows as one batch to each of the ``chosen`` algorithms."""
        def train(key, table):
            import pyarrow as pa
            x, y = _matrix(table, names), _matrix(table, ["_y"])[:, 0]
            out = []
            for name, (fit, _) in chosen.items():
                try:
                    out.append((name, fit(x, y), len(y), "Succeeded", None))
                except Exception as e:  # the job goes on; the row tells
                    out.append((name, None, len(y), "Failed", f"{type(e).__name__}: {e}"))
            heads = [pa.array([k.as_py()] * len(out), k.type) for k in key]
            types = [pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
            return pa.Table.from_arrays([*heads, *[pa.array(c, t) for c, t in zip(zip(*out), types)]], names=schema.names)
        return part.groupBy(*keys).applyInArrow(train, schema)

    if max_rows is not None:
        # the rank is cut in each task before the shuffle
        order = Window.partitionBy(*keys).orderBy(F.xxhash64(*names, "_y"), *names, "_y")
        models = trained(rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= max_rows).drop("_r"), use)
    else:
        # at most the rows divided by those of a task, so the list is broadcast; numbered once: the copy keeps the numbers
        large = cut_lineage(total.where(F.col("n_rows") > TASK_ROWS).withColumn("_key", F.monotonically_increasing_id()))
        if large.isEmpty():
            models = trained(rows, use)
        else:
            listed = F.broadcast(large).alias("l")
            models = trained(rows.alias("r").join(listed, same("r", "l"), "left_anti"), use)
            held = rows.alias("r").join(listed, same("r", "l")).select("r.*", "_key")
            if whole := {a: f for a, f in use.items() if a not in LARGE}:
                models = models.unionByName(trained(held.drop("_key"), whole))
            for a in (a for a in use if a in LARGE):
                fitted = LARGE[a](held.select("_key", *names, "_y"), names)
                models = models.unionByName(fitted.join(F.broadcast(large), "_key").select(
                    *keys, F.lit(a).alias("algoname"), "model", F.col("n_rows").alias("n_train"),
                    F.when(F.col("model").isNotNull(), "Succeeded").otherwise("Failed").alias("status"), "reason"))
    return models.alias("m").join(total.alias("t"), same("m", "t")).select(
        *[f"m.{k}" for k in keys], "algoname", "model", "n_rows", "n_train", "status", "reason")


def predict_registered(df: DataFrame, models: DataFrame, keys, features, id_cols, out: str = "pred",
                       chunk_rows: int = 100_000) -> DataFrame:
    """(keys, id_cols, algoname, out): every row scored by every model of its
    key.  Keys without a model, and models that failed, give no rows.  A key's
    rows are dealt by the hash of ``id_cols`` to as many chunks as it has
    ``chunk_rows``; ids should tell rows apart."""
    keys, features, ids = list(keys), list(features), list(id_cols)
    use = dict(ALGORITHMS)
    names = [f"_x{i}" for i in range(len(features))]
    rows = df.select(*keys, *ids, *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    chunks = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("_chunks"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    without = [f"_k{i}" for i in range(len(keys))]
    dealt = rows.join(chunks, on).withColumn("_chunk", F.pmod(F.xxhash64(*ids), F.col("_chunks")).cast("int")).drop(*without, "_chunks")
    fitted = models.where(F.col("model").isNotNull()).select(*keys, "algoname", "model")
    spread = fitted.join(chunks, on).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop(*without, "_chunks")
    schema = T.StructType([*[T.StructField(c, rows.schema[c].dataType) for c in (*keys, *ids)],
                           T.StructField("algoname", T.StringType()), T.StructField(out, T.DoubleType())])

    def score(part, fits):
        import pyarrow as pa
        head = [part.column(c) for c in (*keys, *ids)]
        x, found = _matrix(part, names), []
        for name, model in zip(fits.column("algoname").to_pylist(), fits.column("model").to_pylist()):
            y = np.asarray(use[name][1](model, x), np.float64)
            found.append(pa.Table.from_arrays([*head, pa.array([name] * len(y), pa.string()), pa.array(y)], names=schema.names))
        return pa.concat_tables(found) if found and len(x) else pa.Table.from_arrays(
            [*[h.slice(0, 0) for h in head], pa.array([], pa.string()), pa.array([], pa.float64())], names=schema.names)

    return (dealt.groupBy(*keys, "_chunk").cogroup(spread.groupBy(*keys, "_chunk")).applyInArrow(score, schema))
