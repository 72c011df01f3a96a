"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine ``t`` or more lie within ``eps = sqrt(2 - 2 t)``.  Vectors
are turned onto leading principal axes (fitted on a bounded sample; the axes
decide only how much is skipped), sorted by their grid cells of width eps on the
first of them, and cut into sequence intervals of at most ``block`` vectors.  Only
intervals whose boxes on the axes are within eps meet; a pair of intervals
is halved again and again, skipping provably distant halves, and what is left
is compared by a matrix product in double precision.

A pair of intervals gives a row per vector (its links, and a member of its
connected part), never the pairs.  Equal labels only meet; a hot label is many
intervals like any other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, connected_components, stored

CELL_AXES = 4
BOX_AXES = 8
LEAF = 64
SAMPLE = 4096


def unit_rows(vectors: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of usable vectors and their unit vectors in double precision."""
    at, out = [], []
    for i, v in enumerate(vectors):
        if v is None or not len(v):
            continue
        x = np.array([np.nan if c is None else c for c in v], np.float64)
        top = np.abs(x).max()
        if not np.isfinite(x).all() or top == 0:
            continue
        x /= top  # no overflow or underflow of the squares
        at.append(i)
        out.append(x / np.sqrt(x @ x))
    return np.array(at, np.int64), out


def principal_axes(sample: list, dim: int, k: int) -> np.ndarray:
    """dim x k leading axes of the sample's unit vectors, widest spread first."""
    _, rows = unit_rows(sample)
    x = np.array(rows) if rows else np.zeros((0, dim))
    if len(x) < 2:
        return np.eye(dim)[:, :k]
    _, axes = np.linalg.eigh(np.cov(x.T).reshape(dim, dim))
    return np.ascontiguousarray(axes[:, ::-1][:, :k])


def join_blocks(a: np.ndarray, ids_a: np.ndarray, b: np.ndarray, ids_b: np.ndarray, axes: np.ndarray,
                threshold: float, same: bool):
    """Positions (i, j) of linked rows of two blocks, i < j within one block."""
    eps = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    pa, pb = a @ axes, b @ axes
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def visit(a0, a1, b0, b1):
        xa, xb = pa[a0:a1], pb[b0:b1]
        if ((xa.min(0) - xb.max(0) > eps) | (xb.min(0) - xa.max(0) > eps)).any():
            return
        if max(a1 - a0, b1 - b0) <= LEAF:
            i, j = np.nonzero(a[a0:a1] @ b[b0:b1].T >= threshold)
            i, j = i + a0, j + b0
            keep = ids_a[i] != ids_b[j]
            if same:
                keep &= i < j
            if keep.any():
                found.append((i[keep], j[keep]))
            return
        am, bm = (a0 + a1) // 2, (b0 + b1) // 2
        halves_a = [(a0, am), (am, a1)] if a1 - a0 > 1 else [(a0, a1)]
        halves_b = [(b0, bm), (bm, b1)] if b1 - b0 > 1 else [(b0, b1)]
        for p, q in halves_a:
            for r, s in halves_b:
                if not (same and r < p):  # the mirror image of another call
                    visit(p, q, r, s)

    visit(0, len(a), 0, len(b))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def parts(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A member of its connected part for each of n nodes."""
    part = np.arange(n)
    while True:
        low = np.minimum(part[i], part[j])
        new = part.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == part).all():
            return part
        part = new


def _links_of_pair(ids_a, a, ids_b, b, axes, threshold, same):
    i, j = join_blocks(a, ids_a, b, ids_b, axes, threshold, same)
    if not len(i):
        return []
    ids = ids_a if same else np.concatenate((ids_a, ids_b))
    j = j if same else j + len(ids_a)
    n = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
    part = parts(len(ids), i, j)
    has = np.flatnonzero(n)
    return list(zip(ids[has].tolist(), n[has].tolist(), ids[part[has]].tolist()))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = 0.98, block: int = 1024, sample: int = SAMPLE) -> DataFrame:
    """One row per vec_id: n_links (vectors of other ids in its label with
    cosine >= threshold), component_id (smallest id reachable), kept.

    Linked with nothing: null labels, null ids, null, empty or zero vectors, null or
    non-finite components.  Vectors of different lengths never link.  Rows that
    repeat a vec_id don't link with each other; their links add up.  The axes
    come from the ``sample`` rows with the smallest hash of their id.
    """
    spark = vectors.sparkSession
    v = columns(vectors, vec_id=vec_id, embedding=embedding, label=label).selectExpr(
        "cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding", "cast(label as string) label")
    usable = v.where("vec_id is not null and label is not null and size(embedding) > 0")
    fit = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    by_dim: dict[int, list] = {}
    for r in fit:
        by_dim.setdefault(len(r.embedding), []).append(r.embedding)
    fitted = {d: principal_axes(x, d, BOX_AXES) for d, x in by_dim.items()}
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    cells = [f"c{i}" for i in range(CELL_AXES)]

    def axes_of(dim: int) -> np.ndarray:
        return fitted[dim] if dim in fitted else np.eye(dim)[:, :BOX_AXES]

    def on_grid(batches):
        import pyarrow as pa
        for b in batches:
            at, unit = unit_rows(b.column(1).to_pylist())
            cell = np.zeros((len(at), CELL_AXES), np.int64)
            for k, x in enumerate(unit):
                c = np.floor(x @ axes_of(len(x))[:, :CELL_AXES] / eps)
                cell[k, :len(c)] = c
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), b.column(2).take(pa.array(at)),
                 pa.array([len(x) for x in unit], pa.int32()), *[pa.array(cell[:, i]) for i in range(CELL_AXES)],
                 pa.array([x.astype("<f8").tobytes() for x in unit], pa.binary())],
                names=["vec_id", "label", "dim", *cells, "unit"])

    grid = usable.mapInArrow(on_grid, "vec_id long, label string, dim int, "
                             + ", ".join(f"{c} long" for c in cells) + ", unit binary")
    order = ["label", "dim", *cells, "vec_id"]

    def to_blocks(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        held: list = []
        key = None

        def out():
            x = np.frombuffer(b"".join(h[1] for h in held), "<f8").reshape(len(held), -1)
            p = x @ axes_of(x.shape[1])
            return pa.RecordBatch.from_pylist([{
                "label": key[0], "dim": key[1], "block": number, "first": min(h[2] for h in held),
                "last": max(h[2] for h in held), "low": p.min(0).tolist(), "high": p.max(0).tolist(),
                "ids": np.array([h[0] for h in held], "<i8").tobytes(), "units": x.tobytes()}], schema=schema)

        schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("block", pa.int64()), ("first", pa.int64()),
                            ("last", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
                            ("ids", pa.binary()), ("units", pa.binary())])
        for b in batches:
            for vid, lab, dim, c0, unit in zip(*(b.column(c).to_pylist() for c in ("vec_id", "label", "dim", "c0", "unit"))):
                if held and (len(held) >= block or key != (lab, dim)):
                    yield out()
                    held, number = [], number + 1
                key = (lab, dim)
                held.append((vid, unit, c0))
        if held:
            yield out()

    blocks = stored(grid.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        to_blocks, "label string, dim int, block long, first long, last long, low array<double>, "
                   "high array<double>, ids binary, units binary"))

    # intervals meet where their first cells are at most one apart and no axis parts them
    box = blocks.select("label", "dim", "block", "low", "high", "first", "last")
    left = box.select("*", F.explode(F.sequence("first", "last")).alias("cell"))
    right = box.select("label", "dim", F.col("block").alias("block_b"), F.col("low").alias("low_b"),
                       F.col("high").alias("high_b"), F.explode(F.expr("sequence(first - 1, last + 1)")).alias("cell"))
    gap = F.exists(F.arrays_zip("low", "high", "low_b", "high_b"),
                   lambda z: (z["low"] - z["high_b"] > eps) | (z["low_b"] - z["high"] > eps))
    pairs = (left.join(right, ["label", "dim", "cell"]).where(F.col("block") <= F.col("block_b")).where(~gap)
             .select("block", "block_b").distinct())
    a = blocks.select("block", "dim", "ids", "units")
    b = blocks.select(F.col("block").alias("block_b"), F.col("ids").alias("ids_b"), F.col("units").alias("units_b"))
    work = pairs.join(a, "block").join(b, "block_b").select("block", "block_b", "dim", "ids", "units", "ids_b", "units_b")

    def compare(batches):
        import pyarrow as pa
        for batch in batches:
            for k in range(batch.num_rows):
                x, y, dim, ia, ua, ib, ub = (batch.column(c)[k].as_py() for c in range(7))
                rows = _links_of_pair(
                    np.frombuffer(ia, "<i8"), np.frombuffer(ua, "<f8").reshape(-1, dim),
                    np.frombuffer(ib, "<i8"), np.frombuffer(ub, "<f8").reshape(-1, dim), axes_of(dim), threshold, x == y)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     names=["vec_id", "n", "peer"])

    found = stored(work.mapInArrow(compare, "vec_id long, n long, peer long"))
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    cc = connected_components(found, "vec_id", "peer")
    ids = v.select("vec_id").distinct()
    out = (ids.join(counts, "vec_id", "left").join(cc, ids.vec_id == cc.node, "left")
           .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component", "vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
