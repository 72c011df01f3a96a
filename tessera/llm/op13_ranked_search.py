"""Ranked lexical search with document FP-trees.

Documents are cut down to the terms that the queries hold.  A task puts its
documents, lot by lot, into a tree: each vector's terms in descending document
frequency, equal beginnings sharing a path (a document is a leaf; equal vectors
are one).  A node keeps, for each term below it, the greatest tf, and the
smallest length norm m.  A score grows with tf and falls with m, so a node's
maxima and minimum bound every score below it.  All items go down the tree
together, each dropping out of branches that cannot reach its k-th best score so far.

One vector in SEEDS, by hash of its content, is searched first: its k-th score
of an item is a floor for all other tasks, so nearly all their rows stop at the
root.  Floors and bounds only leave out what cannot rank; results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, stored

TOP = 10
SEEDS = 64
LOT_DOCS, LOT_ENTRIES = 8192, 1 << 20  # documents and vector entries of one tree
LEAF = 8
BLOCK = 1 << 18  # (item, term) pairs that one pass over the documents serves

# UTF-8: letters and digits of ASCII and all bytes of other characters belong to terms.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def saturation(tf: np.ndarray, m) -> np.ndarray:
    return (10**9 * tf) // (1000 * tf + 8 * m)


class Items:
    """The items' terms as one flat array; ``part`` keeps some of them."""

    def __init__(self, terms: list[np.ndarray]):
        self.which = np.arange(len(terms))
        self.flat = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        self.start = np.cumsum([0, *map(len, terms)])[:-1]
        self.size = np.array([len(t) for t in terms], np.int64)

    def part(self, keep: np.ndarray) -> "Items":
        out = object.__new__(Items)
        out.which, out.size = self.which[keep], self.size[keep]
        out.start = np.cumsum(out.size) - out.size
        out.flat = self.flat[np.repeat(self.start[keep] - out.start, out.size) + np.arange(out.size.sum())]
        return out

    def scores(self, dense: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        dense[terms] = values
        out = np.add.reduceat(dense[self.flat], self.start)
        dense[terms] = 0
        return out


class Tree:
    """FP-tree of vectors ``(terms, tf, m, ids)``, terms ascending in tree order."""

    def __init__(self, vectors: list[tuple], leaf: int = LEAF):
        vectors = sorted(vectors, key=lambda v: v[0].astype(">u4").tobytes())
        self.vectors = vectors
        shared = np.zeros(len(vectors), np.int64)  # length of the path shared with the vector before
        for i in range(1, len(vectors)):
            a, b = vectors[i - 1][0], vectors[i][0]
            k = min(len(a), len(b))
            differ = a[:k] != b[:k]
            at = int(differ.argmax()) if k else 0
            shared[i] = at if k and differ[at] else k
        self.range: list[tuple[int, int]] = [(0, len(vectors))]
        self.children: list[list[int]] = []
        todo = 0
        while todo < len(self.range):
            lo, hi = self.range[todo]
            todo += 1
            own: list[int] = []
            if hi - lo > leaf:
                inner = shared[lo + 1:hi]
                cuts = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
                begin = lo
                for a, b in zip(cuts, cuts[1:]):  # small sibling branches share a bucket
                    if b - begin > leaf and a > begin:
                        own.append(len(self.range))
                        self.range.append((begin, a))
                        begin = a
                own.append(len(self.range))
                self.range.append((begin, hi))
            self.children.append(own)
        n = len(self.range)
        self.terms: list = [None] * n
        self.tf: list = [None] * n
        self.m = [0] * n
        for k in range(n - 1, -1, -1):
            below = self.children[k]
            parts = ([(self.terms[c], self.tf[c], self.m[c]) for c in below] if below
                     else [v[:3] for v in vectors[slice(*self.range[k])]])
            t, f = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.argsort(t, kind="stable")
            t = t[order]
            first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
            self.terms[k], self.m[k] = t[first], min(p[2] for p in parts)
            self.tf[k] = np.maximum.reduceat(f[order], first) if len(t) else f

    def search(self, items: Items, w: np.ndarray, top: int, floor: np.ndarray) -> list[list[tuple]]:
        """Per item the ``top`` best (score, -id), unordered; scores below its floor left out."""
        best: list[list[tuple]] = [[] for _ in items.which]
        least = np.maximum(floor, 1)
        dense = np.zeros(len(w), np.int64)

        def bound(part, k):
            return part.scores(dense, self.terms[k], w[self.terms[k]] * saturation(self.tf[k], self.m[k]))

        stack = [(0, items, bound(items, 0))]
        while stack:
            k, part, most = stack.pop()
            keep = most >= least[part.which]
            if not keep.any():
                continue
            part = part if keep.all() else part.part(keep)
            if self.children[k]:
                below = [(c, part, bound(part, c)) for c in self.children[k]]
                stack += sorted(below, key=lambda x: int((x[2] - least[part.which]).max()))
                continue
            for t, f, m, ids in self.vectors[slice(*self.range[k])]:
                score = part.scores(dense, t, w[t] * saturation(f, m))
                for i in np.flatnonzero(score >= least[part.which]):
                    item, s = part.which[i], int(score[i])
                    heap = best[item]
                    for doc in ids:
                        entry = (s, -math.inf if doc is None else -doc)
                        if len(heap) < top:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        least[item] = max(least[item], heap[0][0])
        return best


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): all terms counted, those of the vocabulary as
    little-endian 32-bit numbers in ascending order."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            n, terms, tf = [], [], []
            for text in b.column(1):
                words = terms_of(text.as_py())
                found = Counter(map(vocabulary.get, filter(vocabulary.__contains__, words)))
                own = sorted(found)
                n.append(len(words))
                terms.append(np.array(own, "<i4").tobytes())
                tf.append(np.array([found[t] for t in own], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tf, pa.binary())],
                names=["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, tf binary")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""
    def run(batches):
        import pyarrow as pa
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at])], names=["term", "n"])

    df = np.zeros(size, np.int64)
    for r in vectors.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r.term] = r.n
    return df


def _ranked(vectors: DataFrame, item_ids: list, items: list[list[int]], df: np.ndarray, n_docs: int, n_terms: int,
            top: int, floor: np.ndarray) -> DataFrame:
    """(item_id, doc_id, score): each lot's best of each item, at its floor or above."""
    by_rank = np.lexsort((np.arange(len(df)), -df))
    rank = np.empty(len(df), np.int64)
    rank[by_rank] = np.arange(len(df))
    w = np.array([weight(n_docs, int(n)) if n else 0 for n in df[by_rank]], np.int64)
    in_order = [np.sort(rank[t]) for t in items]

    def run(batches):
        import pyarrow as pa
        queries = Items(in_order)

        def out(lot):
            found = Tree([(*v, heapq.nsmallest(top, ids, key=lambda d: (d is None, d))) for v, ids in
                          ((vec[k], ids) for k, ids in lot.items())]).search(queries, w, top, floor)
            rows = [(item_ids[i], None if d == -math.inf else -d, s) for i, heap in enumerate(found) for s, d in heap]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)],
                                              names=["item_id", "doc_id", "score"])

        lot: dict = {}
        vec: dict = {}
        size = 0
        for b in batches:
            for doc, n, terms, tf in zip(*(b.column(c).to_pylist() for c in range(4))):
                m = 10 + 90 * n * n_docs // n_terms
                key = (terms, tf, m)
                if key not in lot:
                    t = rank[np.frombuffer(terms, "<i4")]
                    order = np.argsort(t)
                    vec[key] = (t[order].astype(np.int32), np.frombuffer(tf, "<i4")[order].astype(np.int64), m)
                    lot[key] = []
                    size += len(t)
                lot[key].append(doc)
                if len(lot) >= LOT_DOCS or size >= LOT_ENTRIES:
                    yield out(lot)
                    lot, vec, size = {}, {}, 0
        if lot:
            yield out(lot)

    return vectors.mapInArrow(run, "item_id long, doc_id long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    at = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(at)).where(F.col("rank") <= top)


def _blocks(items: DataFrame, size: int) -> list[DataFrame]:
    """(item_id, term) split by hash of the item into blocks of at most
    ``size`` pairs (one item may exceed it)."""
    n, total = 1, items.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(n))
        most = total.groupBy(block.alias("b")).agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("items"))
        if most.where((F.col("pairs") > size) & (F.col("items") > 1)).isEmpty():
            return [items.where(block == b) for b in range(n)]
        n *= 2


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` highest-scoring documents.

    Ids are integers.  Null and empty texts have no terms; such documents and
    items get no rows.  Every row of ``docs`` is a document, repeated or not;
    rows that repeat an item_id (null included) are one item with the terms of
    all.  Among equal scores a null doc_id comes last.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    d = columns(docs, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "text")

    def split(batches):
        import pyarrow as pa
        for b in batches:
            rows = [(i, t) for i, x in zip(b.column(0).to_pylist(), b.column(1)) for t in set(terms_of(x.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "term"])

    asked = columns(benchmark, item_id=item_id, text=item_text).selectExpr("cast(item_id as long) item_id", "text")
    asked = stored(asked.mapInArrow(split, "item_id long, term binary").distinct())
    out = []
    for part in _blocks(asked, block):
        of: dict = {}
        vocabulary: dict[bytes, int] = {}
        for r in part.collect():
            of.setdefault(r.item_id, []).append(vocabulary.setdefault(bytes(r.term), len(vocabulary)))
        if not of:
            continue
        vectors = stored(_vectors(d, vocabulary))
        total = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            continue
        ids = list(of)
        fit = vectors.where(F.length("terms") > 0), ids, [of[i] for i in ids], _document_counts(vectors, len(vocabulary))
        seeds = fit[0].where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(SEEDS)) == 0)
        floor = np.zeros(len(ids), np.int64)
        number = {i: k for k, i in enumerate(ids)}
        for r in _best(_ranked(seeds, *fit[1:], total.docs, total.terms, top, floor), top).where(F.col("rank") == top).collect():
            floor[number[r.item_id]] = r.score
        out.append(_ranked(*fit, total.docs, total.terms, top, floor))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return _best(found, top).select("item_id", "rank", "doc_id", "score")
