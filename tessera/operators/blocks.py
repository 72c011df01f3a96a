"""Similarity of many words (or vectors) with a dictionary's, block by block.

Both sides are dealt by hash into blocks of bounded size, each block of the one
meets each block of the other in a task, and a matrix product gives all their
similarities at once.  Nothing is collected or broadcast: a larger side is more
blocks, by the same method.  Words are compared by the Jaccard index of their character
bigrams (a product of 0/1 matrices counts shared bigrams exactly), vectors by cosine.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 20  # pairs of words counted at once
MARKS = 1 << 26  # bigrams by words of a dictionary marked at once


def bigrams(word: str) -> set[str]:
    return {word[i:i + 2] for i in range(len(word) - 1)}


def places(words: list[str], column: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, column) of every bigram in ``column``, by word, and each word's number of bigrams."""
    at, to, sizes = [], [], np.zeros(len(words))
    for i, w in enumerate(words):
        grams = bigrams(w)
        sizes[i] = len(grams)
        for g in grams:
            k = column.get(g)
            if k is not None:
                at.append(i)
                to.append(k)
    return np.array(at, np.int64), np.array(to, np.int64), sizes


def columns(words: list[str]) -> dict[str, int]:
    """A number for every bigram of ``words``."""
    column: dict[str, int] = {}
    for w in words:
        for g in bigrams(w):
            column.setdefault(g, len(column))
    return column


def indicator(words: list[str], column: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrix of words by the bigrams in ``column``, and each word's number of bigrams."""
    at, to, sizes = places(words, column)
    out = np.zeros((len(words), len(column)), np.float32)
    out[at, to] = 1
    return out, sizes


def shared(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bigrams that every word of ``a`` shares with every word of ``b``, and each word's number of them."""
    column = columns(b)
    x, nx = indicator(a, column)
    y, ny = indicator(b, column)
    return x @ y.T, nx, ny


def jaccard(a: list[str], b: list[str]) -> np.ndarray:
    """Jaccard index of every word of ``a`` with every word of ``b`` (0 where no bigram is shared)."""
    both, nx, ny = shared(a, b)
    both = both.astype(np.float64)
    return np.divide(both, nx[:, None] + ny[None, :] - both, out=np.zeros_like(both), where=both > 0)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, bigram as a number) of every different bigram of a word, by word, and each word's number of them."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), size)
    inside = word[1:] == word[:-1]
    word, gram = word[1:][inside], (letters[:-1] << 21 | letters[1:])[inside]
    order = np.lexsort((gram, word))
    word, gram = word[order], gram[order]
    first = np.ones(len(gram), bool)
    first[1:] = (gram[1:] != gram[:-1]) | (word[1:] != word[:-1])
    return word[first], gram[first], np.bincount(word[first], minlength=len(words))


def jaccard_above(a: list[str], b: list[str], t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, index) of the pairs whose Jaccard index is ``t`` (over 0) or more, by i.

    Each bigram of ``b`` is a row that marks the words with it; the rows of a word's bigrams are
    added up, one byte a pair, for as many words at once as ``CELLS`` pairs allow.  Only pairs that
    share as many bigrams as their sizes ask for are compared."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    of, gb, ny = grams(b)
    column = np.unique(gb)
    if not len(column):
        return none
    if len(b) > 1 and len(column) * len(b) > MARKS:
        half = len(b) // 2
        parts = jaccard_above(a, b[:half], t), jaccard_above(a, b[half:], t)
        i, j, index = (np.concatenate(x) for x in zip(parts[0], (parts[1][0], parts[1][1] + half, parts[1][2])))
        order = np.argsort(i, kind="stable")
        return i[order], j[order], index[order]
    width = -(-len(b) // 8) * 8  # eight pairs at a time are looked through
    kind = np.uint8 if ny.max() < 256 else np.int32
    marked = np.zeros((len(column), width), kind)
    marked[np.searchsorted(column, gb), of] = 1
    word, gram, nx = grams(a)
    at = np.minimum(np.searchsorted(column, gram), len(column) - 1)
    known = column[at] == gram
    at = at[known]
    n = np.bincount(word[known], minlength=len(a))
    begin = np.cumsum(n) - n
    # index >= t means both >= t / (1 + t) * (nx + ny)
    enough = t / (1 + t) * (1 - 1e-9)
    sizes, size = np.unique(nx, return_inverse=True)
    least = np.full((len(sizes), width), np.iinfo(kind).max, kind)
    least[:, :len(b)] = np.clip(np.ceil(enough * (sizes[:, None] + ny)), 1, np.iinfo(kind).max)
    able = np.flatnonzero(n >= np.maximum(1, np.ceil(enough * nx)))
    able = able[np.argsort(-n[able], kind="stable")]
    lot = max(1, CELLS // width)
    both, more, alike = (np.empty((min(lot, len(able)), width), k) for k in (kind, kind, bool))
    found = [none]
    for lo in range(0, len(able), lot):
        w = able[lo:lo + lot]
        np.take(marked, at[begin[w]], axis=0, out=both[:len(w)], mode="clip")
        for k in range(1, n[w[0]]):  # those with more than k come first
            m = np.searchsorted(-n[w], -k)
            np.take(marked, at[begin[w[:m]] + k], axis=0, out=more[:m], mode="clip")
            np.add(both[:m], more[:m], out=both[:m])
        np.take(least, size[w], axis=0, out=more[:len(w)], mode="clip")
        np.greater_equal(both[:len(w)], more[:len(w)], out=alike[:len(w)])
        eight = np.flatnonzero(alike[:len(w)].reshape(-1).view(np.uint64) != 0)
        hit = np.flatnonzero(alike.reshape(-1, 8)[eight])
        pair = eight[hit >> 3] * 8 + (hit & 7)
        i, j = np.divmod(pair, width)
        count = both.ravel()[pair].astype(np.float64)
        index = count / (nx[w[i]] + ny[j] - count)
        keep = index >= t
        found.append((w[i[keep]], j[keep], index[keep]))
    i, j, index = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(i, kind="stable")
    return i[order], j[order], index[order]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero and non-finite rows become zero."""
    n = np.sqrt((x * x).sum(1, keepdims=True))
    ok = np.isfinite(n) & (n > 0)
    return np.where(ok, x, 0.0) / np.where(ok, n, 1.0)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of every row of ``a`` with every row of ``b``; zero and non-finite rows are like nothing."""
    return unit(a) @ unit(b).T


def cosine_above(a: np.ndarray, b: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine) of the pairs whose cosine is ``t`` or more, by i; as many rows at once as ``CELLS`` pairs allow."""
    a, b = unit(a), unit(b)
    lot = max(1, CELLS // max(1, len(b)))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for lo in range(0, len(a), lot):
        sim = a[lo:lo + lot] @ b.T
        i, j = np.nonzero(sim >= t)
        found.append((lo + i, j, sim[i, j]))
    return tuple(np.concatenate(x) for x in zip(*found))


def met(left: DataFrame, right: DataFrame, left_by, right_by, left_size: int, right_size: int, within: str | None = None,
        left_rows: int | None = None):
    """Each block of ``left`` with each block of ``right``, as a co-grouped pair.

    ``left_by`` and ``right_by`` are the columns whose hash deals rows to blocks of about
    ``left_size`` and ``right_size`` rows; with ``within`` only blocks of equal values of that column meet.
    ``left_rows`` spares counting ``left``, which is made once then.
    """
    def blocks(df: DataFrame, size: int) -> int:
        per = df.groupBy(within).count().agg(F.max("count")) if within else df.agg(F.count(F.lit(1)))
        return max(1, -(-(per.first()[0] or 0) // size))

    nl = blocks(left, left_size) if left_rows is None else max(1, -(-left_rows // left_size))
    nr = blocks(right, right_size)
    number = lambda cols, n: F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lf = left.withColumn("_lb", number(left_by, nl)).withColumn("_rb", every(nr))
    rt = right.withColumn("_rb", number(right_by, nr)).withColumn("_lb", every(nl))
    keys = [*([within] if within else []), "_lb", "_rb"]
    return lf.groupBy(*keys).cogroup(rt.groupBy(*keys))
