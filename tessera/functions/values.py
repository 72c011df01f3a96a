"""Map / JSON / math scalar functions and null handling (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col

# Sentiment scale kept by the social posts mart.
SENTIMENT_VALUES = [-2, -1, 0, 1, 2]


def json_get(c, key: str) -> Column:
    """Value of a top-level key of a JSON object text; missing/invalid -> null."""
    return F.get_json_object(as_col(c), f"$.{key}")


def map_get(c, key: str) -> Column:
    """Value of a key of a MAP column; missing -> null."""
    return F.try_element_at(as_col(c), F.lit(key))


def norm_sentiment(c) -> Column:
    """Sentiment as an integer in -2..2 (``-1`` and ``-1.0`` alike), anything
    else (or null) -> 0."""
    v = as_col(c).cast("string").try_cast("double")
    return F.when(v.isin([float(x) for x in SENTIMENT_VALUES]), v.cast("int")).otherwise(F.lit(0))


def percent(score, digits: int = 2) -> Column:
    """Score in [0,1] as a rounded percentage."""
    return F.round(as_col(score) * 100, digits)


def blend(s1, s2, w1: float, w2: float) -> Column:
    """Weighted blend ``s1 / w1 + s2 / w2`` of two scores."""
    return as_col(s1) / F.lit(float(w1)) + as_col(s2) / F.lit(float(w2))


def sum_measures(a, b) -> Column:
    """Null -> 0 then add."""
    return F.coalesce(as_col(a), F.lit(0)) + F.coalesce(as_col(b), F.lit(0))


def blank_to_null(c) -> Column:
    """Empty or blank text -> null."""
    x = as_col(c)
    return F.when(F.trim(x) == "", F.lit(None).cast("string")).otherwise(x)


def fill_from(c, other, n: int = 5) -> Column:
    """Null (after :func:`blank_to_null`) filled from a prefix of another column."""
    return F.coalesce(blank_to_null(c), F.substring(as_col(other), 1, n))


def actual_value(metrics_map) -> Column:
    """Single metric value of a rule's metric map; ``NA`` if it holds more."""
    m = as_col(metrics_map)
    return F.when(F.size(m) > 1, F.lit("NA")) \
        .otherwise(F.element_at(F.map_values(m), 1).cast("string"))


def minmax_expr(x, lo, hi) -> Column:
    """Min-max scaling given the bounds; a constant column scales to 0."""
    x, lo, hi = as_col(x), as_col(lo), as_col(hi)
    return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


def cosine(a, b) -> Column:
    """Cosine of two equal-length numeric arrays (null if a norm is 0)."""
    a, b = as_col(a), as_col(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, v: s + v * v))
    return F.when((na == 0) | (nb == 0), F.lit(None).cast("double")).otherwise(dot / (na * nb))
