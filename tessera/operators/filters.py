"""Row filters (DataFrame -> DataFrame).

Every predicate is a plain Catalyst expression, so simple comparisons on
scan columns are pushed into the Parquet reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.functions._util import as_col


def code_rule(code, base, deny=S.MODEL_CODE_DENY, prefix=S.MODEL_CODE_PREFIX,
              base_deny=S.BASE_CODE_DENY) -> Column:
    """Product-code rule: not null, not in the exact deny list, starts with
    ``prefix``, base code not in ``base_deny``.  Deny entries are literals.
    """
    c, b = as_col(code), as_col(base)
    return (c.isNotNull()
            & ~F.coalesce(c.isin(list(deny)), F.lit(False))
            & c.startswith(prefix)
            & ~F.coalesce(b.isin(list(base_deny)), F.lit(False)))


def filter_codes(df: DataFrame, code: str, base: str, deny=S.MODEL_CODE_DENY,
                 prefix=S.MODEL_CODE_PREFIX, base_deny=S.BASE_CODE_DENY) -> DataFrame:
    return df.filter(code_rule(code, base, deny, prefix, base_deny))


def exclude_keep_null(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose value is in ``values``; null values stay (pandas ``~isin``)."""
    return df.filter(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive window on a column."""
    return df.filter(F.col(col).between(lo, hi))


def trim_ne(c, value) -> Column:
    """``trim(c) <> value`` (null -> false, as SQL)."""
    return F.trim(as_col(c)) != F.lit(value)


def numeric_gt(c, x: float = 0.0) -> Column:
    """Numeric guard on text: ``try_cast(c as double) > x``."""
    return as_col(c).cast("string").try_cast("double") > F.lit(float(x))


def code_pattern(c) -> Column:
    """Length > 3, second char ``A``, last three ``500``; null -> false."""
    x = as_col(c)
    return F.coalesce((F.length(x) > 3) & x.rlike(r"^.A.*500$"), F.lit(False))


def filter_channel(df: DataFrame, col: str, channels, lang_col: str | None = None,
                   lang: str = "en") -> DataFrame:
    """Case-insensitive membership in a channel list (and language equal)."""
    cond = F.upper(F.col(col)).isin([c.upper() for c in channels])
    if lang_col:
        cond = cond & (F.col(lang_col) == lang)
    return df.filter(cond)


def not_null(df: DataFrame, cols) -> DataFrame:
    return df.dropna(subset=list(cols))


def spam_flag(c, limit: int = 4) -> Column:
    """True when both mention and hashtag counts are at most ``limit``."""
    return (S.mention_count(c) <= limit) & (S.hashtag_count(c) <= limit)


def score_gate(model_found, part_found, flag, sentiment) -> Column:
    """Score only posts with a model and a part, flag true, sentiment < 0."""
    return (as_col(model_found).isNotNull() & as_col(part_found).isNotNull()
            & F.coalesce(as_col(flag), F.lit(False)) & (as_col(sentiment) < 0))
