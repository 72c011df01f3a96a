"""Set operations and conditional updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates as D


def union_by_name(dfs, required_cols=None) -> DataFrame:
    """Append many inputs by column name (missing columns -> null), then
    keep ``required_cols`` in that order if given."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(dfs))
    return out.select(*required_cols) if required_cols else out


def union_overall(outcomes: DataFrame, overall: DataFrame) -> DataFrame:
    """Append overall-status rows to rule rows; columns the overall rows do
    not have become typed nulls of the outcome schema."""
    cols = []
    have = set(overall.columns)
    for f in outcomes.schema.fields:
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                    else F.lit(None).cast(f.dataType).alias(f.name))
    return outcomes.unionByName(overall.select(*cols))


def once_only(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that appear exactly once in ``A UNION ALL B`` (full-row)."""
    cols = a.columns
    return a.unionByName(b).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")) \
        .filter(F.col("_n") == 1).drop("_n")


def is_subset(small, big) -> Column:
    """True when every element of array ``small`` is in array ``big``."""
    s = F.col(small) if isinstance(small, str) else small
    b = F.col(big) if isinstance(big, str) else big
    return F.size(F.array_except(s, b)) == 0


def read_windows(df: DataFrame, col: str, windows) -> DataFrame:
    """Union of date-window extracts as one scan with an OR of ranges."""
    cond = reduce(lambda x, y: x | y, [F.col(col).between(F.lit(lo), F.lit(hi))
                                        for lo, hi in windows])
    return df.filter(cond)


# The extract windows of the spares mart, as written there
# (fiscal years 2019-20 and 2021-22 are not among them).
SPARES_WINDOWS = [
    ("2015-04-01", "2016-03-31"), ("2016-04-01", "2017-03-31"),
    ("2017-04-01", "2018-03-31"), ("2018-04-01", "2019-03-31"),
    ("2020-04-01", "2021-03-31"), ("2022-04-01", "2023-03-31"),
]


def purge(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE WHERE cond, as the complement filter (null cond keeps the row)."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def redact(df: DataFrame, date_col: str, sentiment_col: str, text_cols, as_of,
           months: int = 12, neutral=0) -> DataFrame:
    """Null the text columns where (age <= months and neutral sentiment) or
    (age > months); age is ``months_between(as_of, date)``."""
    age = D.months_old(date_col, as_of)
    cond = ((age <= months) & (F.col(sentiment_col) == F.lit(neutral))) | (age > months)
    cond = F.coalesce(cond, F.lit(False))
    return df.withColumns({c: F.when(cond, F.lit(None).cast(df.schema[c].dataType))
                          .otherwise(F.col(c)) for c in text_cols})
