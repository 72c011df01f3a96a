"""Projections and derived columns (DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import dates as D


def project(df: DataFrame, mapping: dict[str, str] | list[str]) -> DataFrame:
    """Select/rename/reorder.  A mapping ``{source: target}`` is tolerant:
    sources that do not exist are skipped (the rename is a no-op there).
    """
    if isinstance(mapping, dict):
        have = set(df.columns)
        return df.select(*[F.col(s).alias(t) for s, t in mapping.items() if s in have])
    return df.select(*mapping)


def apply_schema(df: DataFrame, schema: T.StructType, tolerant: bool = True,
                 skip_types: tuple = ()) -> DataFrame:
    """Cast to a declared load schema (column order of the schema).

    ``tolerant`` uses ``try_cast`` so dirty text becomes null instead of
    failing the load; ``skip_types`` keeps columns of those types as they are.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, skip_types):
            cols.append(c.alias(f.name))
        elif tolerant:
            cols.append(c.try_cast(f.dataType).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def with_load_ts(df: DataFrame, as_of, name: str = "glue_last_updated") -> DataFrame:
    """Load-audit time text (UTC+5:30 of ``as_of``)."""
    return df.withColumn(name, D.load_ts_text(as_of))


def with_uid(df: DataFrame, order_cols, as_of, name: str = "uid") -> DataFrame:
    """Row uid ``<index>-<load_ts>`` where index is 0-based in ``order_cols`` order.

    A global row number needs a total order; ``zipWithIndex`` style numbering
    is used so the rows are never gathered into one task: rank each row inside
    its range partition, then add the running count of earlier partitions.
    """
    ts = D.load_ts_text(as_of)
    idx = global_index(df, order_cols)
    return idx.withColumn(name, F.concat(F.col("_idx").cast("string"), F.lit("-"), ts)) \
        .drop("_idx")


def global_index(df: DataFrame, order_cols, name: str = "_idx") -> DataFrame:
    """0-based dense row index in ``order_cols`` order without a one-task window.

    Rows are range-partitioned on the order, numbered inside each partition,
    and offset by the row counts of the preceding partitions (a tiny per-
    partition count table, broadcast back).
    """
    from pyspark.sql import Window

    from tessera.session import cut_lineage
    spark = df.sparkSession
    # the numbering reads its input three times (range sample, partition
    # counts, rows): materialise it once in the shared checkpoint folder
    df = cut_lineage(df.select(*df.columns))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    # monotonically_increasing_id = (partition index << 33) + position in the
    # partition, so after a range shuffle and a local sort the position is the
    # rank inside the partition: no second shuffle for a window.
    # Range bounds come from a sample whose seed depends on the job, so the
    # numbered partitions are written once and both the per-partition counts
    # and the rows are read from that copy.
    local = cut_lineage(df.repartitionByRange(n_parts, *order_cols)
                        .sortWithinPartitions(*order_cols)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_local", F.monotonically_increasing_id()
                                    - F.shiftleft(F.col("_pid").cast("bigint"), 33)))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return local.join(F.broadcast(offsets.select("_pid", "_off")), "_pid") \
        .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint")) \
        .drop("_pid", "_local", "_off")


def with_row_id(df: DataFrame, key_cols, name: str = "row_id") -> DataFrame:
    """Deterministic row id: SHA-256 of the key columns (reruns give the same id)."""
    return df.withColumn(name, F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string")
                                                             for c in key_cols]), 256))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Null defaults per column (``nvl``)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_run_cols(df: DataFrame, as_of, run_id: str | None = None) -> DataFrame:
    """Run/partition literals year, month, day (and correlation id)."""
    y, m, d = D.run_parts(as_of)
    out = df.withColumns({"year": y, "month": m, "day": d})
    if run_id is not None:
        out = out.withColumn("corelation_id", F.lit(run_id))
    return out


def with_source(df: DataFrame, path_col: str | None = None, name: str = "source",
                rename: dict | None = None, literal: str | None = None) -> DataFrame:
    """Source-folder name as a column: a literal, or the parent folder of the
    file each row came from; ``rename`` maps folder names to source names."""
    if literal is not None:
        src = F.lit(literal)
    else:
        p = F.col(path_col) if path_col else F.input_file_name()
        src = F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)
    if rename:
        m = F.create_map(*[x for kv in rename.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        src = F.coalesce(F.try_element_at(m, src), src)
    return df.withColumn(name, src)
