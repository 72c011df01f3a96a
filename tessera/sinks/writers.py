"""Writers (K*).  Each is one distributed write; reruns of a run date are
idempotent through dynamic partition overwrite (only the partitions being
written are replaced)."""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import dates as D
from tessera.operators.projections import apply_schema

__all__ = ["write_run", "write_csv", "write_keyed", "write_catalogued", "load_full", "load_append",
           "stage_single", "write_dashboard", "write_outcomes", "archive_snapshot", "write_ndjson",
           "write_features", "length_violations", "table_location"]


def _dynamic(df: DataFrame):
    return df.write.option("partitionOverwriteMode", "dynamic")


def write_run(df: DataFrame, path: str, as_of, compression: str = "snappy", mode: str = "overwrite") -> None:
    """Parquet under ``year=/month=/day=`` of the run date.  ``overwrite`` is
    dynamic (replaces that day only), so a rerun does not duplicate rows;
    ``append`` keeps the append-only behaviour."""
    y, m, d = D.run_parts(as_of)
    out = df.withColumns({"year": y, "month": m, "day": d})
    w = _dynamic(out) if mode == "overwrite" else out.write
    w.mode(mode).partitionBy("year", "month", "day").option("compression", compression).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", max_records: int = 1_000_000) -> None:
    """CSV with a header, no index, ``max_records`` rows a file at most, for a file
    with line breaks in texts is read by one task.  Texts keep their line breaks
    and quotes (quoted, quotes doubled); an empty text is written as ``""``, a null
    as nothing; in a file of one column, where that would be an empty line, as a NUL character."""
    null = "\x00" if len(df.columns) == 1 else ""
    df.write.mode(mode).options(header=True, sep=sep, quote='"', escape='"', emptyValue='""', nullValue=null,
                                maxRecordsPerFile=max_records,
                                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_keyed(df: DataFrame, path: str, keys=("pk", "mapping"), fmt: str = "parquet", max_records: int = 5_000_000) -> None:
    """Parquet partitioned by the model keys; a rerun replaces exactly the
    key partitions it writes (dynamic overwrite), the 'clear the earlier
    output prefix' step of the source.  Rows are rebalanced by key: adaptive execution
    writes a key of few rows in one task and splits one that holds much of them."""
    _dynamic(df.hint("rebalance", *[F.col(k) for k in keys])).mode("overwrite").option("maxRecordsPerFile", max_records) \
        .partitionBy(*keys).format(fmt).save(path)


def table_location(spark, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def _same_place(spark, a: str, b: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    x, y = (path(p).getFileSystem(conf).makeQualified(path(p)).toString().rstrip("/") for p in (a, b))
    return x == y


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_catalogued(df: DataFrame, path: str, table: str, keys=("year", "month", "day")) -> None:
    """Snappy Parquet partitioned by date keys and registered in the catalog.
    A later write replaces only the partitions it holds.  A table known under
    another path is an error: its readers would not see the rows."""
    spark = df.sparkSession
    known = spark.catalog.tableExists(table)
    if known and not _same_place(spark, table_location(spark, table), path):
        raise ValueError(f"table {table} lies at {table_location(spark, table)}, not at {path}")
    _dynamic(df).mode("overwrite").partitionBy(*keys).option("compression", "snappy").parquet(path)
    if not known:
        spark.sql(f"CREATE TABLE {table} ({_columns_ddl(df.schema)}) USING parquet "
                  f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def load_full(df: DataFrame, schema: T.StructType, target: str, fmt: str = "parquet", table: str | None = None,
              check=None) -> str:
    """Full-refresh typed load: cast to the declared schema, replace the target.
    Returns the folder that holds the rows.

    The rows go to a folder of their own first and are counted there; readers see
    the old rows until the new ones are whole, and keep them if the load fails.  With
    ``table`` the folder is ``target/version=<id>`` and the catalog's location moves to it (the
    version before stays for running queries, older ones go); without one
    the folder takes the target's name.  ``check(loaded)`` may raise to refuse the new rows."""
    spark = df.sparkSession
    version = uuid.uuid4().hex
    home = target.rstrip("/")
    fresh = f"{home}/version={version}" if table else f"{home}-loading-{version}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(home).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        rows, seen = apply_schema(df, schema), Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).save(fresh)
        loaded = spark.read.format(fmt).schema(schema).load(fresh)
        found = loaded.count()
        # the observation of a plan known to be empty never ends: it is not asked
        if found != (seen.get["n"] if found else rows.limit(1).count()):
            raise RuntimeError(f"{fresh} does not hold the rows written")
        if check:
            check(loaded)
    except BaseException:
        fs.delete(path(fresh), True)
        raise
    if table:
        if not spark.catalog.tableExists(table):
            spark.sql(f"CREATE TABLE {table} ({_columns_ddl(schema)}) USING {fmt} LOCATION '{fresh}'")
            return fresh
        before = table_location(spark, table)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
        spark.catalog.refreshTable(table)
        for old in fs.listStatus(path(home)):
            place = old.getPath().toString()
            if old.getPath().getName().startswith("version=") and not any(_same_place(spark, place, p) for p in (before, fresh)):
                fs.delete(old.getPath(), True)
        return fresh
    old = f"{home}-replaced-{version}"
    if fs.exists(path(home)):
        fs.rename(path(home), path(old))
    if not fs.rename(path(fresh), path(home)):
        fs.rename(path(old), path(home))
        raise RuntimeError(f"{fresh} could not take the place of {home}")
    fs.delete(path(old), True)
    return home


def length_violations(df: DataFrame, max_len: dict[str, int]) -> DataFrame:
    """Rows whose text exceeds a declared VARCHAR length (kept for review)."""
    cond = None
    for c, n in max_len.items():
        x = F.length(F.col(c)) > n
        cond = x if cond is None else cond | x
    return df.filter(F.coalesce(cond, F.lit(False)))


def load_append(df: DataFrame, schema: T.StructType, target: str, max_len: dict[str, int] | None = None,
                fmt: str = "parquet", too_long: str = "fail", rejects: str | None = None, load_id: str | None = None) -> None:
    """Append typed load.  A text longer than declared in ``max_len`` fails the load;
    with ``too_long="reject"`` its row goes to the ``rejects`` path instead, and
    only ``too_long="cut"`` cuts it.

    With ``load_id`` the rows (and rejects) lie under ``load_id=<id>`` and a load that
    is tried again replaces what it wrote before; without one it appends again."""
    def save(rows: DataFrame, path: str) -> None:
        if load_id is None:
            rows.write.mode("append").format(fmt).save(path)
        else:
            # a folder of its own: replaced even if the retry has no rows
            rows.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/load_id={load_id}")

    x = apply_schema(df, schema)
    if max_len and too_long == "cut":
        x = x.withColumns({c: F.substring(F.col(c), 1, n) for c, n in max_len.items()})
    elif max_len and too_long == "reject":
        if not rejects:
            raise ValueError("rejecting rows needs a path for them")
        save(length_violations(x, max_len), rejects)
        long = reduce(lambda a, b: a | b, [F.coalesce(F.length(F.col(c)) > n, F.lit(False)) for c, n in max_len.items()])
        x = x.filter(~long)
    elif max_len:
        x = x.withColumns({c: F.when(F.length(F.col(c)) > n, F.raise_error(F.lit(f"{c} is longer than {n}")))
                           .otherwise(F.col(c)) for c, n in max_len.items()})
    save(x, target)


def stage_single(df: DataFrame, path: str, casts: dict[str, str] | None = None) -> None:
    """Cast columns and write a staged Parquet file.  The rows are rebalanced after
    they are computed: a result below the advisory partition size is one file, a
    larger one as many as it needs, and no step above is narrowed to one task."""
    x = df.withColumns({c: F.col(c).cast(t) for c, t in (casts or {}).items()})
    x.hint("rebalance").write.mode("overwrite").parquet(path)


def write_dashboard(df: DataFrame, path: str) -> None:
    """Overwrite Parquet at a use-case/date path."""
    df.write.mode("overwrite").parquet(path)


def write_outcomes(df: DataFrame, path: str) -> None:
    """Append Parquet at a correlation-id path."""
    df.write.mode("append").parquet(path)


def archive_snapshot(df: DataFrame, path: str, as_of) -> str:
    """Write the loaded snapshot under ``archive_ts=<as_of>``; clearing the
    source is left to the caller."""
    ts = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    out = f"{path.rstrip('/')}/archive_ts={ts:%Y%m%d%H%M%S}"
    df.write.mode("overwrite").parquet(out)
    return out


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Newline-delimited JSON records (nested structs and arrays kept)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_features(df: DataFrame, path: str, defaults: dict, as_of, event_time_col: str = "event_time") -> None:
    """Offline feature snapshot: null defaults, literal event time, append."""
    x = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    ts = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    x = x.withColumn(event_time_col, F.lit(ts.strftime("%Y-%m-%dT%H:%M:%SZ")))
    x.write.mode("append").parquet(path)
