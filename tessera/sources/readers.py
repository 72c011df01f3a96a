"""Readers.  Every reader returns a lazy DataFrame; Catalyst prunes columns
and pushes filters into the scan (partition pruning on ``year/month/day``
or ``pk/mapping`` directories included)."""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["read_query", "read_run", "read_csv", "read_many", "read_json_lines",
           "read_snapshot", "read_projected", "read_recent", "ingest", "ingest_changed", "read_curated", "read_run_tables",
           "read_mapping", "algorithms_by_key", "MAPPING_SCHEMA", "RUN_RECORD_SCHEMA", "inference_algorithms"]


def read_query(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL over named relations.  Each name is a common table expression around
    the SQL (its own definitions come first), so columns, aliases and texts that
    look like a table's name stay as they are, and so do the caller's views: the
    frames are temp views under names of their own while the SQL is analysed."""
    if not tables:
        return spark.sql(sql)
    views = {name: f"t_{uuid.uuid4().hex}" for name in tables}
    for name, view in views.items():
        tables[name].createTempView(view)
    try:
        heads = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in views.items())
        return spark.sql(f"WITH {heads} SELECT * FROM ({sql.strip().rstrip(';')}\n)")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def read_run(spark: SparkSession, path: str, as_of=None, partition_cols=("year", "month", "day"),
             schema: T.StructType | None = None) -> DataFrame:
    """Parquet dataset under hive partitions; ``as_of`` selects one run date
    by a filter on the partition columns (partition pruning)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.option("basePath", path).parquet(path)
    if as_of is not None:
        d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
        # partition discovery may type "02" as the integer 2: compare as ints
        vals = {"year": d.year, "month": d.month, "day": d.day}
        cond = reduce(lambda a, b: a & b,
                      [F.col(c).cast("int") == F.lit(vals[c]) for c in partition_cols if c in vals])
        df = df.filter(cond)
    return df


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None,
             sep: str = ",", header: bool = True, columns=None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; an explicit schema is preferred over inference.
    Quoted texts may hold line breaks and doubled quotes; a quoted empty text is
    '', an unquoted one null, and so is a lone NUL character (what ``write_csv``
    puts for a null in a file of one column, where an empty line would be no row).  Files known to hold no line break inside a text can
    be read with ``multi_line=False``: large ones are then split among tasks."""
    r = spark.read.options(header=header, sep=sep, quote='"', escape='"', multiLine=multi_line, emptyValue="", nullValue="\x00",
                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.select(*columns) if columns else df


def read_many(spark: SparkSession, paths, required_cols, fmt: str = "csv", **opts) -> DataFrame:
    """Read several files with the same required columns and append them by
    name (all files, unlike a loop that keeps only the last).

    Paths of one column order are one scan, however many they are.  Formats
    that name their columns need a single scan; of CSV paths the header lines are
    looked at first (a line each), since their columns are matched by place."""
    paths = list(paths)
    if fmt != "csv" or str(opts.get("header", False)).lower() != "true":
        return spark.read.format(fmt).options(**opts).load(paths).select(*required_cols)
    plain = {k: v for k, v in opts.items() if k.lower() not in ("inferschema", "enforceschema")}
    by_header: dict[tuple, list[str]] = {}
    for p in paths:
        by_header.setdefault(tuple(spark.read.options(**plain).csv(p).columns), []).append(p)
    frames = [spark.read.format(fmt).options(**opts).load(same).select(*required_cols) for same in by_header.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_json_lines(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Line-delimited JSON with a fixed column list; an absent field is null."""
    return spark.read.schema(schema).json(path)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Table snapshot read (Delta/Iceberg need their jars; Parquet here)."""
    return spark.read.format(fmt).load(path)


def read_projected(df: DataFrame, exprs) -> DataFrame:
    """Projected column list that may contain SQL expressions
    (e.g. ``concat(a, b) as key``): a list goes to ``selectExpr``; a
    comma-separated string is used as a select list."""
    if isinstance(exprs, str):
        return df.sparkSession.sql(f"SELECT {exprs} FROM {{df}}", df=df)
    return df.selectExpr(*exprs)


def read_recent(spark: SparkSession, path: str, fmt: str, glob: str | None = None,
                modified_after: str | None = None, schema: T.StructType | None = None,
                **opts) -> DataFrame:
    """File selection by extension (``pathGlobFilter``) and by modification
    time (``modifiedAfter``, strict), done by the file source itself."""
    r = spark.read.format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if schema is not None:
        r = r.schema(schema)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def ingest(spark: SparkSession, config_rows, target_root: str) -> list[str]:
    """Config-driven copy into a curated zone.

    ``config_rows``: small list of dicts ``{category, source, name, fmt}``;
    ``master``/``transaction`` read a table snapshot, ``manual`` reads files
    (listed once, written once).  Each target is overwritten.  The loop runs
    over the (tiny) config on the driver; every copy is a distributed job.
    """
    written = []
    for row in config_rows:
        cat, src, name = row["category"], row["source"], row["name"]
        fmt = row.get("fmt", "parquet")
        if cat in ("master", "transaction"):
            df = read_snapshot(spark, src, fmt)
        elif cat == "manual":
            df = read_recent(spark, src, fmt, glob=row.get("glob"),
                             modified_after=row.get("modified_after"), header=True)
        else:
            raise ValueError(f"unknown category {cat}")
        out = f"{target_root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(out)
        written.append(out)
    return written


def ingest_changed(spark: SparkSession, source: str, target: str, table: str, schema: T.StructType | str, fmt: str = "csv",
                   glob: str | None = None, max_files: int = 10_000, **opts) -> int:
    """Incremental copy of a folder of files into a catalogued table; returns the
    number of files taken.

    A file is new if its path, and changed if its modification time, is not in the
    table yet (a listing without contents, less a scan of two narrow columns).  New
    and changed files become batches of ``max_files`` at most, in order of time; a batch's
    rows lie under ``batch_id``, with their ``source_file`` and its time.  A batch that
    failed has no rows in the catalog and is taken again under its number, in place of what it left.
    :func:`read_curated` gives a file's latest rows only.  Rows of files that went stay.
    """
    from tessera.sinks.writers import write_catalogued
    taken = 0
    while True:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = (listing.option("pathGlobFilter", glob) if glob else listing).load(source).select(
            F.col("path").alias("source_file"), F.col("modificationTime").alias("modified"))
        batch = 0
        if spark.catalog.tableExists(table):
            known = spark.table(table)
            files = files.join(known.select("source_file", "modified").distinct(), ["source_file", "modified"], "left_anti")
            batch = (known.agg(F.max(F.col("batch_id").cast("bigint"))).first()[0] or 0) + 1
        paths = [r.source_file for r in files.orderBy("modified", "source_file").limit(max_files).collect()]
        if not paths:
            return taken
        rows = spark.read.format(fmt).schema(schema).options(**opts).load(paths)
        rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"),
                           F.lit(batch).cast("bigint").alias("batch_id"))
        write_catalogued(rows, target, table, keys=("batch_id",))
        if spark.table(table).where(F.col("batch_id") == batch).isEmpty():
            return taken  # files without rows leave no trace and would be listed again
        taken += len(paths)


def read_curated(spark: SparkSession, table: str, history: bool = False, present_in: str | None = None) -> DataFrame:
    """Rows of an :func:`ingest_changed` table: of each file those it was last
    ingested with (with ``history`` all), without the bookkeeping columns.
    ``present_in`` is the source folder: rows of files that are there no more are left out."""
    rows = spark.table(table)
    if present_in:
        there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(present_in)
        rows = rows.join(there.select(F.col("path").alias("source_file")), "source_file", "left_semi")
    if not history:
        last = rows.groupBy("source_file").agg(F.max(F.struct("modified", "batch_id")).alias("l")) \
            .select("source_file", F.col("l.modified").alias("modified"), F.col("l.batch_id").alias("batch_id"))
        rows = rows.join(last, ["source_file", "modified", "batch_id"])
    return rows.drop("source_file", "modified", "batch_id")


RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("stepjobid", T.StringType()),
    T.StructField("usecase_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("winner_algo", T.StringType()),
    T.StructField("algo_scores", T.ArrayType(T.StructType([
        T.StructField("algo_name", T.StringType()), T.StructField("algo_score", T.DoubleType())]))),
    T.StructField("preprocessing", T.StructType([
        T.StructField("start_time", T.LongType()), T.StructField("end_time", T.LongType())])),
    T.StructField("training", T.StructType([
        T.StructField("start_time", T.LongType()), T.StructField("end_time", T.LongType())])),
    T.StructField("total_jobs", T.LongType()),
    T.StructField("failed_jobs", T.LongType()),
])


def read_run_tables(spark: SparkSession, base: str, schema: T.StructType = RUN_RECORD_SCHEMA,
                    table: str | None = None, partition_cols=("year", "month", "day", "stepjobid")) -> DataFrame:
    """Nested-JSON run records partitioned ``year=/month=/day=/stepjobid=``;
    partition discovery adds the partition columns.  With ``table`` the
    dataset is catalogued as an external table and its partitions repaired."""
    df = spark.read.schema(schema).option("basePath", base).json(base)
    if table:
        parts = ", ".join(f"{c} STRING" for c in partition_cols)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in partition_cols)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, {parts}) USING json "
                  f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{base}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")
        return spark.table(table)
    return df


MAPPING_SCHEMA = T.StructType([T.StructField("mapping_json_data", T.StructType([
    T.StructField("primary_key", T.StringType()),
    T.StructField("Inference", T.StructType([
        T.StructField("mappingColumn", T.StringType()),
        T.StructField("all_algorithms", T.ArrayType(T.StringType())),
        T.StructField("mapping", T.MapType(T.StringType(), T.ArrayType(T.StringType())))])),
    T.StructField("Training", T.StructType([
        T.StructField("mappingColumn", T.StringType()),
        T.StructField("all_algorithms", T.ArrayType(T.StringType()))])),
]))])


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping document(s) -> primary key, mapping columns and algorithm sets.

    The inference algorithm list falls back to the distinct concatenation of
    the per-key map values when ``all_algorithms`` is empty."""
    m = spark.read.schema(MAPPING_SCHEMA).option("multiLine", True).json(path)
    d = F.col("mapping_json_data")
    return m.select(
        d["primary_key"].alias("primary_key"),
        d["Training"]["mappingColumn"].alias("training_mapping_column"),
        d["Training"]["all_algorithms"].alias("training_algorithms"),
        d["Inference"]["mappingColumn"].alias("inference_mapping_column"),
        inference_algorithms(d["Inference"]).alias("inference_algorithms"),
        d["Inference"]["all_algorithms"].alias("inference_all"), d["Inference"]["mapping"].alias("inference_map"))


def algorithms_by_key(rows: DataFrame, mapping: DataFrame, key: str, out: str = "algorithms") -> DataFrame:
    """Inference algorithms of each row: the document's list if it has one, else
    the list of the row's ``key`` (null if it has none)."""
    doc = mapping.agg(F.first(F.struct("inference_all", "inference_map"))).scalar()
    listed = doc.getField("inference_all")
    return rows.withColumn(out, F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, listed).otherwise(
        F.try_element_at(doc.getField("inference_map"), F.col(key))))


def inference_algorithms(inference):
    listed = inference["all_algorithms"]
    from_map = F.array_distinct(F.flatten(F.map_values(inference["mapping"])))
    return F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, listed).otherwise(from_map)
