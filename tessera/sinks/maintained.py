"""Loads into a table that is kept in order as a whole (K06 with W05, U07, A10).

After each load a rule holds over all rows, old and new: one row per message,
texts of old posts gone.  The table is Parquet partitioned by one column; a
load rewrites only the partitions that it can change (copy on write) and then moves
those partitions' locations in the catalog.  Which they are tells a narrow index
beside the table: for each row the hash of its key, the day on which the rule changes
it by age, and the load it came with.

A partition is old or new, never half of either.  Rows carry the id of their load, and a load
that is tried again first drops what it left, so it can be repeated after any failure.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["merge_load", "drop_unreferenced"]


def _register(spark, table: str, df: DataFrame, part: str, path: str) -> None:
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet PARTITIONED BY (`{part}`) LOCATION '{path}/empty'")


def _move(spark, table: str, part: str, touched: list[str], path: str) -> None:
    """The touched partitions' locations become those under ``path``; those without rows there go."""
    home = spark._jvm.org.apache.hadoop.fs.Path
    fs = home(path).getFileSystem(spark._jsc.hadoopConfiguration())
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for value in touched:
        folder, spec = f"{part}={value}", f"`{part}` = '{value}'"
        place = f"{path}/{folder}"
        if not fs.exists(home(place)):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        elif folder in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def merge_load(batch: DataFrame, table: str, base: str, load_id: str, rule: Callable[[DataFrame], DataFrame], *,
               part: str, key: str, changes_on: Column, as_of) -> list[str]:
    """Append ``batch`` to ``table`` and apply ``rule`` to all rows that it can
    change; returns the partitions rewritten.

    ``rule`` maps rows to the rows that stay and may depend on rows of equal ``key``
    and on a row itself, no others.  ``changes_on`` is the day from which age alone
    changes a row (null: never).  ``part`` is a column of plain texts such as ``2024-02``
    (letters, digits, ``.``, ``_``, ``-``; null: ``none``).  Null keys are equal to none.  An empty batch still lets rows age.
    """
    spark = batch.sparkSession
    index = f"{table}_index"
    batch = batch.withColumn(part, F.coalesce(F.col(part).cast("string"), F.lit("none"))).withColumn("load_id", F.lit(load_id))
    _register(spark, table, batch, part, f"{base}/rows")

    def entries(rows: DataFrame) -> DataFrame:
        return rows.select(F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias("h"),
                           changes_on.cast("date").alias("changes_on"), "load_id", part)

    new = entries(batch)
    _register(spark, index, new, part, f"{base}/index")
    held = spark.table(index)
    touched = (new.select(part)
               .unionByName(held.join(new.where("h is not null").select("h").distinct(), "h", "left_semi").select(part))
               .unionByName(held.where((F.col("changes_on") <= F.lit(str(as_of)).cast("date")) | (F.col("load_id") == load_id)).select(part)))
    touched = sorted(r[0] for r in touched.distinct().collect())  # partitions, not rows
    if odd := [x for x in touched if not re.fullmatch(r"[\w.-]+", x, re.ASCII)]:
        raise ValueError(f"not a plain partition value: {odd[0]!r}")
    rows = spark.table(table).where(F.col(part).isin(touched) & (F.col("load_id") != load_id))
    rows = rule(rows.unionByName(batch)).select(*[c for c in batch.columns if c != part], part)
    attempt = f"{load_id}-{uuid.uuid4().hex[:12]}"
    places = f"{base}/rows/{attempt}", f"{base}/index/{attempt}"
    rows.write.partitionBy(part).parquet(places[0])
    written = spark.read.option("basePath", places[0]).schema(rows.schema).parquet(places[0])
    entries(written).write.partitionBy(part).parquet(places[1])
    # the rows first: until the index follows, a repeated load still finds every partition it needs
    _move(spark, table, part, touched, places[0])
    _move(spark, index, part, touched, places[1])
    return touched


def drop_unreferenced(spark, table: str, base: str) -> int:
    """Delete partition folders of earlier loads that the table points to no more (run
    it when no query started before the last load is running); returns how many."""
    home = spark._jvm.org.apache.hadoop.fs.Path
    fs = home(base).getFileSystem(spark._jsc.hadoopConfiguration())
    whole = lambda p: fs.makeQualified(home(p)).toUri().getPath()
    gone = 0
    for name, kind in ((table, "rows"), (f"{table}_index", "index")):
        used = set()
        for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
            column, _, value = r[0].partition("=")
            about = spark.sql(f"DESCRIBE FORMATTED {name} PARTITION (`{column}` = '{value}')").collect()
            used.add(whole(next(x.data_type for x in about if x.col_name == "Location")))
        for load in fs.listStatus(home(f"{base}/{kind}")):
            folders = [f.getPath() for f in fs.listStatus(load.getPath()) if f.isDirectory()]
            old = [f for f in folders if whole(f.toString()) not in used]
            for f in old:
                fs.delete(f, True)
            if len(old) == len(folders):
                fs.delete(load.getPath(), True)
            gone += len(old)
    return gone
