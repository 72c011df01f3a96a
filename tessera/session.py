"""Session and table helpers.

Everything here is configuration a Spark user would set anyway: AQE with
skew-join splitting and partition coalescing, UTC session time, Arrow for
pandas exchange.  Nothing is cluster-specific; on a cluster the submitter's
settings win because ``getOrCreate`` reuses the running session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Defaults sized for local[N]; a cluster run passes its own values.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only in local mode, where one machine runs everything, is a scratch folder
    chosen if none is set (tests); on a cluster that is an error, for
    executors can't read each other's local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet in a shared folder and read back.  For loops of
    many rounds: a checkpoint keeps the size that the optimizer estimated, which joins
    multiply from round to round; a file's size starts anew."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    home = spark._jvm.org.apache.hadoop.fs.Path(path)
    home.getFileSystem(spark._jsc.hadoopConfiguration()).delete(home, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazy Parquet scan (pruning/pushdown apply)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every driver table as a temp view under its own name."""
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            table(spark, sf_dir, name).createOrReplaceTempView(name)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in executor Python workers (Arrow UDFs,
    ``mapInPandas``): zip the package once and ``addPyFile`` it, the usual
    way to ship a library to a cluster.  Idempotent per SparkContext."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
