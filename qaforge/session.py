"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint folder, memory) come from
the session the caller hands in; ``get_spark`` only builds a local session
for tests, the bench and scripts.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(app: str = "qaforge", master: str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench (the cluster brings its own)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions",
                       str(shuffle_partitions or int(cpus))))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    This is the folder that ``spark.checkpoint.dir`` names (a shared
    filesystem), itself and not a subfolder of one session, so that stored
    indexes are found again by later sessions. Where nothing is set, a local
    session (tests, bench) takes a fresh folder under /tmp; a cluster session
    is refused, since each of its executors has a /tmp of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="qaforge-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any filesystem that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    return path_exists(spark, f"{path}/_SUCCESS")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def materialize(df, name: str = "table", path: str | None = None):
    """Write ``df`` as Parquet in the shared folder (or at ``path``) and read it back.

    Cuts the lineage (later jobs and lost executors restart from the files,
    not from the raw tables) and lets several jobs reuse one computation.
    """
    spark = df.sparkSession
    if path is None:
        path = shared_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
        _TEMPORARY.append(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


#: Tables that ``materialize`` wrote for this process alone.
_TEMPORARY: list[str] = []


def drop_temporary(spark: SparkSession | None = None) -> int:
    """Delete the tables that ``materialize`` wrote without a given path; returns how many.

    For when the results that read them are written; runs by itself as the
    Python process ends, if its session is still there."""
    spark = spark or SparkSession.getActiveSession()
    paths, _TEMPORARY[:] = list(_TEMPORARY), []
    if spark is None:
        return 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


atexit.register(drop_temporary)


def _table_name(path: str) -> str:
    return "qaforge_" + hashlib.sha1(path.encode()).hexdigest()[:20]


def write_bucketed(df, path: str, key: str, buckets: int, sort: str, partition: str):
    """Write ``df`` at ``path`` in folders by ``partition``, each dealt into ``buckets`` files by ``key``.

    Spark knows how such a table lies: grouping or joining by ``key`` needs no
    shuffle, and a filter on ``partition`` opens its folders only. ``df`` should
    be partitioned by ``key`` into as many partitions as there are buckets.
    """
    name = _table_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    (df.write.mode("overwrite").partitionBy(partition).bucketBy(buckets, key).sortBy(sort)
     .option("path", path).option("compression", "zstd").saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int, sort: str, partition: str):
    """The table that ``write_bucketed`` left at ``path``; its entry in this session's catalog is made anew if need be."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({partition}) "
                  f"CLUSTERED BY ({key}) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{path}'")
        if spark.conf.get("spark.sql.hive.manageFilesourcePartitions", "true") == "true":  # partitions are entries of the catalog
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)
