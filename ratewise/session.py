"""Session set-up and the reliable lineage cut used by iterative work."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "ratewise", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir`` of the session.

    A private temporary folder is taken only in local mode, where driver and
    executors are the same machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    created = tempfile.mkdtemp(prefix="ratewise-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; the file system removes it when the application ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/ratewise-{uuid.uuid4().hex}"
    _remove_at_end(spark, folder)
    return f"{folder}/{name}"


def removed(spark: SparkSession, path: str) -> None:
    """Remove what was written to a ``scratch_path``, now."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str = "rows") -> tuple[DataFrame, str]:
    """``df`` written once, compressed, to the shared folder, and the path for ``removed``."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the files of an action's shuffles go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    """Have the file system remove a folder of this application when it ends."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and cut its lineage there.

    Spark makes a folder of the application's own for it, which goes when the application ends.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    _remove_at_end(spark, spark.sparkContext.getCheckpointDir())
    return df.checkpoint(eager=True)
