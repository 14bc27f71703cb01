"""Session settings, the shared folder, durable intermediate tables, and shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "granary", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator assumes: UTC, ANSI and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    The driver may have found it through a path of its own that executors do not have.
    """
    context = spark.sparkContext
    if getattr(context, "_granary_shipped", False):
        return spark
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="granary-"), "granary_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as package:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(archive)
    context._granary_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can read: the cluster's checkpoint folder.

    Only a session whose executors are threads of the driver (master ``local``) gets a
    temporary folder where that is unset; any other master without one is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    return _local_folder(spark, spark.sparkContext.master)


def _local_folder(spark: SparkSession, master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="granary-"))
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, label: str = "table") -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


#: What a query shuffled goes when it ends; else it stays until the driver happens to collect its garbage.
_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches of a plan must see the very same rows (cut points of a
    sketch, iterative state): the table outlives lost executors and is computed once.
    What the writing shuffled is dropped with its end.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    before = spark.conf.get(_DROPPED, None)
    spark.conf.set(_DROPPED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_DROPPED) if before is None else spark.conf.set(_DROPPED, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._granary_path = path
    return table


def is_durable(df: DataFrame) -> bool:
    """Whether ``df`` is what :func:`durable` gave, so that reading it twice costs no work and gives the same rows."""
    return getattr(df, "_granary_path", None) is not None


def discard(*tables: DataFrame) -> None:
    """Remove tables of :func:`durable` that nothing will read again; others stay as they are."""
    for table in tables:
        if is_durable(table):
            spark = table.sparkSession
            jpath = spark._jvm.org.apache.hadoop.fs.Path(table._granary_path)
            jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
