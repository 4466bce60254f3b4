"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests, bench and the command line."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corvane")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: a zip goes to the executors, or with a local master to workers that don't find the folder."""
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    found = context.master.startswith("local") and (root in known or os.getcwd() == root)
    if found or getattr(context, "_corvane_shipped", False):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "corvane"), "zip", root, "corvane")
    context.addPyFile(archive)
    context._corvane_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send rows of whole texts to Python in batches of at most `rows`, so that a batch is a few MB; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; with a local master, and only there, a local folder where none is set."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    context.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "corvane-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
