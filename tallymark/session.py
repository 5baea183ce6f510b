"""Session defaults and the shared folder that durable intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "tallymark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package is written for; keyword settings win.

    The number of shuffle partitions is left to the cluster: adaptive execution
    merges small ones, and a local run passes its own number.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**defaults, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and written tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    one machine is the whole cluster, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if configured:
        folder = configured
    elif context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tallymark-")
    else:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


# Paths given out by this driver process.
_given: list[str] = []


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    path = f"{shared_folder(spark)}/tallymark/{name}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def discard_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables that this driver process has written to the shared folder; how many.

    Results are lazy and read such tables, so call it once they have been written or collected,
    at the latest before the application ends.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    gone = 0
    while _given:
        path = hadoop.Path(_given.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def frozen(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and safe from lost executors."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
