"""Session building and the shared-folder helpers every operator uses."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings an engine session starts with; a cluster's own settings win because they are only defaults.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, shuffle_partitions: int | None = None, app: str = "graphloom", **conf: str) -> SparkSession:
    """A session with the engine's defaults. ``master`` None leaves the choice to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir`` of the session. Only a local master may fall back to a
    temporary folder; on a cluster an unset folder is an error, because a machine-local one would not survive a lost executor."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = os.path.join(tempfile.gettempdir(), f"graphloom-{os.getuid()}", sc.applicationId)
        spark.conf.set("spark.checkpoint.dir", where)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: later branches read compressed columns instead of computing
    it again, and a lost executor loses nothing. Tables are removed by ``release`` or ``scratch``, and at last when the driver's Python
    ends."""
    spark = df.sparkSession
    where = f"{checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(where)
    if not _TABLES:
        atexit.register(release, spark)
    _TABLES.append(where)
    return spark.read.schema(df.schema).parquet(where)


_TABLES: list[str] = []


def release(spark: SparkSession, since: int = 0) -> int:
    """Removes the tables that were cut (from the number ``since`` on); results that still read them are lost. The number removed."""
    gone = _TABLES[since:]
    del _TABLES[since:]
    for where in gone:
        _remove(spark, where)
    return len(gone)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """A stretch of work of which only written results stay: tables that were cut in it are removed at its end."""
    since = len(_TABLES)
    try:
        yield
    finally:
        release(spark, since)


def _remove(spark: SparkSession, where: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session may be gone, and then the folder's owner cleans up
        pass
