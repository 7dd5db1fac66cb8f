"""Session settings and the durable work folder used by stateful jobs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on. All of them are ordinary Spark SQL settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

BROADCAST, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: How far an estimate from file sizes may fall short of the rows in memory.
SHORT_BY = 64


def build_session(app: str = "tradewharf", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Inside, tables are broadcast by the size they turn out to have.

    Spark estimates a table from its compressed files and does not know how long derived text is,
    so a dimension of a few MB of files may be hundreds of MB on the driver, once per join. The
    session's limit on estimates is cut by ``SHORT_BY``; adaptive execution applies the limit as it
    was to the bytes a shuffle has measured. Both are put back at the end. Other threads of the
    session plan their joins the same way meanwhile.
    """
    before = {k: spark.conf.get(k, None) for k in (BROADCAST, MEASURED)}
    limit = spark.conf.get(BROADCAST)
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    try:
        if least > 0:
            spark.conf.set(BROADCAST, str(least // SHORT_BY))
            spark.conf.set(MEASURED, before[MEASURED] or limit)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def work_root(spark: SparkSession) -> str:
    """Shared folder for state and lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset it lies below the
    warehouse. A warehouse on a machine's own disk will do for a session of one machine only;
    elsewhere every executor would write to its own, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    named = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", root)
    if named:
        scheme = named[1].lower()
    else:  # the default file system's
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme == "file" and not one_machine(spark.sparkContext.master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: {root} is local to each machine")
    return f"{root}/_work"


def one_machine(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def run_folder(spark: SparkSession) -> str:
    """The folder of this application below the work folder; it goes when the session ends."""
    path = f"{work_root(spark)}/tradewharf/{spark.sparkContext.applicationId}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
    return path


def work_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the run folder."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: a lineage cut that survives executor loss."""
    spark = df.sparkSession
    target = path or work_path(spark, label)
    df.write.mode("errorifexists").parquet(target)
    return spark.read.schema(df.schema).parquet(target)
