"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot keys on the probe side of a sort-merge join are split at run time, also
    # when the next aggregation would have reused the join's partitioning
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# recording the Python call site of every expression doubles the time to build a plan
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings every job here relies on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "patronage", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in (START_SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="patronage-"))
    return context.getCheckpointDir().rstrip("/")


def ship(module: str) -> None:
    """Send the functions of a module to the executors by value, so workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a stored table, so later stages neither repeat the work
    above nor depend on executors that may be gone.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute rows whose source has fewer splits than there are cores, before work that is heavy per row.

    A table of many files is left as it is. For tables as read only: behind a shuffle, counting the partitions would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
