"""Session settings and the shared folder used for checkpoints and hand-over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The reports together have more stages than the default cache of compiled code.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # No Python call site per column: plans are built several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
}


def build_session(app_name: str = "tramline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later passes read only their columns, and a lost executor costs no rework.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that the driver and every executor can reach.

    The folder is ``spark.checkpoint.dir``. Where that is unset, a folder of
    the warehouse, which all share as well, is taken and set for checkpoints.
    """
    return f"{shared_base(spark)}/tramline/{label}-{uuid.uuid4().hex}"


def shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")
