"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here is written for. They can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A small shuffle often feeds an explode that multiplies its rows (days, currencies), so
    # partitions far below the default 1 MB still deserve a task of their own.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # The JIT leaves methods above 8000 bytes of bytecode interpreted; beyond that, generated
    # code split by operator is faster than one fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "ledgerloom", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() or 8))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def spread(df: DataFrame) -> DataFrame:
    """Give an input of fewer splits than cores a partition per core; else leave it alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path inside the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: elsewhere the executors
    would not see it, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix=f"run-{label}-")
    return f"{base.rstrip('/')}/ledgerloom/{label}-{uuid.uuid4().hex}"
