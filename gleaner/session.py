"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed anti or outer join is split even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "gleaner", **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``).

    A local temporary folder is used only where the setting is absent and all
    tasks run on this machine, as in tests; elsewhere the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return tempfile.mkdtemp(prefix=f"gleaner-{label}-")
    return f"{base.rstrip('/')}/gleaner-{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a scan that has fewer partitions than there are cores.

    A few large files leave cores idle during costly per-row work. Tables with
    more splits than cores, as any large one has, are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialised(df: DataFrame, label: str = "rows") -> DataFrame:
    """The rows written once to the shared folder and read back.

    For results that several later steps read. A written table is computed once
    and survives the loss of an executor, which cached blocks do not.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label) + "/rows"
    # Texts take a quarter less than by the default codec, for little more time.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
