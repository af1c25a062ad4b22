"""Session defaults and the shared workspace that jobs may write to."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_base: str | None = None


def build_session(app: str = "millrace", cores: str | int = "*", **conf: str) -> SparkSession:
    """Session for local runs; on a cluster the submitter's own settings apply."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # The JVM never compiles methods past 8000 bytes; wide cast projections
        # run faster as several smaller methods.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Tables staged here outlive the executors that wrote them.  A machine-local
    folder is chosen only for a local master with the setting absent.
    """
    global _local_base
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="millrace-")
        base = _local_base
    return f"{base.rstrip('/')}/millrace/{label}-{uuid4().hex[:12]}"


def stage(df, label: str = "stage"):
    """Write ``df`` once to the workspace and read it back.

    Used where several branches of one plan would otherwise each repeat an
    expensive parse; parquet keeps pruning and pushdown for the branches.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
