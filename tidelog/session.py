"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # dates are cut from instants, so every engine must cut at the same midnight
    "spark.sql.session.timeZone": "UTC",
    # a value that does not fit its type stops the job instead of turning into NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # 64-bit times take less room than the default of 96 bits, which no codec makes up for
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # a task that writes to a few folders keeps their files open; else it would sort all its rows by folder
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session that names none (tests, a laptop) uses a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidelog-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that `scratch_dir` named, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
