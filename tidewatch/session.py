"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidewatch", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **{k: str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Every executor must be able to read what another wrote, so without that
    setting a machine-local folder is used only where driver and executors are
    one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = os.path.join(tempfile.gettempdir(), "tidewatch-work")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    For results that several later steps read: the lineage is cut, and a lost
    executor costs a re-read of files, not a recomputation.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` of a scan, dealt out where the scan alone has fewer tasks than there are cores.

    One small file is one task, however much work each row asks for. A table of many files is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def dealt_by(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt out by ``keys`` in as many parts as a shuffle has.

    For texts that are about to be cut into words: what is then grouped by key and word needs
    no further shuffle, and the texts are smaller than their words with places and counts. And for
    few rows with much work each, which would else be put into one task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
