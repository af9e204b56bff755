"""Intermediate tables in the cluster's shared folder, and their removal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidewatch.session import work_dir


@dataclass(frozen=True)
class Stored:
    """A written table: its rows and its folder."""

    df: DataFrame
    path: str

    def discard(self) -> None:
        """Delete the folder; only once nothing reads it any more."""
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, purpose: str) -> Stored:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: its lineage ends there."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), path)
