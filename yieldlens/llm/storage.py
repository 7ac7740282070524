"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from yieldlens.plans.checkpoints import use_checkpoints


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column, in any case, is called that."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Workspace:
    """A folder of its own under spark.checkpoint.dir; removed when the Spark application ends.

    Tables in it cut lineage: a lost executor costs the tasks it was running, not the work before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{use_checkpoints(spark)}/{name}-{uuid.uuid4().hex}"
        path, system = self._place("")
        system.mkdirs(path)
        system.deleteOnExit(path)

    def _place(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write the table once and return it as read from there."""
        target = f"{self.path}/{name}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing still to be computed reads."""
        for name in names:
            path, system = self._place(name)
            system.delete(path, True)
