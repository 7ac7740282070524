"""Where iterative operators cut their lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use_checkpoints(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return its folder.

    The folder is the one the session names in spark.checkpoint.dir, which every executor can
    reach. A session that names none gets one beside its tables, in the warehouse, if its
    executors reach that as well; it is removed when the application ends.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints/{context.applicationId}"
        path = spark._jvm.org.apache.hadoop.fs.Path(named)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.getScheme() == "file" and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share; the warehouse is on one machine")
        system.mkdirs(path)
        system.deleteOnExit(path)
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def stored(df: DataFrame) -> tuple[DataFrame, int]:
    """The table computed once and for all, with the number of its rows."""
    use_checkpoints(df.sparkSession)
    kept = df.checkpoint()
    return kept, kept.count()
