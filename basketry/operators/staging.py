"""Staged intermediate results that survive the loss of executors."""

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only for a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-"))
    return context.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Materialise a DataFrame with a reliable checkpoint and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        root = staging_root(df.sparkSession)
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder for a table that this session writes and reads back."""
    return f"{staging_root(spark).rstrip('/')}/basketry-{label}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder, compressed, and read it back, which cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch_path`` that nothing reads any more."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """While it lasts, the shuffle files of each query or write go at its end, not when the driver happens to collect
    its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
