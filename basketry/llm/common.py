"""Pieces that several corpus operators share."""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from basketry.operators.staging import scratch_path, write_stage as stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(keep_encoder: bool = False) -> None:
    """Give what a task has freed back to the system, as its Python worker lives on beside the next ones. The word store
    of the tokenizer goes too, unless the task belongs to an operator that uses it."""
    import ctypes
    import sys

    if not keep_encoder and "tokenizers" in sys.modules:
        sys.modules["tokenizers"].__dict__.get("_held_encoder", {}).clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def keep_bucketed(df: DataFrame, label: str, column: str) -> DataFrame:
    """Write a table to the shared folder once, bucketed, and read it back, so that rows meet by that column without
    another shuffle. Its entry in the session's catalog is dropped at once; the files stay."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("compression", "zstd").option("parquet.block.size.row.check.min", "2")
     .option("parquet.page.size.row.check.min", "1").option("path", scratch_path(spark, name))
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).saveAsTable(name))
    kept = spark.table(name)
    spark.sql(f"drop table {name}")
    return kept


def map_batches(df: DataFrame, function, schema, keep_encoder: bool = False) -> DataFrame:
    """``function(pa.RecordBatch) -> dict of columns`` over every non-empty batch."""
    empty = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    names = empty.fieldNames()

    def run(batches):
        kinds = None
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                kinds = kinds or arrow_schema(empty)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := out[n], (pa.Array, pa.ChunkedArray)) else pa.array(x, kinds.field(n).type)
                     for n in names], names=names)
        tidy(keep_encoder)

    return df.mapInArrow(run, empty)


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other columns can't clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def field(df: DataFrame, column: str, name: str = None) -> StructField:
    """The type of a column, nullable, under a new name."""
    return StructField(name or column, df.schema[column].dataType, True)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def text_key(column) -> "F.Column":
    """SHA-256 of a text, the same for null and the empty text."""
    return F.unhex(F.sha2(F.coalesce(column, F.lit("")), 256))


def spans_of(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def cover(n: int, starts, lengths) -> np.ndarray:
    """Which of n places lie in one of the runs."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, np.asarray(starts, np.int64), 1)
    np.add.at(delta, np.minimum(np.asarray(starts, np.int64) + np.asarray(lengths, np.int64), n), -1)
    return np.cumsum(delta[:n]) > 0
