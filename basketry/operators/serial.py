"""Serial numbers and top-N, without a global window over a large result."""

from pyspark.sql import DataFrame, Window, functions as F

from basketry.operators.staging import stage


def add_serial(df: DataFrame, order, limit: int = None, name: str = "s_no") -> DataFrame:
    """Number rows 1..N in the given order.

    With a limit only that many rows reach the numbering window. Without one, rows are range
    sorted over all partitions, staged, and each partition adds the row count of those before it.
    """
    columns = df.columns
    if limit is not None:
        top = df.orderBy(*order).limit(limit)
        return top.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias(name), *columns)
    placed = stage(df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__mono")))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sorted partition, so this window is as small as the number of tasks.
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    in_part = F.col("__mono").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(offsets, "__part").select(
        (F.col("__offset") + in_part + 1).cast("bigint").alias(name), *columns)


def top_n_for_chart(report: DataFrame, value_col: str, name_col: str, n: int) -> DataFrame:
    """The n rows with the largest value; equal values in name order."""
    return report.orderBy(F.col(value_col).desc_nulls_last(), F.col(name_col)).limit(n)


def top_per_group(df: DataFrame, group, order, n: int, rank_name: str = None) -> DataFrame:
    """First n rows of each group. Spark cuts each group to n rows before the shuffle."""
    rank = rank_name or "__rank"
    group = [group] if isinstance(group, str) else list(group)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.where(F.col(rank) <= n)
    return kept if rank_name else kept.drop(rank)
