"""Joins whose cost grows with the square of a key's rows, cut into blocks of bounded size."""

from pyspark.sql import DataFrame, functions as F

from basketry.operators.staging import stage

ROWS_PER_BLOCK = 2000


def block_sizes(left: DataFrame, right: DataFrame, on, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Keys that need several blocks on a side, as (on, __rows_i, __rows_j); None when there are none.

    Only keys with more than rows_per_block rows are listed, so the table has at most
    1/rows_per_block of the rows of the two sides.
    """
    on = [on] if isinstance(on, str) else list(on)
    one = F.lit(1)
    tagged = left.select(*on, F.lit(True).alias("__left")).unionAll(right.select(*on, F.lit(False).alias("__left")))
    blocks = lambda side: F.greatest(F.ceil(F.count_if(side) / rows_per_block).cast("int"), one)
    counted = tagged.groupBy(*on).agg(
        blocks(F.col("__left")).alias("__rows_i"), blocks(~F.col("__left")).alias("__rows_j"))
    hot = stage(counted.where("__rows_i > 1 or __rows_j > 1"))
    return None if hot.isEmpty() else hot


def grid_keys(left: DataFrame, right: DataFrame, on, left_id: str, right_id: str,
              sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with block numbers (__i, __j): every pair of rows of a key meets in exactly one block.

    A key with many rows gets many blocks on each side, and each row is repeated once per block of the
    other side, so no task ever joins more than a block with a block. ``sizes`` may stem from a superset
    of the rows.
    """
    on = [on] if isinstance(on, str) else list(on)
    if sizes is None:
        zero = {"__i": F.lit(0), "__j": F.lit(0)}
        return left.withColumns(zero), right.withColumns(zero)
    count = lambda c: F.coalesce(F.col(c), F.lit(1))
    own = lambda c, n: F.pmod(F.xxhash64(c), count(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), count(n) - 1))
    l = left.join(sizes, on, "left").select(
        *left.columns, own(left_id, "__rows_i").alias("__i"), every("__rows_j").alias("__j"))
    r = right.join(sizes, on, "left").select(
        *right.columns, own(right_id, "__rows_j").alias("__j"), every("__rows_i").alias("__i"))
    return l, r


def grid_join(left: DataFrame, right: DataFrame, on, left_id: str, right_id: str, condition, sizes: DataFrame) -> DataFrame:
    """Inner join on equal keys and a condition, spread over blocks. Column names must differ but for ``on``."""
    on = [on] if isinstance(on, str) else list(on)
    l, r = grid_keys(left, right, on, left_id, right_id, sizes)
    return l.join(r, [*on, "__i", "__j"]).where(condition).drop("__i", "__j")
