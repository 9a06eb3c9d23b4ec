"""Renames of products and stores in the stored fact and aggregate tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators.staging import shuffles_dropped, stage
from basketry.operators.transform import rename_lookup
from basketry.plans.daily_load import refresh_aggregates
from basketry.sinks.tables import overwrite_dates, partition_dates, read_dates

MAX_BROADCAST_NAMES = 200_000


def rename_stored(spark: SparkSession, root: str, rules, column: str = "productName", excluded_store: str = None) -> DataFrame:
    """Rename values of ``column`` in billing_data and write the aggregates of the changed days anew.

    ``rules`` is a list of (old, new) or a table (seq, old, new); chains are resolved on the rules. One pass over two
    columns of the fact finds the days that hold an old name; only their folders are read and rewritten, all other
    files stay. Up to MAX_BROADCAST_NAMES changed names, which is checked, the facts are not shuffled: rows that lie by day are
    written by day. Returns (orderDate, renamed_rows) of the changed days. The same renames again change nothing. After
    a run that stopped between the fact table and the aggregates, ``refresh_days`` completes it.
    """
    with shuffles_dropped(spark):
        return _rename(spark, root.rstrip("/"), rules, column, excluded_store)


def _rename(spark: SparkSession, root: str, rules, column: str, excluded_store: str) -> DataFrame:
    path = f"{root}/billing_data"
    lookup = stage(rename_lookup(spark, rules).select(F.col("old").alias(column), F.col("new").alias("__new")))
    if lookup.limit(MAX_BROADCAST_NAMES + 1).count() <= MAX_BROADCAST_NAMES:
        lookup = F.broadcast(lookup)
    facts = spark.read.parquet(path).select("orderDate", column)
    changed = stage(facts.join(lookup, column, "left_semi").groupBy("orderDate").agg(F.count("*").alias("renamed_rows")))
    touched = {r["orderDate"] for r in changed.select("orderDate").collect()}  # one row a day
    if touched:
        rows = read_dates(spark, path, "orderDate", sorted(touched))
        renamed = rows.join(lookup, column, "left").withColumn(column, F.coalesce("__new", column)).select(*rows.columns)
        overwrite_dates(renamed, path, rebalance=False)
        refresh_days(spark, root, sorted(touched), excluded_store)
    return changed


def refresh_days(spark: SparkSession, root: str, days=None, excluded_store: str = None) -> None:
    """Write the aggregates of some stored days, or of all, anew from the fact table."""
    days = partition_dates(spark, f"{root}/billing_data", "orderDate") if days is None else list(days)
    rows = read_dates(spark, f"{root}/billing_data", "orderDate", days)
    refresh_aggregates(spark, rows, root, spark.createDataFrame([(d,) for d in days], "orderDate date"), excluded_store)
