"""Reads of stored tables. Filters are ordinary predicates, so Spark pushes them into the scan."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.clean import iso_date_string, last_time_token
from basketry.schemas import SALES_COLUMNS


MAX_BROADCAST_PERIODS = 500_000
PERIOD_SALTS = 64


def read_table(spark: SparkSession, source, columns=None, condition=None) -> DataFrame:
    """Stored table (a path, or a DataFrame already read) with projection and filter."""
    df = spark.read.parquet(source) if isinstance(source, str) else source
    if condition is not None:
        df = df.where(condition)
    return df.select(*columns) if columns else df


def date_slices(date_col: str, start: dt.date, end: dt.date, slices: int) -> list[str]:
    """Predicates that cut [start, end] into disjoint date ranges, one JDBC partition each."""
    days = (end - start).days + 1
    slices = max(1, min(slices, days))
    bounds = [start + dt.timedelta(days=days * i // slices) for i in range(slices + 1)]
    return [f"{date_col} >= DATE '{lo}' AND {date_col} < DATE '{hi}'" for lo, hi in zip(bounds, bounds[1:])]


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, date_col: str,
              start: dt.date, end: dt.date, slices: int = 32) -> DataFrame:
    """JDBC scan of a date range, read by several tasks; further filters are pushed down by Spark."""
    return spark.read.jdbc(url, table, predicates=date_slices(date_col, start, end, slices), properties=properties)


def store_period_lines(lines: DataFrame, periods: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Lines of every store inside that store's own period.

    ``periods`` has one row per store and should be staged, since it is used three times. Its earliest
    start is a scalar subquery, so a table partitioned by orderDate skips the history no store needs.
    Up to MAX_BROADCAST_PERIODS stores, which is checked, the period table is broadcast and the lines are
    not shuffled. Beyond that, lines are salted, so that a store with very many lines is still spread.
    """
    lowest = periods.agg(F.min(start_col)).scalar()
    inside = lines.where(F.col("orderDate") >= lowest)
    if periods.limit(MAX_BROADCAST_PERIODS + 1).count() <= MAX_BROADCAST_PERIODS:
        joined = inside.join(F.broadcast(periods), "storeName")
    else:
        salt = F.pmod(F.xxhash64(*lines.columns), F.lit(PERIOD_SALTS)).cast("int")
        salted = periods.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(PERIOD_SALTS - 1))))
        joined = inside.withColumn("__salt", salt).join(salted, ["storeName", "__salt"]).drop("__salt")
    return joined.where(F.col("orderDate").between(F.col(start_col), F.col(end_col)))


def migrate_date_range(source: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The 41 sales columns of a date range, with time and orderDate repaired."""
    df = source.where(F.col("orderDate").between(F.lit(start), F.lit(end)))
    fixes = {
        "time": last_time_token(F.col("time").cast("string")) if "time" in df.columns else F.lit(None).cast("string"),
        "orderDate": iso_date_string(F.col("orderDate").cast("string")),
    }
    return df.select(*[
        (fixes[c] if c in fixes else F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
        for c in SALES_COLUMNS])


def union_order_types(downloads) -> DataFrame:
    """Downloads of several order types as one DataFrame; those without columns are left out."""
    downloads = [d for d in downloads if d is not None and d.columns]
    if not downloads:
        raise ValueError("no order type has any data")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), downloads)


def unique_stores(lines: DataFrame) -> DataFrame:
    return lines.select("storeName").dropna().distinct().orderBy("storeName")


def unique_products(lines: DataFrame) -> DataFrame:
    named = lines.select("productName").where("productName is not null and productName <> ''")
    return named.distinct().orderBy("productName")


def last_date(df: DataFrame, date_col: str = "orderDate") -> DataFrame:
    """Latest date as a one-row DataFrame; use ``.scalar()`` on it inside a filter."""
    return df.agg(F.max(date_col).alias("last_date"))


def top_lines_on_last_date(lines: DataFrame, n: int = 50, last: DataFrame = None) -> DataFrame:
    """The n dearest lines of the latest day, numbered."""
    from basketry.operators.serial import add_serial

    last = last if last is not None else last_date(lines)
    top = (
        lines.where((F.col("orderDate") == last.scalar()) & F.col("productName").isNotNull())
        .select("productName", "totalProductPrice", "quantity")
    )
    order = [F.col("totalProductPrice").desc_nulls_last(), F.col("productName"), F.col("quantity")]
    return add_serial(top, order, limit=n)
