"""Daily aggregates of the sales fact. Null names keep their own group.

Sums combine on the map side. A distinct count first groups by name, day and invoice, so a name
that holds a large part of all lines is still spread over all tasks.
"""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from basketry.functions.clean import ratio, rounded


def _named(lines: DataFrame, source: str, target: str) -> DataFrame:
    return lines.groupBy(F.col(source).alias(target), F.col("orderDate").alias("orderdate"))


def _with_orders(lines: DataFrame, source: str, target: str, orders: str) -> DataFrame:
    return (
        _named(lines, source, target)
        .agg(F.count_distinct("invoice").alias(orders), F.sum("totalProductPrice").alias("sales"))
        .select(target, orders, "sales", ratio("sales", orders).alias("aov"), "orderdate"))


def brand_sales(lines: DataFrame) -> DataFrame:
    return _with_orders(lines, "brandName", "brandname", "nooforders")


def store_sales(lines: DataFrame) -> DataFrame:
    return _with_orders(lines, "storeName", "storename", "nooforder")


def category_sales(lines: DataFrame) -> DataFrame:
    return (
        _named(lines, "subCategoryOf", "subcategoryof").agg(F.sum("totalProductPrice").alias("sales"))
        .select("subcategoryof", "sales", "orderdate"))


def product_sales(lines: DataFrame) -> DataFrame:
    return (
        _named(lines, "productName", "productname")
        .agg(F.count_distinct("invoice").alias("nooforders"), F.sum("totalProductPrice").alias("sales"),
             F.sum("quantity").alias("quantitysold"))
        .select("productname", "nooforders", "sales", "quantitysold", "orderdate"))


def total_sales_growth(sales: DataFrame, last: DataFrame = None, days: int = 7) -> DataFrame:
    """Chain total of the last day against the mean daily total of the days before it."""
    from basketry.sources.tables import last_date

    last = (last if last is not None else last_date(sales, "orderdate")).scalar()
    daily = (
        sales.where((F.col("orderdate") >= F.date_sub(last, days)) & (F.col("orderdate") <= last))
        .groupBy("orderdate").agg(F.sum("sales").cast("double").alias("total"))
        .withColumn("is_last", F.col("orderdate") == last))
    totals = daily.agg(
        F.coalesce(F.max(F.when(F.col("is_last"), F.col("total"))), F.lit(0.0)).alias("sales_today"),
        F.coalesce(F.avg(F.when(~F.col("is_last"), F.col("total"))), F.lit(0.0)).alias("avg_previous_days"))
    growth = (F.col("sales_today") - F.col("avg_previous_days")) / F.col("avg_previous_days") * 100
    return totals.select(
        "sales_today",
        F.when(F.col("avg_previous_days") > 0, rounded(growth)).otherwise(F.lit(0.0)).alias("growth_pct"))


def dates_in_load(df: DataFrame, date_col: str = "orderDate") -> DataFrame:
    return df.select(date_col).dropna().distinct()


def daily_window(end: dt.date, days: int = 7) -> tuple[dt.date, dt.date]:
    """First and last comparison day for a report of ``end``."""
    return end - dt.timedelta(days=days), end - dt.timedelta(days=1)
