"""Return-to-vendor signals per store."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from basketry.functions.clean import rounded
from basketry.functions.names import strip_space
from basketry.operators.serial import top_per_group
from basketry.operators.transform import zero_fill_numeric
from basketry.schemas import RTV_NUMERIC_COLUMNS


def rtv_for_day(rtv: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return rtv.where(F.col("Date").between(F.lit(start), F.lit(end)))


def _qty():
    return F.sum("quantity").cast("bigint")


def rtv_summary(rtv: DataFrame) -> DataFrame:
    return rtv.groupBy("storeName").agg(
        F.count("*").alias("total_returns"), _qty().alias("total_qty"),
        F.sum("totalAmount").cast("double").alias("total_value"))


def rtv_top_vendors(rtv: DataFrame, n: int = 2) -> DataFrame:
    vendors = rtv.where("vendorName is not null").groupBy("storeName", "vendorName").agg(
        F.count("productName").alias("lines"), _qty().alias("qty"), F.sum("totalAmount").alias("value"))
    top = top_per_group(vendors, "storeName", [F.col("value").desc_nulls_last(), F.col("vendorName")], n, "position")
    return top.withColumn("value", F.col("value").cast("double"))


def rtv_top_products(rtv: DataFrame, n: int = 3) -> DataFrame:
    rows = rtv.select(
        "storeName", "productName", "quantity", "price", "totalAmount",
        F.coalesce("vendorName", F.lit("unknown")).alias("vendorName"))
    order = [F.col("totalAmount").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ("productName", "vendorName", "quantity", "price")]
    top = top_per_group(rows, "storeName", order, n, "position")
    return top.withColumns({"totalAmount": F.col("totalAmount").cast("double"), "quantity": F.col("quantity").cast("bigint")})


def rtv_top_reason(rtv: DataFrame) -> DataFrame:
    """Most common reason per store; counts first, then one small comparison per store."""
    reasons = rtv.select("storeName", strip_space("description").alias("reason")).where("reason <> ''")
    counted = reasons.groupBy("storeName", "reason").agg(F.count("*").alias("occurrences"))
    return top_per_group(counted, "storeName", [F.col("occurrences").desc(), F.col("reason")], 1)


def rtv_numbers(rtv: DataFrame) -> DataFrame:
    """Returns read from text with quantity, price and amount as numbers."""
    return zero_fill_numeric(rtv, RTV_NUMERIC_COLUMNS)
