"""The daily report over the stored aggregate tables."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators import aggregates, comparisons
from basketry.operators.validate import SalesDataError
from basketry.sinks.tables import partition_dates, read_dates

TABLES = ("store_sales", "category_sales", "brand_sales", "product_sales")
DAYS = 7


def daily_dashboard(spark: SparkSession, root: str, end: dt.date = None, store_days: int = 8) -> dict[str, DataFrame]:
    """Total with growth, and the store, category, brand and product reports of the last day, or of ``end``.

    Stores and products are compared with the eight days before, brands and categories with seven. The last day comes
    from the folder names, and only the folders of the days that are compared are opened.
    """
    root = root.rstrip("/")
    known = {n: partition_dates(spark, f"{root}/{n}", "orderdate") for n in TABLES}
    stored = [day for day in known["store_sales"] if end is None or day <= end]
    if not stored:
        raise SalesDataError(f"no stored day{'' if end is None else f' until {end}'} under {root}")
    last = stored[-1]
    end = end or last

    def window(name: str, until: dt.date, days: int) -> DataFrame:
        wanted = [d for d in known[name] if until - dt.timedelta(days=days) <= d <= until]
        # A table without these days is read for its columns from its latest day.
        rows = read_dates(spark, f"{root}/{name}", "orderdate", wanted or known[name][-1:])
        return rows if wanted else rows.where("false")

    last_day = spark.range(1).select(F.lit(last).alias("last_date"))
    day = F.lit(end)
    return {
        "last_date": last_day,
        "total": aggregates.total_sales_growth(window("store_sales", last, DAYS), last_day),
        "stores": comparisons.store_daily(window("store_sales", end, store_days), day, store_days),
        "categories": comparisons.category_daily(window("category_sales", end, DAYS), day),
        "brands": comparisons.brand_daily(window("brand_sales", end, DAYS), day),
        "products": comparisons.product_daily(window("product_sales", end, store_days), day, store_days),
    }
