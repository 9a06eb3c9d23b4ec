"""Chain-level reports: the last day against the days before, and a month against two months."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.clean import ratio, rounded
from basketry.functions.labels import (
    NOT_AVAILABLE_LABEL, ZERO_LABEL, sales_label, trend_arrow, trend_direction, trend_pct)
from basketry.functions.periods import in_months, shift_month
from basketry.operators.serial import add_serial
from basketry.sources.tables import last_date


def _day_against_previous(sales: DataFrame, name: str, measures: dict[str, str], end, days: int) -> DataFrame:
    """Rows of the last day beside the mean of the previous days; 0 where one side is missing.

    One pass over days+1 days of an aggregate table: the means are window values over the few rows
    of a name. A null name never matches itself, as in a join, hence its second partition key.
    """
    end = last_date(sales, "orderdate").scalar() if end is None else end
    window = sales.where((F.col("orderdate") >= F.date_sub(end, days)) & (F.col("orderdate") <= end))
    window = window.withColumn("__today", F.col("orderdate") == end)
    window = window.withColumn("__null_today", F.col(name).isNull() & F.col("__today"))
    by_name = Window.partitionBy(name, "__null_today")
    before = lambda c: F.when(~F.col("__today"), F.col(c))
    sums = {f"__sum_{t}": F.sum(before(s)).over(by_name) for s, t in measures.items()}
    counts = {f"__count_{t}": F.count(before(s)).over(by_name) for s, t in measures.items()}
    rows = window.withColumns({
        **sums, **counts, "__has_today": F.max("__today").over(by_name),
        "__first": F.row_number().over(by_name.orderBy("orderdate")) == 1})
    rows = rows.where(F.col("__today") | (~F.col("__has_today") & F.col("__first")))
    zero = F.lit(0.0)
    return rows.select(
        name,
        *[F.when(F.col("__today"), F.coalesce(F.col(s).cast("double"), zero)).otherwise(zero).alias(f"{t}_today")
          for s, t in measures.items()],
        *[F.coalesce(ratio(f"__sum_{t}", f"__count_{t}"), zero).alias(f"avg_{t}_previous_days") for t in measures.values()],
    ).distinct()


def _with_trends(report: DataFrame, measures) -> DataFrame:
    for m in measures:
        today, average = f"{m}_today", f"avg_{m}_previous_days"
        report = report.withColumns({
            f"{m}_trend": trend_direction(today, average), f"{m}_trend_pct": trend_pct(today, average)})
    return report


def _numbered(report: DataFrame, name: str, value: str, limit) -> DataFrame:
    rest = [F.col(c) for c in report.columns if c not in (name, value)]
    return add_serial(report, [F.col(value).desc_nulls_last(), F.col(name).asc_nulls_last(), *rest], limit=limit)


def brand_daily(sales: DataFrame, end=None, days: int = 7, top: int = 50) -> DataFrame:
    report = _day_against_previous(
        sales, "brandname", {"nooforders": "orders", "sales": "sales", "aov": "aov"}, end, days)
    return _numbered(_with_trends(report, ["orders", "sales", "aov"]), "brandname", "sales_today", top)


def store_daily(sales: DataFrame, end=None, days: int = 7) -> DataFrame:
    report = _day_against_previous(
        sales, "storename", {"nooforder": "orders", "sales": "sales", "aov": "aov"}, end, days)
    return _numbered(_with_trends(report, ["orders", "sales", "aov"]), "storename", "sales_today", None)


def category_daily(sales: DataFrame, end=None, days: int = 7) -> DataFrame:
    """Categories are summed per day first, since the last day's rows are summed in this report."""
    end = last_date(sales, "orderdate").scalar() if end is None else end
    today = F.col("orderdate") == end
    inside = sales.where((F.col("orderdate") >= F.date_sub(end, days)) & (F.col("orderdate") <= end))
    grouped = inside.groupBy("subcategoryof", (F.col("subcategoryof").isNull() & today).alias("__null_today")).agg(
        F.sum(F.when(today, F.col("sales"))).alias("today"),
        F.sum(F.when(~today, F.col("sales"))).alias("total"),
        F.count(F.when(~today, F.col("sales"))).alias("days"))
    report = grouped.select(
        "subcategoryof", F.coalesce(F.col("today").cast("double"), F.lit(0.0)).alias("sales_today"),
        F.coalesce(ratio("total", "days"), F.lit(0.0)).alias("avg_sales_previous_days")).distinct()
    return _numbered(_with_trends(report, ["sales"]), "subcategoryof", "sales_today", None)


def product_daily(sales: DataFrame, end=None, days: int = 7, top: int = 100) -> DataFrame:
    report = _day_against_previous(
        sales, "productname", {"sales": "sales", "quantitysold": "quantity"}, end, days)
    return _numbered(_with_trends(report, ["sales", "quantity"]), "productname", "sales_today", top)


def daily_display(report: DataFrame, name: str, measures, decimals: dict[str, int] = None) -> DataFrame:
    """Report as shown: each measure with its arrow, for example '12,345.00 🡅 (3.1%)'."""
    decimals = decimals or {}
    return report.select("s_no", name, *[
        sales_label(f"{m}_today", trend_arrow(f"{m}_today", f"avg_{m}_previous_days"), decimals.get(m, 2)).alias(m)
        for m in measures])


def month_totals(lines: DataFrame, month) -> DataFrame:
    return lines.where(in_months("orderDate", month)).agg(
        F.count_distinct("invoice").alias("unique_invoices"), F.sum("totalProductPrice").alias("total_sales"))


def _month_against_two(sales: DataFrame, name: str, date_col: str, value: str, month, quantity: str = None,
                       keep_previous_only: bool = False) -> DataFrame:
    """Month total and half the total of the two months before, from one grouped pass.

    A null name of the month is never joined with the null names before, hence its second group key.
    """
    current = in_months(date_col, month)
    inside = sales.where(in_months(date_col, shift_month(month, -2), month))
    aggregates = [
        F.sum(F.when(current, F.col(value))).cast("double").alias("total_sales"),
        (F.sum(F.when(~current, F.col(value))).cast("double") / 2).alias("avg_monthly_sales"),
        F.count_if(current).alias("__rows")]
    if quantity:
        aggregates.append(F.sum(F.when(current, F.col(quantity))).alias("total_quantity"))
        aggregates.append(F.sum(F.when(~current, F.col(quantity))).alias("previous_quantity"))
    grouped = inside.groupBy(name, (F.col(name).isNull() & current).alias("__null_now")).agg(*aggregates).drop("__null_now")
    if not keep_previous_only:
        grouped = grouped.where("__rows > 0")
    return grouped.drop("__rows").na.fill(0)


def _monthly(report: DataFrame, name: str, top) -> DataFrame:
    report = report.withColumns({
        "trend": trend_direction("total_sales", "avg_monthly_sales"),
        "trend_pct": trend_pct("total_sales", "avg_monthly_sales")})
    return _numbered(report, name, "total_sales", top)


def store_monthly(lines: DataFrame, month) -> DataFrame:
    return _monthly(_month_against_two(lines, "storeName", "orderDate", "totalProductPrice", month), "storeName", None)


def brand_monthly(sales: DataFrame, month, top: int = 100) -> DataFrame:
    return _monthly(_month_against_two(sales, "brandname", "orderdate", "sales", month), "brandname", top)


def category_monthly(sales: DataFrame, month) -> DataFrame:
    """Also lists categories that only the two months before have."""
    report = _month_against_two(sales, "subcategoryof", "orderdate", "sales", month, keep_previous_only=True)
    return _monthly(report, "subcategoryof", None)


def product_monthly(sales: DataFrame, month, top: int = 100) -> DataFrame:
    """The previous quantity is the total of both months and is not halved."""
    report = _month_against_two(sales, "productname", "orderdate", "sales", month, quantity="quantitysold")
    return _monthly(report, "productname", top)


def monthly_display(report: DataFrame, name: str, zero_label: str = NOT_AVAILABLE_LABEL) -> DataFrame:
    """Report as shown; brands and categories say (N/A) without a base, stores and products (0%)."""
    arrow = trend_arrow("total_sales", "avg_monthly_sales", zero_label)
    return report.select("s_no", name, sales_label("total_sales", arrow).alias("sales_and_trend"))
