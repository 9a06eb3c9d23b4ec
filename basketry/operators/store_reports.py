"""Weekly and monthly reports of all stores in one job.

Every report starts from the lines of each store's own period and groups by store and name, so no
loop over stores is needed. Top-N per store is cut on the map side before the rank is final, and the
store total is a second, small aggregation of the grouped rows instead of a window over them.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.clean import ratio, rounded
from basketry.functions.labels import pct_change
from basketry.functions.periods import first_of_month, month_bucket, week_bucket
from basketry.operators.serial import top_per_group
from basketry.sources.tables import store_period_lines

# Report sizes and short column labels.
TOP_BRANDS, TOP_CATEGORIES, TOP_PRODUCTS = 50, 50, 100
COLUMN_LABELS = {
    "brandName": "Brand",
    "categoryName": "Category",
    "productName": "Product",
    "total_sales": "Sales (₹)",
    "quantity_sold": "Qty Sold",
    "current_stock": "Stock",
    "contrib_percent": "Contrib%",
    "profit_margin": "Margin%",
}
NO_BASE = "Insufficient data for comparison"
NO_SALES = "No sales data available"
# End of fixed values.

DIMENSIONS = {"brandName": TOP_BRANDS, "categoryName": TOP_CATEGORIES, "productName": TOP_PRODUCTS}


def store_weeks(lines: DataFrame, weeks_back: int = 0) -> DataFrame:
    """Week of each store that ends on its latest day, or a number of weeks before it."""
    ends = lines.where("storeName is not null").groupBy("storeName").agg(F.max("orderDate").alias("max_date"))
    end = F.date_sub("max_date", 7 * weeks_back)
    return ends.where("max_date is not null").select(
        "storeName", F.date_sub(end, 6).alias("week_start"), end.alias("week_end"))


def store_report_months(lines: DataFrame, as_of: dt.date, months_back: int = 0) -> DataFrame:
    """Month to report for each store: the last full month, or the month of its latest sale if older."""
    last_month = F.add_months(F.lit(first_of_month(as_of)), -1)
    latest = lines.where("storeName is not null").groupBy("storeName").agg(F.max("orderDate").alias("max_date"))
    start = F.add_months(F.least(F.trunc("max_date", "MM"), last_month), -months_back)
    return latest.where("max_date is not null").select(
        "storeName", start.alias("month_start"), F.last_day(start).alias("month_end"))


def week_lines(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    return store_period_lines(lines, weeks, "week_start", "week_end").withColumnRenamed("week_start", "period_start")


def month_lines(lines: DataFrame, months: DataFrame) -> DataFrame:
    return store_period_lines(lines, months, "month_start", "month_end").withColumnRenamed(
        "month_start", "period_start")


def two_week_lines(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    """Lines of the reported week and of the week before it, each with its own period_start."""
    spans = weeks.select("storeName", F.date_sub("week_start", 7).alias("span_start"), "week_end")
    bucket = week_bucket("orderDate", "week_end", 2)
    return store_period_lines(lines, spans, "span_start", "week_end").withColumn(
        "period_start", F.date_sub("week_end", 6 + 7 * bucket))


def two_month_lines(lines: DataFrame, months: DataFrame) -> DataFrame:
    """Lines of the reported month and of the month before it, each with its own period_start."""
    spans = months.select("storeName", F.add_months("month_start", -1).alias("span_start"), "month_end")
    return store_period_lines(lines, spans, "span_start", "month_end").withColumn(
        "period_start", F.trunc("orderDate", "MM"))


def _cost() -> Column:
    return F.coalesce(F.col("costPrice"), F.lit(0).cast("decimal(18,4)")) * F.col("quantity")


def _measures(grouped, totals: DataFrame, by) -> DataFrame:
    """Rounded report measures from the grouped sums and the store totals."""
    total = F.when(F.coalesce(F.col("store_total"), F.lit(0)) == 0, F.lit(1.0)).otherwise(
        F.col("store_total").cast("double"))
    margin = F.when(F.col("sales") > 0, ratio((F.col("sales") - F.col("cost")) * 100, "sales")).otherwise(F.lit(0.0))
    return grouped.join(totals, by).select(
        *[c for c in grouped.columns if c not in ("sales", "quantity", "cost")],
        F.round("sales", 2).cast("double").alias("total_sales"),
        F.col("quantity").alias("quantity_sold"),
        ratio(F.col("sales").cast("double") * 100, total).alias("contrib_percent"),
        margin.alias("profit_margin"))


def _sums():
    return [F.sum("totalProductPrice").alias("sales"), F.sum("quantity").alias("quantity"), F.sum(_cost()).alias("cost")]


def period_report(lines: DataFrame, name: str, top: int) -> DataFrame:
    """Top names of each store and period with sales, quantity, contribution and margin."""
    grouped = lines.groupBy("storeName", "period_start", name).agg(*_sums())
    totals = grouped.groupBy("storeName", "period_start").agg(F.sum("sales").alias("store_total"))
    order = [F.round("sales", 2).desc_nulls_last(), F.col(name).asc_nulls_last()]
    best = top_per_group(grouped, ["storeName", "period_start"], order, top, "sales_rank")
    return _measures(best, totals, ["storeName", "period_start"])


def weekly_brand(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    return period_report(week_lines(lines, weeks), "brandName", TOP_BRANDS)


def weekly_category(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    return period_report(week_lines(lines, weeks), "categoryName", TOP_CATEGORIES)


def weekly_product(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    return period_report(week_lines(lines, weeks), "productName", TOP_PRODUCTS)


def monthly_brand(lines: DataFrame, months: DataFrame) -> DataFrame:
    return period_report(month_lines(lines, months), "brandName", TOP_BRANDS)


def monthly_category(lines: DataFrame, months: DataFrame) -> DataFrame:
    return period_report(month_lines(lines, months), "categoryName", TOP_CATEGORIES)


def monthly_product(lines: DataFrame, months: DataFrame) -> DataFrame:
    return period_report(month_lines(lines, months), "productName", TOP_PRODUCTS)


def dimension_reports(lines: DataFrame, dims: dict[str, int] = None) -> DataFrame:
    """Brand, category and product reports of the given lines as one long table (dim, name).

    One scan: grouping sets expand each line once per dimension and combine on the map side.
    """
    dims = dims or DIMENSIONS
    names = list(dims)
    sets = [["storeName", "period_start", name] for name in names]
    grouped = lines.groupingSets(
        [[F.col(c) for c in s] for s in sets], "storeName", "period_start", *names).agg(
        *_sums(), *[F.grouping(n).alias(f"__no_{n}") for n in names])
    dim, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n in names:
        here = F.col(f"__no_{n}") == 0
        dim, name = F.when(here, F.lit(n)).otherwise(dim), F.when(here, F.col(n)).otherwise(name)
    keyed = grouped.select("storeName", "period_start", dim.alias("dim"), name.alias("name"), "sales", "quantity", "cost")
    totals = keyed.where(F.col("dim") == names[0]).groupBy("storeName", "period_start").agg(
        F.sum("sales").alias("store_total"))
    order = [F.round("sales", 2).desc_nulls_last(), F.col("name").asc_nulls_last()]
    ranked = top_per_group(keyed, ["storeName", "period_start", "dim"], order, max(dims.values()), "sales_rank")
    size = F.lit(0)
    for n, top in dims.items():
        size = F.when(F.col("dim") == n, F.lit(top)).otherwise(size)
    return _measures(ranked.where(F.col("sales_rank") <= size), totals, ["storeName", "period_start"])


def _financials(lines: DataFrame) -> DataFrame:
    price, cost = F.col("totalProductPrice"), _cost()
    margin = F.when(price > 0, F.try_divide((price - cost).cast("double"), price.cast("double")) * 100).otherwise(0.0)
    sums = lines.groupBy("storeName", "period_start").agg(
        F.sum(price).alias("sales"), F.sum(cost).alias("cost"), F.avg(margin).alias("margin"))
    money = lambda c: F.coalesce(F.round(c, 2).cast("double"), F.lit(0.0))
    return sums.select(
        "storeName", "period_start", money(F.col("sales")).alias("total_sales"),
        money(F.col("cost")).alias("total_cost"), money(F.col("sales") - F.col("cost")).alias("total_profit"),
        F.coalesce(rounded("margin"), F.lit(0.0)).alias("avg_profit_margin_percent"))


def weekly_financials(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    """Totals and the mean of the line margins, which is not the margin of the totals."""
    return _financials(week_lines(lines, weeks))


def monthly_financials(lines: DataFrame, months: DataFrame) -> DataFrame:
    return _financials(month_lines(lines, months))


def _comparison(buckets: DataFrame, previous: int) -> DataFrame:
    sums = buckets.groupBy("storeName").agg(
        F.coalesce(F.sum(F.when(F.col("bucket") == 0, F.col("totalProductPrice"))).cast("double"), F.lit(0.0))
        .alias("current_sales"),
        (F.coalesce(F.sum(F.when(F.col("bucket") > 0, F.col("totalProductPrice"))).cast("double"), F.lit(0.0))
         / float(previous)).alias("previous_avg"))
    both = (F.col("current_sales") > 0) & (F.col("previous_avg") > 0)
    return sums.select(
        "storeName", "current_sales", "previous_avg",
        F.when(both, rounded(pct_change("current_sales", "previous_avg"))).alias("diff_pct"),
        F.when(F.col("current_sales") <= 0, F.lit(NO_SALES)).when(F.col("previous_avg") <= 0, F.lit(NO_BASE))
        .otherwise("compared").alias("status"))


def weekly_comparison(lines: DataFrame, weeks: DataFrame) -> DataFrame:
    """Week against half the total of the two weeks before, also when one of them is empty."""
    spans = weeks.select("storeName", F.date_sub("week_end", 20).alias("span_start"), "week_end")
    bounded = store_period_lines(lines, spans, "span_start", "week_end")
    return _comparison(bounded.withColumn("bucket", week_bucket("orderDate", "week_end")), 2)


def monthly_comparison(lines: DataFrame, months: DataFrame) -> DataFrame:
    """Month against a third of the total of the three months before."""
    spans = months.select("storeName", F.add_months("month_start", -3).alias("span_start"), "month_start", "month_end")
    bounded = store_period_lines(lines, spans, "span_start", "month_end")
    return _comparison(bounded.withColumn("bucket", month_bucket("orderDate", "month_start")), 3)


def stock_lookup(stock: DataFrame) -> DataFrame:
    """Stock per store and brand, category (summed) and product (last row); long form (dim, name).

    Products come from a running maximum of (row_no, quantity), so no group is ever collected.
    """
    by = lambda c, dim: stock.where(F.col(c).isNotNull()).groupBy(
        "storeName", F.lit(dim).alias("dim"), F.col(c).alias("name"))
    return (
        by("brand", "brandName").agg(F.sum("quantity").alias("current_stock"))
        .unionByName(by("categoryName", "categoryName").agg(F.sum("quantity").alias("current_stock")))
        .unionByName(by("productName", "productName").agg(F.max_by("quantity", "row_no").alias("current_stock"))))


def inject_stock(report: DataFrame, lookup: DataFrame, name: str, dim: str = None) -> DataFrame:
    """Report with current_stock after quantity_sold; null where the store has no such stock row."""
    side = lookup.where(F.col("dim") == (dim or name)).select(
        "storeName", F.col("name").alias(name), "current_stock")
    at = report.columns.index("quantity_sold") + 1
    return report.join(side, ["storeName", name], "left").select(
        *report.columns[:at], "current_stock",
        F.coalesce(F.col("current_stock") < 0, F.lit(False)).alias("negative_stock"), *report.columns[at:])


def display_report(report: DataFrame) -> DataFrame:
    """Report with percent signs and short column labels."""
    percents = {c: F.concat(F.col(c).cast("string"), F.lit("%"))
                for c in ("contrib_percent", "profit_margin") if c in report.columns}
    return report.withColumns(percents).withColumnsRenamed(
        {c: label for c, label in COLUMN_LABELS.items() if c in report.columns})


def as_snapshot(report: DataFrame, name: str, period_col: str) -> DataFrame:
    """Report rows in the layout of a snapshot table."""
    return report.select(
        F.col("storeName").alias("storename"), F.col(name).alias("name"),
        F.col("period_start").alias(period_col), "total_sales",
        F.col("quantity_sold").cast("bigint").alias("quantity_sold"), "profit_margin", "contrib_percent")
