"""Queries over tables that the daily load stored: the dashboard, and renames of what is stored."""

from pyspark.sql import functions as F

from basketry.operators.staging import scratch_path
from basketry.plans import daily_load, dashboard, rename_stored
from basketry.plans.catalog.daily import _THREE, _daily_sql
from basketry.plans.catalog.ingest import _GOOD, _USED, HEAD_OFFICE, RAW, product_rules
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import BILLING, BRAND_SALES, STORE_SALES, with_
from basketry.sources import star


def _stored(spark, d) -> str:
    root = scratch_path(spark, "stored")
    daily_load.load_sales(spark, star.raw_sales(spark, d), root, excluded_store=HEAD_OFFICE)
    return root


def _dashboard(spark, d):
    reports = dashboard.daily_dashboard(spark, _stored(spark, d))
    part = lambda report, name: reports[report].select(
        F.lit(report).alias("report"), "s_no", F.col(name).alias("name"), "sales_today", "avg_sales_previous_days")
    return part("brands", "brandname").unionByName(part("stores", "storename"))


_LOADED = ", ".join([RAW, _GOOD, _USED.replace("used as (", "billing as (", 1)])
_REPORT = "select '{}' as report, s_no, {} as name, sales_today, avg_sales_previous_days from ({})"
query("daily_dashboard", _dashboard, " union all ".join([
    _REPORT.format("brands", "brandname", _daily_sql("brand_sales", BRAND_SALES, "brandname", _THREE, 50).replace(BILLING, _LOADED)),
    _REPORT.format("stores", "storename", _daily_sql(
        "store_sales", STORE_SALES, "storename", [("nooforder", "orders"), *_THREE[1:]], None, days=8).replace(BILLING, _LOADED))]))


def _renamed(spark, d):
    """Product sales by day after the renames ran over the stored tables, twice."""
    root, rules = _stored(spark, d), product_rules(spark, d)
    for _ in range(2):
        rename_stored.rename_stored(spark, root, rules, excluded_store=HEAD_OFFICE)
    return spark.read.parquet(f"{root}/product_sales").select("productname", "nooforders", "sales", "quantitysold", "orderdate")


query("rename_stored", _renamed, with_(RAW, _GOOD, _USED) + r"""select regexp_replace("productName", ' [12]ml$', ' 3ml') as productname,
 count(distinct invoice) as nooforders, cast(sum("totalProductPrice") as double) as sales, sum(quantity) as quantitysold,
 "orderDate" as orderdate from used group by 1, "orderDate" """)
