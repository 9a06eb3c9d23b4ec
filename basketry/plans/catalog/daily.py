"""Daily aggregates, chain-level daily and monthly reports, labels and period bounds."""

from pyspark.sql import functions as F

from basketry.functions import labels, periods
from basketry.functions.clean import rounded as round_to
from basketry.operators import aggregates, comparisons, store_reports
from basketry.operators.serial import add_serial, top_n_for_chart
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import (
    BILLING, BRAND_SALES, CATEGORY_SALES, PRODUCT_SALES, STORE_SALES, direction, pct, ratio, rounded, with_)
from basketry.sources import star, tables

MONTH = "2024-04"


def lines(name):
    """Only the columns a report over this name needs, so the joins it can do without fall away."""
    return lambda s, d: star.billing(s, d, ["invoice", "orderDate", "totalProductPrice", "quantity", name])


brand_lines, store_lines = lines("brandName"), lines("storeName")
category_lines, product_lines = lines("subCategoryOf"), lines("productName")


def _last(s, d):
    return tables.last_date(star.billing(s, d, ["orderDate"]))


def _end(s, d):
    return _last(s, d).scalar()


for name, build, cte, columns in [
    ("brand_sales", lambda s, d: aggregates.brand_sales(brand_lines(s, d)), BRAND_SALES, "brandname, nooforders, {}, aov, orderdate"),
    ("store_sales", lambda s, d: aggregates.store_sales(store_lines(s, d)), STORE_SALES, "storename, nooforder, {}, aov, orderdate"),
    ("category_sales", lambda s, d: aggregates.category_sales(category_lines(s, d)), CATEGORY_SALES, "subcategoryof, {}, orderdate"),
    ("product_sales", lambda s, d: aggregates.product_sales(product_lines(s, d)), PRODUCT_SALES,
     "productname, nooforders, {}, quantitysold, orderdate"),
]:
    query(name, build, with_(BILLING, cte) + f"select {columns.format('cast(sales as double) as sales')} from {name}")

query("total_sales_growth", lambda s, d: aggregates.total_sales_growth(aggregates.store_sales(store_lines(s, d)), _last(s, d)),
      with_(BILLING) + f"""select sales_today, case when base > 0 then {rounded("(sales_today - base) / base * 100")} else 0 end as growth_pct
 from (select coalesce(max(case when d = last then t end), 0) as sales_today,
 coalesce(avg(case when d < last then t end), 0) as base from
 (select "orderDate" as d, cast(sum("totalProductPrice") as double) as t, (select max("orderDate") from billing) as last
 from billing group by 1) where d between last - 7 and last)""")
query("dates_in_load", lambda s, d: aggregates.dates_in_load(star.billing(s, d, ["orderDate"])),
      with_(BILLING) + 'select distinct "orderDate" from billing where "orderDate" is not null')


def _daily_sql(table, cte, name, measures, top, days=7, group_today=False):
    """Today full outer joined to the mean of the previous days, as the reports state it."""
    today = ", ".join((f"sum({s})" if group_today else s) + f" as {t}_today" for s, t in measures)
    group = f"group by {name}" if group_today else ""
    previous = ", ".join(f"{ratio(f'sum({s})', f'count({s})')} as avg_{t}" for s, t in measures)
    columns = ", ".join(
        [f"coalesce(cast(l.{t}_today as double), 0) as {t}_today" for _, t in measures]
        + [f"coalesce(p.avg_{t}, 0) as avg_{t}_previous_days" for _, t in measures])
    trends = ", ".join(
        f"{direction(f'{t}_today', f'avg_{t}_previous_days')} as {t}_trend, "
        f"{rounded(pct(f'{t}_today', f'avg_{t}_previous_days'), 1)} as {t}_trend_pct" for _, t in measures)
    limit = f"qualify s_no <= {top}" if top else ""
    return with_(BILLING, cte, f"""bounds as (select max(orderdate) as e from {table}),
 l as (select {name}, {today} from {table} where orderdate = (select e from bounds) {group}),
 p as (select {name}, {previous} from {table} where orderdate between (select e - {days} from bounds)
 and (select e - 1 from bounds) group by {name}),
 j as (select distinct coalesce(l.{name}, p.{name}) as {name}, {columns} from l full outer join p on l.{name} = p.{name})""") + (
        f"select row_number() over (order by sales_today desc, {name}) as s_no, j.*, {trends} from j {limit}")


_THREE = [("nooforders", "orders"), ("sales", "sales"), ("aov", "aov")]
query("brand_daily", lambda s, d: comparisons.brand_daily(aggregates.brand_sales(brand_lines(s, d)), _end(s, d)),
      _daily_sql("brand_sales", BRAND_SALES, "brandname", _THREE, 50))
query("store_daily", lambda s, d: comparisons.store_daily(aggregates.store_sales(store_lines(s, d)), _end(s, d)),
      _daily_sql("store_sales", STORE_SALES, "storename", [("nooforder", "orders"), *_THREE[1:]], None))
query("store_daily_8_days", lambda s, d: comparisons.store_daily(aggregates.store_sales(store_lines(s, d)), _end(s, d), days=8),
      _daily_sql("store_sales", STORE_SALES, "storename", [("nooforder", "orders"), *_THREE[1:]], None, days=8))
query("category_daily", lambda s, d: comparisons.category_daily(aggregates.category_sales(category_lines(s, d)), _end(s, d)),
      _daily_sql("category_sales", CATEGORY_SALES, "subcategoryof", [("sales", "sales")], None, group_today=True))
_PRODUCT_DAILY = _daily_sql("product_sales", PRODUCT_SALES, "productname", [("sales", "sales"), ("quantitysold", "quantity")], 100)
query("product_daily", lambda s, d: comparisons.product_daily(aggregates.product_sales(product_lines(s, d)), _end(s, d)),
      _PRODUCT_DAILY)


def _chart(s, d):
    report = comparisons.store_daily(aggregates.store_sales(store_lines(s, d)), _end(s, d))
    return top_n_for_chart(report, "sales_today", "storename", 15).select("storename", "sales_today")


query("top_n_for_chart", _chart, "select storename, sales_today from ("
      + _daily_sql("store_sales", STORE_SALES, "storename", [("nooforder", "orders"), *_THREE[1:]], None)
      + ") where s_no <= 15")


def _displayed(s, d):
    report = comparisons.store_daily(aggregates.store_sales(store_lines(s, d)), _end(s, d))
    return comparisons.daily_display(report, "storename", ["orders", "sales", "aov"], {"orders": 0})


def _label_sql(value, fmt, direction_col, pct_col):
    return (f"format('{fmt}', {value}) || ' ' || case when {pct_col} is null then '→ (0%)' else case {direction_col} "
            f"when 1 then '🡅' when -1 then '🡇' else '→' end || printf(' (%.1f%%)', {pct_col}) end")


query("daily_display", _displayed, "select s_no, storename, "
      + _label_sql("orders_today", "{:,.0f}", "orders_trend", "orders_trend_pct") + " as orders, "
      + _label_sql("sales_today", "{:,.2f}", "sales_trend", "sales_trend_pct") + " as sales, "
      + _label_sql("aov_today", "{:,.2f}", "aov_trend", "aov_trend_pct") + " as aov from ("
      + _daily_sql("store_sales", STORE_SALES, "storename", [("nooforder", "orders"), *_THREE[1:]], None) + ")")

# Monthly.


def _in(date_col, first, last):
    return f"({date_col} >= date '{first}' and {date_col} < date '{last}')"


_CURRENT = ("2024-04-01", "2024-05-01")
_BOTH = ("2024-02-01", "2024-04-01")
query("month_totals", lambda s, d: comparisons.month_totals(star.billing(s, d, ["invoice", "orderDate", "totalProductPrice"]), MONTH),
      with_(BILLING) + f"""select count(distinct invoice) as unique_invoices, cast(sum("totalProductPrice") as double) as total_sales
 from billing where {_in('"orderDate"', *_CURRENT)}""")


def _monthly_sql(table, ctes, name, date_col, value, top, outer=False, quantity=None):
    current, both = _in(date_col, *_CURRENT), _in(date_col, *_BOTH)
    extra = f", cast(sum({quantity}) as bigint) as total_quantity" if quantity else ""
    extra_p = f", cast(sum({quantity}) as bigint) as previous_quantity" if quantity else ""
    out = ", coalesce(total_quantity, 0) as total_quantity, coalesce(previous_quantity, 0) as previous_quantity" if quantity else ""
    kind = "full outer" if outer else "left"
    limit = f"qualify s_no <= {top}" if top else ""
    return with_(*ctes, f"""c as (select {name}, sum({value}) as t{extra} from {table} where {current} group by 1),
 p as (select {name}, cast(sum({value}) as double) / 2 as a{extra_p} from {table} where {both} group by 1),
 j as (select coalesce(c.{name}, p.{name}) as {name}, coalesce(cast(t as double), 0) as total_sales,
 coalesce(a, 0) as avg_monthly_sales{out} from c {kind} join p on c.{name} = p.{name})""") + (
        f"select row_number() over (order by total_sales desc, {name}) as s_no, j.*, "
        f"{direction('total_sales', 'avg_monthly_sales')} as trend, {rounded(pct('total_sales', 'avg_monthly_sales'), 1)} as trend_pct "
        f"from j {limit}")


query("store_monthly", lambda s, d: comparisons.store_monthly(star.billing(s, d, ["storeName", "orderDate", "totalProductPrice"]), MONTH),
      _monthly_sql("billing", [BILLING], '"storeName"', '"orderDate"', '"totalProductPrice"', None))
query("brand_monthly", lambda s, d: comparisons.brand_monthly(aggregates.brand_sales(brand_lines(s, d)), MONTH),
      _monthly_sql("brand_sales", [BILLING, BRAND_SALES], "brandname", "orderdate", "sales", 100))
query("category_monthly", lambda s, d: comparisons.category_monthly(aggregates.category_sales(category_lines(s, d)), MONTH),
      _monthly_sql("category_sales", [BILLING, CATEGORY_SALES], "subcategoryof", "orderdate", "sales", None, outer=True))
query("product_monthly", lambda s, d: comparisons.product_monthly(aggregates.product_sales(product_lines(s, d)), MONTH),
      _monthly_sql("product_sales", [BILLING, PRODUCT_SALES], "productname", "orderdate", "sales", 100, quantity="quantitysold"))


def _monthly_display(s, d):
    report = comparisons.category_monthly(aggregates.category_sales(category_lines(s, d)), MONTH)
    return comparisons.monthly_display(report, "subcategoryof")


query("monthly_display", _monthly_display, "select s_no, subcategoryof, "
      + _label_sql("total_sales", "{:,.2f}", "trend", "trend_pct").replace("(0%)", "(N/A)") + " as sales_and_trend from ("
      + _monthly_sql("category_sales", [BILLING, CATEGORY_SALES], "subcategoryof", "orderdate", "sales", None, outer=True) + ")")

# Changes and labels over the two latest days of each brand.


def _two_days(s, d):
    sales = aggregates.brand_sales(brand_lines(s, d))
    end = _end(s, d)
    return sales.where(F.col("orderdate") >= F.date_sub(end, 1)).groupBy("brandname").agg(
        F.sum(F.when(F.col("orderdate") == end, F.col("sales"))).cast("double").alias("current"),
        F.sum(F.when(F.col("orderdate") < end, F.col("sales"))).cast("double").alias("previous"))


_TWO_DAYS = with_(BILLING, BRAND_SALES, """e as (select max(orderdate) as e from brand_sales),
 two as (select brandname, cast(sum(case when orderdate = (select e from e) then sales end) as double) as current,
 cast(sum(case when orderdate < (select e from e) then sales end) as double) as previous from brand_sales
 where orderdate >= (select e - 1 from e) group by 1)""")
query("pct_change", lambda s, d: _two_days(s, d).withColumn(
    "change", round_to(labels.pct_change("current", "previous"), 1)).withColumn("label", labels.pct_label("change")),
      _TWO_DAYS + f"""select *, case when change is not null then case when change >= 0 then '+' else '' end || printf('%.1f%%', change) end as label
 from (select *, {rounded(pct("current", "previous"), 1)} as change from two)""")
_ARROW = """case when change is null then '→ {z}' else case d when 1 then '🡅' when -1 then '🡇' else '→' end
 || printf(' (%.1f%%)', change) end"""
for name, build, zero in [
    ("trend_arrow", lambda c: labels.trend_arrow("current", c), "(0%)"),
    ("monthly_trend_arrow", lambda c: labels.trend_arrow("current", c, labels.NOT_AVAILABLE_LABEL), "(N/A)"),
]:
    query(name, lambda s, d, build=build: _two_days(s, d).withColumn("arrow", build("previous")),
          _TWO_DAYS + f"""select brandname, current, previous, {_ARROW.format(z=zero)} as arrow from
 (select *, {rounded(pct("current", "previous"), 1)} as change, {direction("current", "previous")} as d from two)""")
query("sales_label", lambda s, d: _two_days(s, d).select("brandname", labels.sales_label(
    "current", labels.trend_arrow("current", "previous")).alias("label")),
      _TWO_DAYS + f"""select brandname, concat_ws(' ', format('{{:,.2f}}', current), {_ARROW.format(z="(0%)")}) as label from
 (select *, {rounded(pct("current", "previous"), 1)} as change, {direction("current", "previous")} as d from two)""")
query("add_serial", lambda s, d: add_serial(
    star.billing(s, d, ["productName", "orderDate", "totalProductPrice"]).groupBy("productName", "orderDate").agg(
        F.sum("totalProductPrice").alias("sales")), [F.col("sales").desc(), F.col("productName"), F.col("orderDate")]),
      with_(BILLING) + """select row_number() over (order by sum("totalProductPrice") desc, "productName", "orderDate") as s_no,
 "productName", "orderDate", cast(sum("totalProductPrice") as double) as sales from billing group by "productName", "orderDate\"""")

# Periods.

query("store_weeks", lambda s, d: store_reports.store_weeks(star.billing(s, d, ["storeName", "orderDate"])),
      with_(BILLING) + """select "storeName", max("orderDate") - 6 as week_start, max("orderDate") as week_end from billing
 where "storeName" is not null group by 1""")
query("store_report_months", lambda s, d: store_reports.store_report_months(star.billing(s, d, ["storeName", "orderDate"]), star.AS_OF),
      with_(BILLING) + """select "storeName", cast(m as date) as month_start, last_day(cast(m as date)) as month_end from (
 select "storeName", least(date_trunc('month', max("orderDate")), timestamp '2024-04-01') as m from billing
 where "storeName" is not null group by 1)""")


def _window(s, d):
    first, last = aggregates.daily_window(star.LAST_DAY, 8)
    return star.billing(s, d, ["orderDate", "totalProductPrice"]).where(F.col("orderDate").between(F.lit(first), F.lit(last))).groupBy(
        "orderDate").agg(F.sum("totalProductPrice").alias("sales"))


query("daily_window", _window, with_(BILLING) + """select "orderDate", cast(sum("totalProductPrice") as double) as sales
 from billing where "orderDate" between date '2024-04-22' and date '2024-04-29' group by 1""")
query("month_key", lambda s, d: star.billing(s, d, ["orderDate", "invoice"]).where(
    periods.in_months("orderDate", "2024-02", "2024-03")).groupBy("orderDate").agg(F.count("*").alias("n")),
      with_(BILLING) + """select "orderDate", count(*) as n from billing where strftime("orderDate", '%Y-%m') in ('2024-02', '2024-03') group by 1""")
query("week_bucket", lambda s, d: star.billing(s, d, ["orderDate", "totalProductPrice"]).groupBy(
    periods.week_bucket("orderDate", F.lit(star.LAST_DAY)).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum("totalProductPrice").alias("sales")),
      with_(BILLING) + """select case when "orderDate" > date '2024-04-23' and "orderDate" <= date '2024-04-30' then 0
 when "orderDate" > date '2024-04-16' and "orderDate" <= date '2024-04-23' then 1
 when "orderDate" > date '2024-04-09' and "orderDate" <= date '2024-04-16' then 2 end as bucket,
 count(*) as n, cast(sum("totalProductPrice") as double) as sales from billing group by 1""")
