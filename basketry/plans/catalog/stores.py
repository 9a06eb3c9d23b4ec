"""Weekly and monthly reports of every store, stock beside sales, trends against snapshots."""

from pyspark.sql import DataFrame, functions as F

from basketry.operators import store_reports as sr, trends
from basketry.operators.staging import stage
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import BILLING, STOCK, pct, ratio, rounded, with_
from basketry.sources import star

_LINE = ["storeName", "orderDate", "totalProductPrice", "quantity", "costPrice"]
DIMS = {"brandName": 50, "categoryName": 50, "productName": 100}


def weeks(s, d):
    """The period table is tiny and used several times per report, so it is worked out once."""
    return stage(sr.store_weeks(star.billing(s, d, ["storeName", "orderDate"])))


def months(s, d):
    return stage(sr.store_report_months(star.billing(s, d, ["storeName", "orderDate"]), star.AS_OF))


def _split(both: DataFrame, periods: DataFrame, start: str) -> tuple[DataFrame, DataFrame]:
    current = periods.select("storeName", F.col(start).alias("period_start"))
    keys = ["storeName", "period_start"]
    return both.join(current, keys, "left_semi"), both.join(current, keys, "left_anti")


def weekly_rows(s, d) -> tuple[DataFrame, DataFrame]:
    """Report rows of each store's week and, from the same scan, the rows of the week before."""
    found = weeks(s, d)
    both = stage(sr.dimension_reports(sr.two_week_lines(star.billing(s, d, [*_LINE, *DIMS]), found)))
    rows, before = _split(both, found, "week_start")
    return rows, trends.wow_previous(before)


def monthly_rows(s, d) -> tuple[DataFrame, DataFrame]:
    found = months(s, d)
    both = stage(sr.dimension_reports(sr.two_month_lines(star.billing(s, d, [*_LINE, *DIMS]), found)))
    rows, before = _split(both, found, "month_start")
    return rows, trends.mom_previous(before)


WEEKS = """weeks as (select "storeName", max("orderDate") - 6 as period_start, max("orderDate") as period_end from billing
 where "storeName" is not null group by 1)"""
MONTHS = """weeks as (select "storeName", cast(m as date) as period_start, last_day(cast(m as date)) as period_end from (
 select "storeName", least(date_trunc('month', max("orderDate")), timestamp '2024-04-01') as m from billing
 where "storeName" is not null group by 1))"""


def rows_sql(view: str, periods: str, dims=DIMS) -> str:
    """CTEs of the report rows of a period table, as ``view``."""
    union = " union all ".join(
        f"""select "storeName", period_start, '{n}' as dim, "{n}" as name, sum("totalProductPrice") as sales,
 cast(sum(quantity) as bigint) as quantity, sum(coalesce("costPrice", 0) * quantity) as cost, {top} as top from {view}_lines group by 1, 2, 4"""
        for n, top in dims.items())
    return f"""{view}_lines as (select b.*, w.period_start from billing b join {periods} w using ("storeName")
 where b."orderDate" between w.period_start and w.period_end),
 {view}_grouped as ({union}),
 {view}_total as (select "storeName", period_start, cast(sum("totalProductPrice") as double) as t from {view}_lines group by 1, 2),
 {view} as (select "storeName", period_start, dim, name,
 row_number() over (partition by "storeName", period_start, dim order by round(sales, 2) desc nulls last, name) as sales_rank,
 cast(round(sales, 2) as double) as total_sales, quantity as quantity_sold,
 {ratio("cast(sales as double) * 100", "case when coalesce(t, 0) = 0 then 1.0 else t end")} as contrib_percent,
 case when sales > 0 then {ratio("(sales - cost) * 100", "sales")} else 0 end as profit_margin
 from {view}_grouped join {view}_total using ("storeName", period_start) qualify sales_rank <= top)"""


PREVIOUS_WEEKS = """previous_weeks as (select "storeName", period_start - 7 as period_start, period_end - 7 as period_end from weeks)"""
PREVIOUS_MONTHS = """previous_weeks as (select "storeName", cast(period_start - interval 1 month as date) as period_start,
 period_start - 1 as period_end from weeks)"""
_COLUMNS = '"storeName", period_start, name as "{n}", sales_rank, total_sales, quantity_sold, contrib_percent, profit_margin'

for kind, period_cte, lines_of, periods_of in [
        ("weekly", WEEKS, sr.week_lines, weeks), ("monthly", MONTHS, sr.month_lines, months)]:
    for label, column in [("brand", "brandName"), ("category", "categoryName"), ("product", "productName")]:
        query(f"{kind}_{label}",
              lambda s, d, column=column, lines_of=lines_of, periods_of=periods_of: sr.period_report(
                  lines_of(star.billing(s, d, [*_LINE, column]), periods_of(s, d)), column, DIMS[column]),
              with_(BILLING, period_cte, rows_sql("rows", "weeks", {column: DIMS[column]}))
              + f"select {_COLUMNS.format(n=column)} from rows")
    money = lambda x: f"coalesce(cast(round({x}, 2) as double), 0)"
    query(f"{kind}_financials",
          lambda s, d, kind=kind, periods_of=periods_of: getattr(sr, f"{kind}_financials")(star.billing(s, d, _LINE), periods_of(s, d)),
          with_(BILLING, period_cte) + f"""select "storeName", period_start, {money("sum(p)")} as total_sales, {money("sum(c)")} as total_cost,
 {money("sum(p) - sum(c)")} as total_profit, coalesce({rounded("avg(case when p > 0 then cast(p - c as double) / cast(p as double) * 100 else 0 end)")}, 0)
 as avg_profit_margin_percent from (select b."storeName", period_start, "totalProductPrice" as p, coalesce("costPrice", 0) * quantity as c
 from billing b join weeks w using ("storeName") where b."orderDate" between period_start and period_end) group by 1, 2""")

_STATUS = f"""case when current_sales > 0 and previous_avg > 0 then {rounded(pct("current_sales", "previous_avg"))} end as diff_pct,
 case when current_sales <= 0 then '{sr.NO_SALES}' when previous_avg <= 0 then '{sr.NO_BASE}' else 'compared' end as status"""
query("weekly_comparison", lambda s, d: sr.weekly_comparison(
    star.billing(s, d, ["storeName", "orderDate", "totalProductPrice"]), weeks(s, d)),
      with_(BILLING, WEEKS) + f"""select *, {_STATUS} from (select "storeName",
 coalesce(cast(sum(case when "orderDate" > period_end - 7 then "totalProductPrice" end) as double), 0) as current_sales,
 coalesce(cast(sum(case when "orderDate" <= period_end - 7 then "totalProductPrice" end) as double), 0) / 2.0::double as previous_avg
 from billing join weeks using ("storeName") where "orderDate" > period_end - 21 and "orderDate" <= period_end group by 1)""")
query("monthly_comparison", lambda s, d: sr.monthly_comparison(
    star.billing(s, d, ["storeName", "orderDate", "totalProductPrice"]), months(s, d)),
      with_(BILLING, MONTHS) + f"""select *, {_STATUS} from (select "storeName",
 coalesce(cast(sum(case when "orderDate" >= period_start then "totalProductPrice" end) as double), 0) as current_sales,
 coalesce(cast(sum(case when "orderDate" < period_start then "totalProductPrice" end) as double), 0) / 3.0::double as previous_avg
 from billing join weeks using ("storeName") where "orderDate" >= cast(period_start - interval 3 month as date)
 and "orderDate" <= period_end group by 1)""")

_LOOKUP = """lookup as (select "storeName", 'brandName' as dim, brand as name, sum(quantity) as current_stock from stock group by 1, 3
 union all select "storeName", 'categoryName', "categoryName", sum(quantity) from stock group by 1, 3
 union all select "storeName", 'productName', "productName", arg_max(quantity, row_no) from stock group by 1, 3)"""
query("stock_lookup", lambda s, d: sr.stock_lookup(star.stock(s, d)), with_(STOCK, _LOOKUP) + "select * from lookup")


def _injected(s, d, column):
    report = sr.period_report(sr.week_lines(star.billing(s, d, [*_LINE, column]), weeks(s, d)), column, DIMS[column])
    return sr.inject_stock(report, sr.stock_lookup(star.stock(s, d)), column)


_WEEKLY_PRODUCT = rows_sql("rows", "weeks", {"productName": 100})
query("inject_stock", lambda s, d: _injected(s, d, "productName"), with_(BILLING, STOCK, _LOOKUP, WEEKS, _WEEKLY_PRODUCT)
      + """select r."storeName", period_start, r.name as "productName", sales_rank, total_sales, quantity_sold, current_stock,
 coalesce(current_stock < 0, false) as negative_stock, contrib_percent, profit_margin
 from rows r left join lookup k on k.dim = 'productName' and k."storeName" = r."storeName" and k.name = r.name""")
query("display_report", lambda s, d: sr.display_report(_injected(s, d, "brandName")).withColumnsRenamed(
    {label: c for c, label in sr.COLUMN_LABELS.items() if c != "brandName"} | {"Brand": "brandName"}),
      with_(BILLING, STOCK, _LOOKUP, WEEKS, rows_sql("rows", "weeks", {"brandName": 50}))
      + """select r."storeName", period_start, r.name as "brandName", sales_rank, total_sales, quantity_sold, current_stock,
 coalesce(current_stock < 0, false) as negative_stock, cast(contrib_percent as varchar) || '%' as contrib_percent,
 cast(profit_margin as varchar) || '%' as profit_margin
 from rows r left join lookup k on k.dim = 'brandName' and k."storeName" = r."storeName" and k.name = r.name""")

# Trends.

WEEKLY = with_(BILLING, WEEKS, PREVIOUS_WEEKS, rows_sql("rows", "weeks"), rows_sql("before", "previous_weeks"),
               """previous as (select "storeName", period_start + 7 as period_start, dim, name, total_sales as prev_sales,
 quantity_sold as prev_qty, profit_margin as prev_margin from before)""").rstrip()
MONTHLY = with_(BILLING, MONTHS, PREVIOUS_MONTHS, rows_sql("rows", "weeks"), rows_sql("before", "previous_weeks"),
                """previous as (select "storeName", cast(period_start + interval 1 month as date) as period_start, dim, name,
 total_sales as prev_sales, quantity_sold as prev_qty, profit_margin as prev_margin from before)""").rstrip()
CHANGES = f"""changes as (select r."storeName", r.period_start, r.dim, r.name, r.total_sales as sales, cast(coalesce(r.quantity_sold, 0) as double) as qty,
 r.profit_margin as margin, r.contrib_percent as contrib, prev_sales, prev_qty, prev_margin,
 {rounded(pct("r.total_sales", "prev_sales"), 1)} as sales_change, {rounded(pct("r.quantity_sold", "prev_qty"), 1)} as qty_change,
 {rounded("r.profit_margin - prev_margin", 1)} as margin_shift
 from rows r left join previous p on r."storeName" = p."storeName" and r.period_start = p.period_start and r.dim = p.dim and r.name = p.name)"""
query("wow_previous", lambda s, d: weekly_rows(s, d)[1], WEEKLY + "\nselect * from previous")
query("mom_previous", lambda s, d: monthly_rows(s, d)[1], MONTHLY + "\nselect * from previous")
query("enrich_with_trends", lambda s, d: trends.enrich_with_trends(*weekly_rows(s, d)),
      WEEKLY + ",\n" + CHANGES + "\nselect * from changes")
query("enrich_with_monthly_trends", lambda s, d: trends.enrich_with_trends(*monthly_rows(s, d)),
      MONTHLY + ",\n" + CHANGES + "\nselect * from changes")
query("has_trend_data", lambda s, d: trends.has_trend_data(*weekly_rows(s, d)),
      WEEKLY + """\nselect distinct "storeName", period_start, dim, exists (select 1 from previous p where p."storeName" = r."storeName"
 and p.period_start = r.period_start and p.dim = r.dim) as has_trend_data from rows r""")
