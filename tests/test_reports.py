"""Traps of the daily, monthly and store reports."""

import datetime as dt

from pyspark.sql import functions as F

from basketry.operators import aggregates, comparisons, store_reports as sr
from basketry.operators.staging import stage

END = dt.date(2024, 4, 30)
BRANDS = "brandname string, nooforders bigint, sales double, aov double, orderdate date"


def day(n):
    return END - dt.timedelta(days=n)


def test_daily_report_traps(spark):
    rows = [
        ("A", 2, 20.0, 10.0, day(0)), ("A", 1, 10.0, 10.0, day(1)), ("A", 1, 30.0, 30.0, day(7)), ("A", 9, 900.0, 1.0, day(8)),
        ("gone", 3, 7.0, 2.33, day(2)), ("new", 1, 5.0, 5.0, day(0)),
        (None, 1, 4.0, 4.0, day(0)), (None, 1, 2.0, 2.0, day(1)),
        ("twice", 1, 6.0, 6.0, day(0)), ("twice", 1, 8.0, 8.0, day(0)), ("same", 1, 3.0, 3.0, day(0)), ("same", 1, 3.0, 3.0, day(0)),
    ]
    got = comparisons.brand_daily(spark.createDataFrame(rows, BRANDS)).orderBy("s_no").collect()
    key = [(r["brandname"], r["sales_today"], r["avg_sales_previous_days"], r["sales_trend"]) for r in got]
    assert key == [
        ("A", 20.0, 20.0, 0), ("twice", 8.0, 0.0, 0), ("twice", 6.0, 0.0, 0), ("new", 5.0, 0.0, 0), (None, 4.0, 0.0, 0),
        ("same", 3.0, 0.0, 0), ("gone", 0.0, 7.0, -1), (None, 0.0, 2.0, -1)]
    assert [r["s_no"] for r in got] == list(range(1, 9))


def test_daily_limit(spark):
    rows = [(f"B{i:03}", 1, float(i), 1.0, END) for i in range(70)]
    got = comparisons.brand_daily(spark.createDataFrame(rows, BRANDS))
    assert got.count() == 50 and got.orderBy("s_no").first()["brandname"] == "B069"


def test_category_report_sums_today(spark):
    rows = [("c", 1.0, day(0)), ("c", 2.0, day(0)), ("c", 4.0, day(1)), ("c", 8.0, day(1)), (None, 1.0, day(0)), (None, 3.0, day(1))]
    got = comparisons.category_daily(spark.createDataFrame(rows, "subcategoryof string, sales double, orderdate date")).collect()
    assert sorted((str(r["subcategoryof"]), r["sales_today"], r["avg_sales_previous_days"]) for r in got) == [
        ("None", 0.0, 3.0), ("None", 1.0, 0.0), ("c", 3.0, 6.0)]


def test_month_report_divides_by_two(spark):
    rows = [("a", 10.0, dt.date(2024, 3, 5)), ("a", 6.0, dt.date(2024, 2, 5)), ("b", 4.0, dt.date(2024, 2, 1)), ("a", 99.0, dt.date(2023, 12, 31))]
    sales = spark.createDataFrame(rows, "subcategoryof string, sales double, orderdate date")
    got = {r["subcategoryof"]: (r["total_sales"], r["avg_monthly_sales"]) for r in comparisons.category_monthly(sales, "2024-03").collect()}
    assert got == {"a": (10.0, 3.0), "b": (0.0, 2.0)}
    brands = sales.withColumnRenamed("subcategoryof", "brandname")
    assert {r["brandname"] for r in comparisons.brand_monthly(brands, "2024-03").collect()} == {"a"}


LINES = "storeName string, orderDate date, brandName string, totalProductPrice decimal(18,4), quantity int, costPrice decimal(18,4)"


def lines(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame(
        [(s, d, b, Decimal(str(p)), q, None if c is None else Decimal(str(c))) for s, d, b, p, q, c in rows], LINES)


def test_group_margin_is_not_the_mean_line_margin(spark):
    df = lines(spark, [("S", day(0), "A", 100, 1, 50), ("S", day(6), "A", 10, 1, None), ("S", day(7), "A", 500, 1, 1), ("S", day(1), "B", -5, 1, 1)])
    weeks = stage(sr.store_weeks(df))
    brand = {r["brandName"]: r for r in sr.weekly_brand(df, weeks).collect()}
    assert (brand["A"]["total_sales"], brand["A"]["profit_margin"], brand["A"]["quantity_sold"]) == (110.0, 54.55, 2)
    assert brand["B"]["profit_margin"] == 0.0 and brand["A"]["contrib_percent"] == 104.76
    total = sr.weekly_financials(df, weeks).first()
    assert (total["total_sales"], total["total_cost"], total["avg_profit_margin_percent"]) == (105.0, 51.0, 50.0)


def test_store_total_of_zero_counts_as_one(spark):
    df = lines(spark, [("S", END, "A", 5, 1, 1), ("S", END, "B", -5, 1, 1)])
    got = {r["brandName"]: r["contrib_percent"] for r in sr.weekly_brand(df, stage(sr.store_weeks(df))).collect()}
    assert got == {"A": 500.0, "B": -500.0}


def test_comparisons_use_fixed_divisors(spark):
    df = lines(spark, [("S", day(0), "A", 100, 1, 1), ("S", day(14), "A", 50, 1, 1), ("T", day(0), "A", 10, 1, 1), ("U", day(0), "A", -1, 1, 1)])
    weekly = {r["storeName"]: r for r in sr.weekly_comparison(df, stage(sr.store_weeks(df))).collect()}
    assert (weekly["S"]["previous_avg"], weekly["S"]["diff_pct"]) == (25.0, 300.0)
    assert weekly["T"]["status"] == sr.NO_BASE and weekly["U"]["status"] == sr.NO_SALES
    months = stage(sr.store_report_months(df, dt.date(2024, 5, 10)))
    monthly = {r["storeName"]: r for r in sr.monthly_comparison(df, months).collect()}
    assert (monthly["S"]["current_sales"], monthly["S"]["previous_avg"]) == (150.0, 0.0)


def test_report_month_is_never_the_running_month(spark):
    df = lines(spark, [("new", dt.date(2024, 5, 3), "A", 1, 1, 1), ("old", dt.date(2024, 2, 3), "A", 1, 1, 1)])
    got = {r["storeName"]: (r["month_start"], r["month_end"]) for r in sr.store_report_months(df, dt.date(2024, 5, 10)).collect()}
    assert got == {"new": (dt.date(2024, 4, 1), dt.date(2024, 4, 30)), "old": (dt.date(2024, 2, 1), dt.date(2024, 2, 29))}


def test_one_scan_gives_the_same_as_single_reports(spark, sf_dir):
    from basketry.sources import star

    df = star.billing(spark, sf_dir)
    weeks = stage(sr.store_weeks(df))
    long = sr.dimension_reports(sr.two_week_lines(df, weeks))
    now = long.join(weeks.select("storeName", F.col("week_start").alias("period_start")), ["storeName", "period_start"], "left_semi")
    single = sr.weekly_product(df, weeks)
    columns = ["storeName", "sales_rank", "total_sales", "quantity_sold", "contrib_percent", "profit_margin"]
    a = now.where("dim = 'productName'").select(*columns, "name").collect()
    b = single.select(*columns, F.col("productName").alias("name")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_growth_without_a_base(spark):
    sales = spark.createDataFrame([("S", 5.0, END)], "storename string, sales double, orderdate date")
    assert tuple(aggregates.total_sales_growth(sales).first()) == (5.0, 0.0)


def test_empty_aggregates_give_empty_reports(spark):
    empty = spark.createDataFrame([], BRANDS)
    assert comparisons.brand_daily(empty).count() == 0
    assert comparisons.store_daily(empty.withColumnsRenamed({"brandname": "storename", "nooforders": "nooforder"})).count() == 0
