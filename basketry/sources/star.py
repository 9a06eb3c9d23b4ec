"""Retail views over the star-schema tables: sales lines, stock, returns and partners.

Dimension keys are unique and joined from the left, so a view may leave out the joins of the
columns that are not asked for without changing its rows. No side is forced into a broadcast:
the optimiser broadcasts a dimension only while its size is under the session's threshold.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FIRST_DAY = dt.date(2024, 1, 1)
DAYS = 121
# The views cover FIRST_DAY .. LAST_DAY; reports "as of" the next day take April as last month.
LAST_DAY = dt.date(2024, 4, 30)
AS_OF = dt.date(2024, 5, 1)

BILLING_COLUMNS = [
    "invoice", "orderDate", "productId", "productName", "quantity", "totalProductPrice",
    "costPrice", "brandName", "categoryName", "subCategoryOf", "storeName",
]
_FROM_PART = {"productName", "costPrice", "brandName", "categoryName", "subCategoryOf"}
_FROM_STORE = {"storeName"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _folded_date() -> Column:
    return F.expr("date_add(date'2024-01-01', cast(datediff(cast(o_orderdate as date), "
                  f"date'1995-01-01') % {DAYS} as int))")


def _price() -> Column:
    return F.expr("cast(cast(l_extendedprice as decimal(18,2)) * (cast(1 as decimal(5,2)) - "
                  "cast(l_discount as decimal(5,2))) as decimal(18,4))")


def _product() -> Column:
    return F.expr("concat(p_name, ' ', cast(p_size as string), 'ml')")


def _dated_lines(spark, sf_dir, with_store: bool, with_part: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", _folded_date().alias("orderDate"))
    if with_store:
        stores = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select(F.col("c_custkey").alias("o_custkey"), "n_nationkey", "n_name")
        orders = orders.join(stores, "o_custkey", "left")
    lines = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey", "left")
    if with_part:
        part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
        lines = lines.join(part, "l_partkey", "left")
    return lines


def billing(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """One row per invoice line, with only the columns asked for."""
    columns = list(columns or BILLING_COLUMNS)
    lines = _dated_lines(spark, sf_dir, bool(_FROM_STORE & set(columns)), bool(_FROM_PART & set(columns)))
    expressions = {
        "invoice": F.expr("concat('INV', cast(l_orderkey as string))"),
        "orderDate": F.col("orderDate"),
        "productId": F.col("l_partkey"),
        "productName": _product(),
        "quantity": F.expr("cast(l_quantity as int)"),
        "totalProductPrice": _price(),
        "costPrice": F.expr("cast(p_retailprice as decimal(18,4))"),
        "brandName": F.col("p_brand"),
        "categoryName": F.col("p_type"),
        "subCategoryOf": F.expr("split_part(p_name, ' ', 2)"),
        "storeName": F.col("n_name"),
    }
    return lines.select(*[expressions[c].alias(c) for c in columns])


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as dirty text, with bad dates, prices, quantities, invoices and extra columns."""
    lines = _dated_lines(spark, sf_dir, True, True).withColumn("price", _price().cast("string"))
    return lines.selectExpr(
        "case when l_orderkey % 97 = 0 then '  ' when l_orderkey % 101 = 0 then null "
        "else concat('INV', cast(l_orderkey as string)) end as invoice",
        "case l_orderkey % 7 when 0 then date_format(orderDate, 'yyyy-MM-dd') "
        "when 1 then date_format(orderDate, 'dd-MM-yyyy') when 2 then date_format(orderDate, 'MM/dd/yyyy') "
        "when 3 then date_format(orderDate, 'dd/MM/yyyy') when 4 then date_format(orderDate, 'yyyy/MM/dd') "
        "when 5 then 'not-a-date' end as orderDate",
        "case when l_orderkey % 11 = 0 then 'nan' else concat('10:15:', "
        "lpad(cast(l_orderkey % 60 as string), 2, '0'), '.123') end as time",
        "cast(l_partkey as string) as productId",
        "concat(p_name, ' ', cast(p_size as string), 'ml') as productName",
        "cast(890000000000 + l_partkey as string) as barcode",
        "case when l_linenumber = 7 then '0' when l_partkey % 53 = 0 then '-1' "
        "when l_partkey % 59 = 0 then 'abc' else cast(l_quantity as string) end as quantity",
        "case when l_suppkey % 41 = 0 then concat('-', price) when l_suppkey % 43 = 0 then 'nan' "
        "else price end as totalProductPrice",
        "cast(cast(p_retailprice as decimal(18,4)) as string) as costPrice",
        "p_brand as brandName", "p_type as categoryName", "split_part(p_name, ' ', 2) as subCategoryOf",
        "case when n_nationkey = 0 then 'Head Office' else n_name end as storeName",
        "case when l_linenumber % 2 = 0 then 'offline' else 'online' end as orderType",
        "'x' as productMrp", "'y' as extra1",
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store and product. Each product is repeated once per nation key, then named."""
    nations = table(spark, sf_dir, "nation")
    suppliers = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part").select(
        "*",
        nations.agg(F.max("n_nationkey")).scalar().alias("last_nation"),
        suppliers.agg(F.count("*")).scalar().alias("n_suppliers"),
    )
    per_store = part.select(
        "*", F.explode(F.sequence(F.lit(0), "last_nation")).alias("n_nationkey"),
        (F.col("p_partkey") % F.col("n_suppliers")).alias("s_suppkey"))
    return (
        per_store.join(nations, "n_nationkey")
        .join(suppliers.select("s_suppkey", "s_name"), "s_suppkey", "left")
        .select(
            F.col("n_name").alias("storeName"), _product().alias("productName"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("categoryName"),
            F.col("s_name").alias("vendorName"),
            F.expr("cast((p_partkey * 7 + n_nationkey * 13) % 60 - 5 as double)").alias("quantity"),
            F.col("p_retailprice").cast("double").alias("sellingPrice"),
            (F.col("p_retailprice") * 0.7).alias("costPrice"),
            F.col("p_partkey").alias("row_no"))
    )


def rtv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return-to-vendor lines: the returned sales lines with vendor, value and reason."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = _dated_lines(spark, sf_dir, True, True).where("l_returnflag = 'R'").join(suppliers, "l_suppkey", "left")
    return lines.selectExpr(
        "concat('RTV', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as rtvId",
        "orderDate as Date", "s_name as vendorName", "l_partkey as productId",
        "concat(p_name, ' ', cast(p_size as string), 'ml') as productName",
        "cast(l_quantity as double) as quantity", "cast(p_retailprice as double) as price",
        "cast(cast(l_quantity as decimal(18,2)) * cast(p_retailprice as decimal(18,2)) as decimal(18,4)) "
        "as totalAmount",
        "case l_partkey % 5 when 0 then 'Expired' when 1 then ' Damaged ' when 2 then 'Slow moving' "
        "when 3 then '' end as description",
        "n_name as storeName",
    )


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contact row per store, all invented."""
    return table(spark, sf_dir, "nation").selectExpr(
        "n_name as storeName",
        "concat('p', cast(n_nationkey as string), '@example.test') as email",
        "case when n_nationkey % 10 = 9 then null "
        "when n_nationkey % 2 = 0 then concat('+00 100-', cast(1000 + n_nationkey as string)) "
        "else concat('(00) 100 ', cast(1000 + n_nationkey as string)) end as wa_number",
        "case n_nationkey % 3 when 0 then null when 1 then '  ' "
        "else concat(' https://reports.example.test/', cast(n_nationkey as string)) end as pdf_link",
    )
