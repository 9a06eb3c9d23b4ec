"""SQL text of the retail views and of shared expressions, for the checking engine."""

DATE = ("(date '2024-01-01' + cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) % 121 as int))")
PRICE = ("cast(cast(l_extendedprice as decimal(18,2)) * (cast(1 as decimal(5,2)) - "
         "cast(l_discount as decimal(5,2))) as decimal(18,4))")
PRODUCT = "concat(p_name, ' ', cast(p_size as varchar), 'ml')"
JOINS = ("lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey "
         "left join nation on c_nationkey = n_nationkey left join part on l_partkey = p_partkey")

BILLING = f"""billing as (select concat('INV', cast(l_orderkey as varchar)) as invoice, {DATE} as "orderDate",
 l_partkey as "productId", {PRODUCT} as "productName", cast(l_quantity as int) as quantity,
 {PRICE} as "totalProductPrice", cast(p_retailprice as decimal(18,4)) as "costPrice", p_brand as "brandName",
 p_type as "categoryName", split_part(p_name, ' ', 2) as "subCategoryOf", n_name as "storeName"
 from {JOINS})"""

RAW = f"""raw as (select case when l_orderkey % 97 = 0 then '  ' when l_orderkey % 101 = 0 then null
 else concat('INV', cast(l_orderkey as varchar)) end as invoice,
 case l_orderkey % 7 when 0 then strftime({DATE}, '%Y-%m-%d') when 1 then strftime({DATE}, '%d-%m-%Y')
 when 2 then strftime({DATE}, '%m/%d/%Y') when 3 then strftime({DATE}, '%d/%m/%Y')
 when 4 then strftime({DATE}, '%Y/%m/%d') when 5 then 'not-a-date' end as "orderDate",
 case when l_orderkey % 11 = 0 then 'nan' else concat('10:15:', lpad(cast(l_orderkey % 60 as varchar), 2, '0'), '.123') end as time,
 cast(l_partkey as varchar) as "productId", {PRODUCT} as "productName",
 cast(890000000000 + l_partkey as varchar) as barcode,
 case when l_linenumber = 7 then '0' when l_partkey % 53 = 0 then '-1' when l_partkey % 59 = 0 then 'abc'
 else cast(l_quantity as varchar) end as quantity,
 case when l_suppkey % 41 = 0 then concat('-', cast({PRICE} as varchar)) when l_suppkey % 43 = 0 then 'nan'
 else cast({PRICE} as varchar) end as "totalProductPrice",
 cast(cast(p_retailprice as decimal(18,4)) as varchar) as "costPrice", p_brand as "brandName",
 p_type as "categoryName", split_part(p_name, ' ', 2) as "subCategoryOf",
 case when n_nationkey = 0 then 'Head Office' else n_name end as "storeName",
 case when l_linenumber % 2 = 0 then 'offline' else 'online' end as "orderType" from {JOINS})"""

STOCK = f"""stock as (select n_name as "storeName", {PRODUCT} as "productName", p_brand as brand,
 p_type as "categoryName", s_name as "vendorName",
 cast((p_partkey * 7 + n_nationkey * 13) % 60 - 5 as double) as quantity,
 cast(p_retailprice as double) as "sellingPrice", p_retailprice * 0.7 as "costPrice", p_partkey as row_no
 from part cross join nation
 left join supplier on s_suppkey = p_partkey % (select count(*) from supplier))"""

RTV = f"""rtv as (select concat('RTV', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as "rtvId",
 {DATE} as "Date", s_name as "vendorName", l_partkey as "productId", {PRODUCT} as "productName",
 cast(l_quantity as double) as quantity, cast(p_retailprice as double) as price,
 cast(cast(l_quantity as decimal(18,2)) * cast(p_retailprice as decimal(18,2)) as decimal(18,4)) as "totalAmount",
 case l_partkey % 5 when 0 then 'Expired' when 1 then ' Damaged ' when 2 then 'Slow moving' when 3 then '' end as description,
 n_name as "storeName"
 from {JOINS} left join supplier on l_suppkey = s_suppkey where l_returnflag = 'R')"""

PARTNERS = """partners as (select n_name as "storeName", concat('p', cast(n_nationkey as varchar), '@example.test') as email,
 case when n_nationkey % 10 = 9 then null when n_nationkey % 2 = 0 then concat('+00 100-', cast(1000 + n_nationkey as varchar))
 else concat('(00) 100 ', cast(1000 + n_nationkey as varchar)) end as wa_number,
 case n_nationkey % 3 when 0 then null when 1 then '  '
 else concat(' https://reports.example.test/', cast(n_nationkey as varchar)) end as pdf_link from nation)"""

BRAND_SALES = """brand_sales as (select "brandName" as brandname, count(distinct invoice) as nooforders,
 sum("totalProductPrice") as sales,
 cast(round(cast(cast(sum("totalProductPrice") as double) / count(distinct invoice) as decimal(30,8)), 2) as double) as aov,
 "orderDate" as orderdate from billing group by 1, 5)"""
STORE_SALES = BRAND_SALES.replace("brand_sales", "store_sales").replace('"brandName" as brandname', '"storeName" as storename').replace(
    "nooforders", "nooforder")
CATEGORY_SALES = """category_sales as (select "subCategoryOf" as subcategoryof, sum("totalProductPrice") as sales,
 "orderDate" as orderdate from billing group by 1, 3)"""
PRODUCT_SALES = """product_sales as (select "productName" as productname, count(distinct invoice) as nooforders,
 sum("totalProductPrice") as sales, cast(sum(quantity) as bigint) as quantitysold, "orderDate" as orderdate
 from billing group by 1, 5)"""


def with_(*ctes) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def rounded(x: str, n: int = 2) -> str:
    return f"cast(round(cast({x} as decimal(30,8)), {n}) as double)"


def ratio(a: str, b: str, n: int = 2) -> str:
    return rounded(f"cast({a} as double) / nullif(cast({b} as double), 0)", n)


def pct(c: str, p: str) -> str:
    return f"(cast({c} as double) - cast({p} as double)) / nullif(cast({p} as double), 0) * 100"


def direction(c: str, p: str) -> str:
    return f"coalesce(cast(sign({pct(c, p)}) as int), 0)"
