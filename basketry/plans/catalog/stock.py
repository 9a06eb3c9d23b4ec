"""Stock signals of all stores."""

from pyspark.sql import functions as F

from basketry.operators import stock
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import PARTNERS, STOCK, rounded, with_
from basketry.sources import star

_STATUS = """status as (select *, case when quantity < 0 then 'NEGATIVE' when quantity = 0 then 'OUT'
 when quantity <= 5 then 'LOW' else 'OK' end as status from stock)"""
BASE = (STOCK, _STATUS)


def on_stock(operator, *args):
    return lambda s, d: operator(star.stock(s, d), *args)


query("classify_stock", lambda s, d: stock.classify_stock(star.stock(s, d)).select("storeName", "row_no", "quantity", "status"),
      with_(*BASE) + 'select "storeName", row_no, quantity, status from status')
query("stock_counts", on_stock(stock.stock_counts), with_(*BASE) + """select "storeName", count(*) as total_skus,
 count_if(status = 'NEGATIVE') as neg_count, count_if(status = 'OUT') as oos_count, count_if(status = 'LOW') as low_count
 from status group by 1""")


def _groups(status, column, measures, top=10):
    return f"""select "storeName", "{column}", count("productName") as sku_count, {measures},
 row_number() over (partition by "storeName" order by count("productName") desc, "{column}") as position
 from status where status = '{status}' and "{column}" is not null group by "storeName", "{column}" qualify position <= {top}"""


_RISK = (f"""min(quantity) as min_qty, {rounded('avg("sellingPrice")')} as avg_selling_price,
 {rounded('sum("sellingPrice")')} as total_value_at_risk""")
_NEGATIVE = (f"""{rounded("min(quantity)")} as min_qty, {rounded("sum(quantity)")} as total_qty,
 {rounded('avg("sellingPrice")')} as avg_selling_price""")
for column, suffix in (("brand", ""), ("categoryName", "_by_category")):
    query("oos_groups" + suffix, on_stock(stock.oos_groups, column), with_(*BASE) + _groups("OUT", column, _RISK))
    query("low_groups" + suffix, on_stock(stock.low_groups, column), with_(*BASE) + _groups("LOW", column, _RISK))
    query("negative_groups" + suffix, on_stock(stock.negative_groups, column), with_(*BASE) + _groups("NEGATIVE", column, _NEGATIVE))


def _items(status, by_price, n):
    lead = '"sellingPrice" desc nulls last' if by_price else "quantity"
    return f"""select "storeName", "productName", brand, "categoryName", quantity, "sellingPrice", "vendorName",
 row_number() over (partition by "storeName" order by {lead}, "productName", quantity, "vendorName", brand, "sellingPrice") as position
 from status where status = '{status}' qualify position <= {n}"""


query("negative_products", on_stock(stock.negative_products), with_(*BASE) + _items("NEGATIVE", False, 10))
query("high_value_oos", on_stock(stock.high_value_oos), with_(*BASE) + _items("OUT", True, 5))
query("product_oos_top", on_stock(stock.product_oos_top), with_(*BASE) + _items("OUT", True, 10))
query("product_low_top", on_stock(stock.product_low_top), with_(*BASE) + _items("LOW", True, 8))


def _dominant(source):
    return f"""select "storeName", kind, pattern, sku_count from (
 select "storeName", 'brand' as kind, brand as pattern, count(*) as sku_count from ({source}) where brand <> '' group by 1, 3
 union all select "storeName", 'vendor', "vendorName", count(*) from ({source}) where "vendorName" <> '' group by 1, 3)
 where sku_count >= 3 qualify row_number() over (partition by "storeName" order by kind, sku_count desc, pattern) = 1"""


_ALERT = _dominant("select * from status where status = 'NEGATIVE'")
_REPORT = f"""select * from (select *, 'NEGATIVE' as status from ({_dominant(_items("NEGATIVE", False, 10))})
 union all select *, 'OUT' from ({_dominant(_items("OUT", True, 10))})) qualify row_number() over (partition by "storeName" order by status) = 1"""
query("dominant_pattern", on_stock(stock.alert_pattern), with_(*BASE) + f"select *, 'NEGATIVE' as status from ({_ALERT})")
query("dominant_pattern_in_report", on_stock(stock.report_pattern), with_(*BASE) + _REPORT)


def _bullets(parts):
    return " union all ".join(
        f"""select "storeName", {priority} as priority, {position} as position, '{kind}' as kind, {text} as text from ({source}) where {condition}"""
        for priority, kind, text, source, condition, position in parts)


def _dim_bullets(column):
    q = f'"{column}"'
    return _bullets([
        (1, "NEGATIVE", f"printf('%s: %d SKU(s) with negative stock (worst: %.0f units)', {q}, sku_count, min_qty)",
         _groups("NEGATIVE", column, _NEGATIVE), "position <= 3", "position"),
        (2, "OUT", f"printf('%s: %d SKU(s) out of stock (₹%s at risk)', {q}, sku_count, cast(cast(round(cast(total_value_at_risk as decimal(30,8)), 0) as bigint) as varchar))",
         _groups("OUT", column, _RISK), "position <= 2", "position"),
        (3, "LOW", f"printf('%s: %d SKU(s) with ≤5 units (min %.0f units)', {q}, sku_count, min_qty)",
         _groups("LOW", column, _RISK), "position <= 2", "position"),
        (4, "HIGH_VALUE", f"printf('%s (%s, ₹%s): out of stock', \"productName\", {q}, cast(cast(round(cast(\"sellingPrice\" as decimal(30,8)), 0) as bigint) as varchar))",
         _items("OUT", True, 5), "position <= 1", "position"),
    ])


_PRICE = "cast(cast(round(cast(\"sellingPrice\" as decimal(30,8)), 0) as bigint) as varchar)"
_COUNTS = """select "storeName", count_if(status = 'NEGATIVE') as neg_count, count_if(status = 'LOW') as low_count from status group by 1"""
_PRODUCT = _bullets([
    (1, "NEGATIVE", "printf('%s (qty %.0f, vendor: %s): negative stock', \"productName\", quantity, \"vendorName\")",
     _items("NEGATIVE", False, 10), "position <= 3", "position"),
    (2, "NEGATIVE_TOTAL", "printf('%d SKUs have negative stock', neg_count)", _COUNTS, "neg_count > 3", "1"),
    (3, "OUT", f"printf('%s (₹%s, vendor: %s): out of stock', \"productName\", {_PRICE}, \"vendorName\")",
     _items("OUT", True, 10), "position <= 2", "position"),
    (4, "LOW", f"printf('%s (qty %.0f, ₹%s, vendor: %s): low', \"productName\", quantity, {_PRICE}, \"vendorName\")",
     _items("LOW", True, 8), "position <= 2", "position"),
    (5, "PATTERN", "case when status = 'NEGATIVE' then printf('%s: %d SKUs with negative stock', pattern, sku_count) "
     "else printf('%s: %d SKUs out of stock', pattern, sku_count) end", _REPORT, "true", "1"),
])
query("stock_insight_bullets", on_stock(stock.stock_insight_bullets, "brand"), with_(*BASE) + _dim_bullets("brand"))
query("stock_insight_bullets_by_category", on_stock(stock.stock_insight_bullets, "categoryName"), with_(*BASE) + _dim_bullets("categoryName"))
query("stock_insight_bullets_by_product", on_stock(stock.stock_insight_bullets, "productName"), with_(*BASE) + _PRODUCT)

_ALERT_ROWS = _bullets([
    (1, "NEGATIVE_BRAND", "printf('%s: %d SKU(s), worst qty %d', brand, sku_count, cast(min_qty as bigint))",
     _groups("NEGATIVE", "brand", _NEGATIVE), "position <= 3", "position"),
    (2, "NEGATIVE_PRODUCT", "printf('%s (qty %d, vendor: %s)', \"productName\", cast(quantity as bigint), \"vendorName\")",
     _items("NEGATIVE", False, 5), "true", "position"),
    (3, "PATTERN", "printf('%s has %d negative-stock SKUs', pattern, sku_count)", _ALERT, "true", "1"),
    (4, "NEGATIVE_TOTAL", "printf('Total negative-stock SKUs: %d', neg_count)", _COUNTS, "neg_count > 0", "1"),
    (5, "LOW_BRAND", "printf('%s: %d SKU(s), min %d unit(s)', brand, sku_count, cast(min_qty as bigint))",
     _groups("LOW", "brand", _RISK), "position <= 3", "position"),
    (6, "LOW_PRODUCT", f"printf('%s (qty %d, ₹%s, vendor: %s)', \"productName\", cast(quantity as bigint), {_PRICE}, \"vendorName\")",
     _items("LOW", True, 5), "true", "position"),
    (7, "LOW_TOTAL", "printf('Total low-stock SKUs: %d', low_count)", _COUNTS, "low_count > 0", "1"),
])
query("stock_alert_rows", on_stock(stock.stock_alert_rows), with_(*BASE) + _ALERT_ROWS)
query("stock_alerts", lambda s, d: stock.stock_alerts(star.stock(s, d), star.partners(s, d)),
      with_(*BASE, PARTNERS) + f"""select m."storeName", 'whatsapp:' || case when starts_with(x, '+') then '' else '+' end || x as wa_number, message
 from (select "storeName", string_agg(text, chr(10) order by priority, position) as message from ({_ALERT_ROWS}) group by 1) m
 join (select "storeName", regexp_replace(wa_number, '[\\s\\-()]', '', 'g') as x from partners where wa_number is not null) p
 on p."storeName" = m."storeName\"""")
