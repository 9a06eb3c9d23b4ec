"""Return-to-vendor signals of all stores."""

import datetime as dt

from basketry.operators import returns
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import RTV, with_
from basketry.sources import star


def on_rtv(operator):
    return lambda s, d: operator(star.rtv(s, d))


query("rtv_summary", on_rtv(returns.rtv_summary), with_(RTV) + """select "storeName", count(*) as total_returns,
 cast(sum(quantity) as bigint) as total_qty, cast(sum("totalAmount") as double) as total_value from rtv group by 1""")
query("rtv_top_vendors", on_rtv(returns.rtv_top_vendors), with_(RTV) + """select "storeName", "vendorName", count("productName") as lines,
 cast(sum(quantity) as bigint) as qty, cast(sum("totalAmount") as double) as value,
 row_number() over (partition by "storeName" order by sum("totalAmount") desc, "vendorName") as position
 from rtv where "vendorName" is not null group by 1, 2 qualify position <= 2""")
query("rtv_top_products", on_rtv(returns.rtv_top_products), with_(RTV) + """select "storeName", "productName", cast(quantity as bigint) as quantity,
 price, cast("totalAmount" as double) as "totalAmount", coalesce("vendorName", 'unknown') as "vendorName",
 row_number() over (partition by "storeName" order by "totalAmount" desc, "productName", coalesce("vendorName", 'unknown'), quantity, price) as position
 from rtv qualify position <= 3""")
query("rtv_top_reason", on_rtv(returns.rtv_top_reason), with_(RTV) + """select "storeName", trim(description) as reason, count(*) as occurrences
 from rtv where trim(description) <> '' group by 1, 2
 qualify row_number() over (partition by "storeName" order by count(*) desc, trim(description)) = 1""")
query("rtv_for_day", lambda s, d: returns.rtv_for_day(star.rtv(s, d), dt.date(2024, 4, 30), dt.date(2024, 4, 30)).select(
    "rtvId", "Date", "storeName", "productName", "quantity", "totalAmount", "description"),
      with_(RTV) + """select "rtvId", "Date", "storeName", "productName", quantity, cast("totalAmount" as double) as "totalAmount", description
 from rtv where "Date" between date '2024-04-30' and date '2024-04-30'""")
