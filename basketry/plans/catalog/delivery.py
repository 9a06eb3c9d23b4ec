"""Delivery and run tables."""

from pyspark.sql import functions as F

from basketry.operators import delivery
from basketry.operators.staging import scratch_path
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import BILLING, PARTNERS, with_
from basketry.sinks.tables import append_tracking
from basketry.sources import star


def _reports(s, d):
    """Reports exist for the stores that sold on the last day."""
    sold = star.billing(s, d, ["storeName", "orderDate"]).where(F.col("orderDate") == F.lit(star.LAST_DAY))
    return sold.select("storeName").distinct().select(delivery.report_name("weekly").alias("report_name"))


_SOLD = """sold as (select distinct replace("storeName", ' ', '_') || '_weekly_report' as report_name from billing
 where "orderDate" = date '2024-04-30')"""
query("delivery_manifest", lambda s, d: delivery.delivery_manifest(star.partners(s, d), _reports(s, d), "weekly"),
      with_(BILLING, PARTNERS, _SOLD) + """select "storeName", email, replace("storeName", ' ', '_') || '_weekly_report' as report_name,
 'Weekly Store Report - ' || "storeName" as subject, replace("storeName", ' ', '_') || '_weekly_report' in (select report_name from sold) as found
 from partners""")
query("unsent_dates", lambda s, d: delivery.unsent_dates(
    star.table(s, d, "orders").select(F.to_date("o_orderdate").alias("report_date")),
    star.table(s, d, "events").select(F.date_sub(F.to_date("ts"), 365 * 28).alias("report_date"))),
      """select distinct cast(o_orderdate as date) as report_date from orders
 where cast(o_orderdate as date) not in (select cast(ts as date) - 365 * 28 from events where ts is not null) and o_orderdate is not null""")
query("report_links", lambda s, d: delivery.report_links(star.partners(s, d)),
      with_(PARTNERS) + """select "storeName", 'whatsapp:' || case when starts_with(x, '+') then '' else '+' end || x as wa_number, trim(pdf_link) as pdf_link,
 'Weekly Store Report — ' || "storeName" || chr(10) || 'Your weekly performance report is ready: ' || trim(pdf_link) || chr(10)
 || 'This link is valid for 7 days.' as message
 from (select *, regexp_replace(wa_number, '[\\s\\-()]', '', 'g') as x from partners) where wa_number is not null and trim(pdf_link) <> ''""")
query("etl_rows_loaded", lambda s, d: delivery.etl_rows_loaded(
    {name: star.table(s, d, name) for name in ("lineitem", "orders", "customer", "part")}),
      " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in ("lineitem", "orders", "customer", "part")))

# The event stream table stands in for the run log and for the tracking log.


def _runs(s, d):
    return star.table(s, d, "events").select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("store"), F.col("event_type").alias("report_type"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"),
        F.col("value").cast("decimal(18,4)").alias("duration_seconds"))


_RUNS = """runs as (select 'S' || cast(user_id as varchar) as store, event_type as report_type,
 case when event_type = 'error' then 'failure' else 'success' end as status, cast(value as decimal(18,4)) as duration_seconds from events)"""
query("store_run_status", lambda s, d: delivery.store_run_status(_runs(s, d)),
      with_(_RUNS) + """select store, report_type, status, count(*) as reports, cast(sum(duration_seconds) as double) as total_seconds,
 cast(max(duration_seconds) as double) as longest_seconds from runs group by 1, 2, 3""")
query("stores_processed", lambda s, d: delivery.stores_processed(_runs(s, d)),
      with_(_RUNS) + "select report_type, status, count(distinct store) as stores from runs group by 1, 2")


def _tracking(s, d):
    return star.table(s, d, "events").select(
        F.col("user_id").cast("string").alias("recipient"), F.to_date("ts").alias("report_date"), F.col("event_type").alias("event"))


def _appended(s, d):
    path = scratch_path(s, "tracking")
    events = _tracking(s, d)
    append_tracking(events.where("event = 'error'"), path)
    append_tracking(events.where("event <> 'error'"), path)
    return s.read.parquet(path)


query("append_tracking", _appended, """select cast(user_id as varchar) as recipient, cast(ts as date) as report_date, event_type as event
 from events where event_type is not null""")
query("delivery_counts", lambda s, d: delivery.delivery_counts(_tracking(s, d)),
      "select event_type as event, count(*) as messages, count(distinct cast(user_id as varchar)) as recipients from events group by 1")
