"""Intelligence signals and recommendation facts over the weekly rows of all stores and dimensions."""

from pyspark.sql import functions as F

from basketry.operators import recommend, signals
from basketry.operators.trends import KEY
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import pct, rounded
from basketry.plans.catalog.stores import CHANGES, WEEKLY, weekly_rows

_W = 'partition by "storeName", period_start, dim'
_SCORED = f"""figures as (select *, row_number() over ({_W} order by sales desc nulls last, name) as sales_rank,
 cast(sum(cast(sales as decimal(28,4))) over ({_W}) as double) as group_sales, avg(margin) over ({_W}) as avg_margin,
 max(margin) over ({_W}) as max_margin, median(contrib) over ({_W}) as median_contrib from changes),
 scored as (select *, {rounded('''(case when group_sales > 0 then sales / group_sales else 0 end) *
 (1 - case when coalesce(max_margin, 1) > 0 then coalesce(margin, 0) / coalesce(max_margin, 1) else 0 end) * 100''')} as risk_score from figures)"""
SCORED = WEEKLY + ",\n" + CHANGES + ",\n" + _SCORED

_QTY_PCT = f"case when prev_qty > 0 then {pct('qty', 'prev_qty')} end"
_SALES_PCT = f"case when prev_sales > 0 then {pct('sales', 'prev_sales')} end"
_RULES = {
    "top10_by_revenue": ("true", "sales_rank", 10),
    "bottom5_by_quantity": ("qty > 0", "qty, name", 5),
    "low_margin_items": ("margin < least(avg_margin, 15)", "margin, name", 5),
    "hidden_margin_gems": ("sales_rank > 10", "margin desc nulls last, name", 3),
    "high_risk_items": ("true", "risk_score desc nulls last, name", 3),
    "mix_risk_items": ("contrib > median_contrib and margin < avg_margin", "sales_rank", 3),
    "anomaly_negative_margin": ("margin < 0", "sales_rank", None),
    "anomaly_single_unit": ("qty = 1", "sales_rank", None),
    "trend_declining": ("sales_change < -10", "sales_change, sales_rank", 3),
    "trend_margin_shifts": (f"abs({rounded('margin - prev_margin')}) >= 3", "sales_rank", 3),
    "predict_stockout_risk": (f"sales_rank <= 5 and {_QTY_PCT} > 20", "qty_change desc, sales_rank", 3),
    "predict_margin_erosion": ("prev_margin > 0 and margin_shift < -3", "margin_shift, sales_rank", 3),
    "predict_rising_stars": (f"sales_rank > 5 and {_SALES_PCT} > 25", "sales_change desc, sales_rank", 3),
}
_KEY = '"storeName", period_start, dim, name'


def _signal_sql(name):
    condition, order, size = _RULES[name]
    limit = f"qualify position <= {size}" if size else ""
    return f"""select {_KEY}, row_number() over ({_W} order by {order}) as position, sales, qty, margin, contrib,
 sales_change, qty_change, margin_shift, risk_score from scored where {condition} {limit}"""


def current_rows(s, d):
    return weekly_rows(s, d)[0]


def _signal(s, d, name):
    rows, previous = weekly_rows(s, d)
    return signals.signal(rows, name, previous)


for name in _RULES:
    query(name, lambda s, d, name=name: _signal(s, d, name), SCORED + "\n" + _signal_sql(name))

_FIGURES = f"""select "storeName", period_start, dim, {rounded("avg(case when qty > 0 then qty end)", 1)} as avg_qty_sold,
 {rounded("avg(margin)")} as avg_margin_pct,
 case when max(group_sales) > 0 then {rounded("sum(case when sales_rank <= 1 then sales end) / max(group_sales) * 100", 1)} else 0 end as top1_revenue_share_pct,
 case when max(group_sales) > 0 then {rounded("sum(case when sales_rank <= 3 then sales end) / max(group_sales) * 100", 1)} else 0 end as top3_revenue_share_pct
 from scored group by 1, 2, 3"""


def _pick(*columns):
    return lambda s, d: signals.group_figures(current_rows(s, d)).select("storeName", "period_start", "dim", *columns)


query("avg_qty_sold", _pick("avg_qty_sold"), SCORED + f'\nselect "storeName", period_start, dim, avg_qty_sold from ({_FIGURES})')
query("avg_margin_pct", _pick("avg_margin_pct"), SCORED + f'\nselect "storeName", period_start, dim, avg_margin_pct from ({_FIGURES})')
query("revenue_concentration", _pick("top1_revenue_share_pct", "top3_revenue_share_pct", "concentration_flag"),
      SCORED + f"""\nselect "storeName", period_start, dim, top1_revenue_share_pct, top3_revenue_share_pct,
 top3_revenue_share_pct > 50 as concentration_flag from ({_FIGURES})""")
query("risk_score", lambda s, d: signals.scored(current_rows(s, d)).select(*KEY, "sales", "margin", "risk_score"),
      SCORED + f"\nselect {_KEY}, sales, margin, risk_score from scored")


def _summary(s, d):
    """The summary with each JSON list reduced to its names in order."""
    summary = signals.intelligence_summary(*weekly_rows(s, d))
    names_of = lambda c: F.array_join(F.from_json(c, F.lit("array<struct<name:string>>"))["name"], "|")
    return summary.withColumns({name: names_of(name) for name in _RULES})


_LISTS = ", ".join(
    f"""coalesce((select string_agg(name, '|' order by position) from ({_signal_sql(name)}) x where x."storeName" = f."storeName"
 and x.period_start = f.period_start and x.dim = f.dim), '') as {name}""" for name in _RULES)
query("intelligence_summary", _summary, SCORED + f"""\nselect f.*, top3_revenue_share_pct > 50 as concentration_flag,
 exists (select 1 from scored c where c."storeName" = f."storeName" and c.period_start = f.period_start and c.dim = f.dim
 and prev_sales is not null) as has_matched_trend, {_LISTS} from ({_FIGURES}) f""")

# Recommendation facts.

query("reserved_top2", lambda s, d: recommend.reserved_top2(current_rows(s, d)),
      SCORED + f"\nselect {_KEY}, sales_rank, sales, margin from scored where sales_rank <= 2")
_LISTED = ("listed as (select *, 1 as list_no, position as place from (" + _signal_sql("low_margin_items")
           + ") union all select *, 2, position from (" + _signal_sql("high_risk_items") + ")), "
           "reserved as (select * from scored where sales_rank <= 2), "
           f"candidates as (select l.* replace (row_number() over ({_W} order by list_no, place) as position) from listed l "
           'where not exists (select 1 from reserved r where r."storeName" = l."storeName" and r.period_start = l.period_start '
           "and r.dim = l.dim and r.name is not distinct from l.name))")
query("margin_risk_candidates", lambda s, d: recommend.margin_risk_candidates(current_rows(s, d)),
      SCORED + ",\n" + _LISTED + f"""\nselect {_KEY}, position, case list_no when 1 then 'low_margin' else 'high_risk' end as source,
 sales, margin, risk_score from candidates where position <= 5""")
query("gem_candidates", lambda s, d: recommend.gem_candidates(current_rows(s, d)),
      SCORED + ",\n" + _LISTED + ",\n gems as (" + _signal_sql("hidden_margin_gems") + f""")
 select {_KEY}, row_number() over ({_W} order by position) as position, sales, qty, margin from gems g
 where not exists (select 1 from candidates c where c.position = 1 and c."storeName" = g."storeName" and c.period_start = g.period_start
 and c.dim = g.dim and c.name is not distinct from g.name) qualify position <= 3""".replace("order by position) as position", "order by g.position) as position"))
query("margin_action_band", lambda s, d: signals.scored(current_rows(s, d)).select(
    *KEY, "margin", recommend.margin_action_band("margin", True).alias("leader_band"),
    recommend.margin_action_band("margin", False).alias("risk_band")),
      SCORED + f"""\nselect {_KEY}, margin, case when margin > 30 then 'over_30' when margin between 15 and 30 then '15_to_30'
 when margin < 15 then 'under_15' end as leader_band, case when margin < 0 then 'negative' when margin < 5 then '0_to_5'
 when margin < 10 then '5_to_10' when margin < 15 then '10_to_15' end as risk_band from scored""")
query("quantity_action_band", lambda s, d: signals.scored(current_rows(s, d)).select(
    *KEY, "qty", F.when(F.col("dim") == "productName", recommend.quantity_action_band("qty", True)).otherwise(
        recommend.quantity_action_band("qty")).alias("band")),
      SCORED + f"""\nselect {_KEY}, qty, case when dim = 'productName' and qty = 1 then 'single'
 when dim = 'productName' and qty <= 5 then '2_to_5' when qty <= 5 then 'up_to_5' when qty <= 15 then '6_to_15'
 when qty <= 40 then '16_to_40' when qty <= 80 then '41_to_80' end as band from scored""")
query("contrib_action_band", lambda s, d: signals.scored(current_rows(s, d)).where("dim = 'categoryName'").select(
    *KEY, "contrib", recommend.contrib_action_band("contrib").alias("band")),
      SCORED + f"""\nselect {_KEY}, contrib, case when contrib > 20 then 'over_20' when contrib >= 10 then '10_to_20'
 when contrib < 10 then 'under_10' end as band from scored where dim = 'categoryName'""")
_HITS = " union all ".join(
    f"select *, {i} as priority, '{name}' as signal from ({_signal_sql(name)}) where position = 1"
    for i, name in enumerate(recommend.HEADLINES, 1))
query("headline_signal", lambda s, d: recommend.headline_signal(*weekly_rows(s, d)),
      SCORED + f""",\n hits as ({_HITS})
 select {_KEY}, priority, signal, sales_change, qty_change, margin_shift, contrib, margin from hits
 qualify row_number() over ({_W} order by priority) = 1""")
query("concentration_label", lambda s, d: recommend.concentration_label(current_rows(s, d)),
      SCORED + f"""\nselect "storeName", period_start, dim, top3_revenue_share_pct, top3_revenue_share_pct > 50 as concentration_flag,
 case when top3_revenue_share_pct > 50 then printf('Top 3 = %.1f%% of revenue — over-concentration', top3_revenue_share_pct)
 else printf('Healthy spread — top 3 = %.1f%% of revenue', top3_revenue_share_pct) end as label from ({_FIGURES})""")
