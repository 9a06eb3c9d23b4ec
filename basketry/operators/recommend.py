"""Facts behind the recommendations: reserved names, candidates, action bands, headline signal.

``rows`` are report rows or, to have the signals worked out once, their ``signal_groups``.
"""

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.clean import _col
from basketry.operators.signals import group_figures, item_at, scored, signal_groups
from basketry.operators.trends import GROUP, KEY

RESERVED = 2
MARGIN_CANDIDATES = 5
GEM_CANDIDATES = 3


def reserved_top2(rows: DataFrame) -> DataFrame:
    return scored(rows).where(F.col("sales_rank") <= RESERVED).select(*KEY, "sales_rank", "sales", "margin")


def _candidates() -> Column:
    """(list_no, place) of low margins followed by high risks, without reserved names."""
    listed = lambda number, signal: F.transform(
        F.filter(signal, lambda place: place > RESERVED), lambda place: F.struct(F.lit(number).alias("list_no"), place.alias("place")))
    return F.concat(listed(1, "low_margin_items"), listed(2, "high_risk_items"))


def margin_risk_candidates(rows: DataFrame) -> DataFrame:
    """Low margins, then high risks, without reserved names; a name may come from both lists."""
    listed = signal_groups(rows).select(
        *GROUP, "items", F.posexplode(F.slice(_candidates(), 1, MARGIN_CANDIDATES)).alias("at", "candidate"))
    found = listed.select(*GROUP, (F.col("at") + 1).alias("position"), item_at("candidate.place").alias("row"),
                          F.when(F.col("candidate.list_no") == 1, "low_margin").otherwise("high_risk").alias("source"))
    return found.select(*GROUP, "row.name", "position", "source", "row.sales", "row.margin", "row.risk_score")


def gem_candidates(rows: DataFrame) -> DataFrame:
    """Margin gems that are neither reserved nor the first margin-risk candidate."""
    first = F.coalesce(F.get(_candidates(), F.lit(0))["place"], F.lit(0))
    gems = F.filter("hidden_margin_gems", lambda place: (place > RESERVED) & (place != first))
    listed = signal_groups(rows).select(*GROUP, "items", F.posexplode(F.slice(gems, 1, GEM_CANDIDATES)).alias("at", "place"))
    found = listed.select(*GROUP, (F.col("at") + 1).alias("position"), item_at("place").alias("row"))
    return found.select(*GROUP, "row.name", "position", "row.sales", "row.qty", "row.margin")


def margin_action_band(margin, leader: bool) -> Column:
    """Band of a margin; lower bounds are inclusive, and 15 to 30 includes 30."""
    m = _col(margin)
    if leader:
        return F.when(m > 30, "over_30").when(m >= 15, "15_to_30").when(m < 15, "under_15")
    return (F.when(m < 0, "negative").when(m < 5, "0_to_5").when(m < 10, "5_to_10").when(m < 15, "10_to_15"))


def quantity_action_band(qty, product: bool = False) -> Column:
    q = _col(qty)
    lowest = F.when(q == 1, "single").when(q <= 5, "2_to_5") if product else F.when(q <= 5, "up_to_5")
    return lowest.when(q <= 15, "6_to_15").when(q <= 40, "16_to_40").when(q <= 80, "41_to_80")


def contrib_action_band(contrib) -> Column:
    c = _col(contrib)
    return F.when(c > 20, "over_20").when(c >= 10, "10_to_20").when(c < 10, "under_10")


def action_bands(rows: DataFrame) -> DataFrame:
    """Bands of every row: margin as a leader and as a risk, quantity, and contribution for categories."""
    product = F.col("dim") == "productName"
    return scored(rows).select(
        *KEY, margin_action_band("margin", True).alias("leader_band"), margin_action_band("margin", False).alias("risk_band"),
        F.when(product, quantity_action_band("qty", True)).otherwise(quantity_action_band("qty")).alias("quantity_band"),
        F.when(F.col("dim") == "categoryName", contrib_action_band("contrib")).alias("contrib_band"))


HEADLINES = ["predict_stockout_risk", "predict_rising_stars", "predict_margin_erosion", "trend_declining", "mix_risk_items"]


def headline_signal(rows: DataFrame, previous: DataFrame = None) -> DataFrame:
    """The first signal of the priority list that a group has, with its leading row."""
    hit = F.coalesce(*[
        F.when(F.size(s) > 0, F.struct(F.lit(i).alias("priority"), F.lit(s).alias("signal"), item_at(F.get(s, F.lit(0))).alias("row")))
        for i, s in enumerate(HEADLINES, 1)])
    fields = ["sales_change", "qty_change", "margin_shift", "contrib", "margin"]
    found = signal_groups(rows, previous).select(*GROUP, hit.alias("hit")).where("hit is not null")
    return found.select(*GROUP, "hit.row.name", "hit.priority", "hit.signal", *[f"hit.row.{f}" for f in fields])


def concentration_label(rows: DataFrame) -> DataFrame:
    """Share of the three largest names with a verdict and its text."""
    share = F.format_string("%.1f", "top3_revenue_share_pct")
    return group_figures(rows).select(
        *GROUP, "top3_revenue_share_pct", "concentration_flag",
        F.when(F.col("concentration_flag"), F.concat(F.lit("Top 3 = "), share, F.lit("% of revenue — over-concentration")))
        .otherwise(F.concat(F.lit("Healthy spread — top 3 = "), share, F.lit("% of revenue"))).alias("label"))
