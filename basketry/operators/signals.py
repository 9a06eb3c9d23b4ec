"""Risk, trend and prediction signals over the report rows of each store, period and dimension.

A report has at most 100 rows per group, so the rows of a group are gathered into one sorted array whatever the size
of the sales table. Every signal is a filtered and sorted list of places in that array, worked out by higher-order
functions: one shuffle, no window. ``signal_groups`` holds it all and can be staged; every function here takes it
in place of report rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.clean import rounded
from basketry.functions.labels import pct_change
from basketry.operators.trends import GROUP, KEY, numeric_report, with_changes

# Limits of the signals.
LOW_MARGIN_CEILING = 15
CONCENTRATION_LIMIT = 50
DECLINE_LIMIT = -10
MARGIN_SHIFT_LIMIT = 3
STOCKOUT_GROWTH = 20
RISING_GROWTH = 25
EROSION_LIMIT = -3
TOP_FOR_PREDICTION = 5
SIGNAL_SIZES = {
    "top10_by_revenue": 10, "bottom5_by_quantity": 5, "low_margin_items": 5, "hidden_margin_gems": 3,
    "high_risk_items": 3, "mix_risk_items": 3, "anomaly_negative_margin": None, "anomaly_single_unit": None,
    "trend_declining": 3, "trend_margin_shifts": 3, "predict_stockout_risk": 3,
    "predict_margin_erosion": 3, "predict_rising_stars": 3,
}
# End of fixed values.

def _empty_previous(rows: DataFrame) -> DataFrame:
    return rows.select(*KEY, F.lit(0.0).alias("prev_sales"), F.lit(0).cast("bigint").alias("prev_qty"),
                       F.lit(0.0).alias("prev_margin")).where("false")


ROW_FIELDS = ["sales", "qty", "margin", "contrib", "prev_sales", "prev_qty", "prev_margin", "sales_change", "qty_change", "margin_shift"]
UNROUNDED = ["sales_pct", "qty_pct", "margin_points"]
GROUP_FIGURES = ["group_sales", "avg_margin", "max_margin", "median_contrib"]



def _gathered(rows: DataFrame, previous: DataFrame | None) -> DataFrame:
    """One row per group: its figures and ``items``, its rows by sales, each with its rank and risk score."""
    numbers = with_changes(numeric_report(rows), previous if previous is not None else _empty_previous(rows)).withColumns({
        "sales_pct": pct_change("sales", "prev_sales"), "qty_pct": pct_change("qty", "prev_qty"),
        "margin_points": rounded(F.col("margin") - F.col("prev_margin"), 2)})
    fields = ["name", *ROW_FIELDS, *UNROUNDED]
    grouped = numbers.groupBy(*GROUP).agg(
        F.expr(f"sort_array(collect_list(struct(sales is null, -sales, name is null, name, struct({', '.join(fields)}) as row)))").alias("sorted"),
        F.sum(F.col("sales").cast("decimal(28,4)")).cast("double").alias("group_sales"),
        F.avg("margin").alias("avg_margin"), F.max("margin").alias("max_margin"),
        F.percentile("contrib", F.lit(0.5)).alias("median_contrib"))
    best = F.coalesce(F.col("max_margin"), F.lit(1.0))

    def risk(row: Column) -> Column:
        weight = F.when(F.col("group_sales") > 0, row["sales"] / F.col("group_sales")).otherwise(0.0)
        relative = F.when(best > 0, F.coalesce(row["margin"], F.lit(0.0)) / best).otherwise(0.0)
        return rounded(weight * (1 - relative) * 100)

    item = lambda x, i: x["row"].withField("sales_rank", i + 1).withField("risk_score", risk(x["row"]))
    return grouped.select(*GROUP, *GROUP_FIGURES, F.transform("sorted", item).alias("items"))


# Condition and sort keys of each signal over a row x and the figures of its group. A null condition does not hold.
_NAME = ["x.name is null", "x.name"]
SIGNAL_RULES = {
    "top10_by_revenue": ("true", ["x.sales_rank"]),
    "bottom5_by_quantity": ("x.qty > 0", ["x.qty", *_NAME]),
    # least() skips nulls, so an unknown mean has to rule the signal out.
    "low_margin_items": (
        f"avg_margin is not null and x.margin < least(avg_margin, {LOW_MARGIN_CEILING})", ["x.margin", *_NAME]),
    "hidden_margin_gems": ("x.sales_rank > 10", ["x.margin is null", "-x.margin", *_NAME]),
    "high_risk_items": ("true", ["x.risk_score is null", "-x.risk_score", *_NAME]),
    "mix_risk_items": ("x.contrib > median_contrib and x.margin < avg_margin", ["x.sales_rank"]),
    "anomaly_negative_margin": ("x.margin < 0", ["x.sales_rank"]),
    "anomaly_single_unit": ("x.qty = 1", ["x.sales_rank"]),
    "trend_declining": (f"x.sales_change < {DECLINE_LIMIT}", ["x.sales_change", "x.sales_rank"]),
    "trend_margin_shifts": (f"abs(x.margin_points) >= {MARGIN_SHIFT_LIMIT}", ["x.sales_rank"]),
    "predict_stockout_risk": (
        f"x.sales_rank <= {TOP_FOR_PREDICTION} and x.prev_qty > 0 and x.qty_pct > {STOCKOUT_GROWTH}",
        ["-x.qty_change", "x.sales_rank"]),
    "predict_margin_erosion": (
        f"x.prev_margin > 0 and x.margin_shift < {EROSION_LIMIT}", ["x.margin_shift", "x.sales_rank"]),
    "predict_rising_stars": (
        f"x.sales_rank > {TOP_FOR_PREDICTION} and x.prev_sales > 0 and x.sales_pct > {RISING_GROWTH}",
        ["-x.sales_change", "x.sales_rank"]),
}


def _places(signal: str) -> Column:
    """Sales ranks of the rows that have a signal, in its order and cut to its size."""
    condition, keys = SIGNAL_RULES[signal]
    held = f"filter(items, x -> coalesce({condition}, false))"
    places = f"transform(sort_array(transform({held}, x -> struct({', '.join(keys)}, x.sales_rank as place))), x -> x.place)"
    size = SIGNAL_SIZES[signal]
    return F.expr(places if size is None else f"slice({places}, 1, {size})")


def signal_groups(rows: DataFrame, previous: DataFrame = None) -> DataFrame:
    """One row per store, period and dimension: ``items``, the rows by sales, group figures, and for each signal an
    array of the sales ranks of its rows in order. At most 100 rows a group."""
    if "items" in rows.columns:
        return rows
    return _gathered(rows, previous).withColumns({signal: _places(signal) for signal in SIGNAL_SIZES})


def item_at(place) -> Column:
    """The row with a sales rank."""
    return F.get("items", F.col(place) - 1) if isinstance(place, str) else F.get("items", place - 1)


def scored(rows: DataFrame, previous: DataFrame = None) -> DataFrame:
    """Report rows with group figures: sales rank, total, mean and largest margin, median share, risk score."""
    return signal_groups(rows, previous).select(*GROUP, *GROUP_FIGURES, F.inline("items")).drop(*UNROUNDED)


def ranked_signals(rows: DataFrame, previous: DataFrame = None) -> DataFrame:
    """Scored rows with one position column per signal; null where the row does not have the signal."""
    found = signal_groups(rows, previous).select(*GROUP, *GROUP_FIGURES, *SIGNAL_SIZES, F.inline("items")).drop(*UNROUNDED)
    return found.withColumns({
        s: F.expr(f"nullif(cast(array_position({s}, sales_rank) as int), 0)") for s in SIGNAL_SIZES})


def signal(rows: DataFrame, name: str, previous: DataFrame = None) -> DataFrame:
    """Rows that have one signal, with their position."""
    listed = signal_groups(rows, previous).select(*GROUP, "items", F.posexplode(name).alias("at", "place"))
    fields = ["sales", "qty", "margin", "contrib", "sales_change", "qty_change", "margin_shift", "risk_score"]
    row = listed.select(*GROUP, (F.col("at") + 1).alias("position"), item_at("place").alias("row"))
    return row.select(*GROUP, "row.name", "position", *[f"row.{f}" for f in fields])


def anomaly_text(rows: DataFrame) -> DataFrame:
    """Negative margins and single units as text."""
    ranked = ranked_signals(rows)
    texts = F.array_compact(F.array(
        F.when(F.col("anomaly_negative_margin").isNotNull(), F.format_string(
            "%s sells at a loss: margin of %s%% on sales of %,.0f", "name", F.col("margin").cast("string"), "sales")),
        F.when(F.col("anomaly_single_unit").isNotNull(),
               F.format_string("%s sold a single unit", "name"))))
    return ranked.select(*KEY, F.explode(texts).alias("anomaly"))


def _figures() -> list[Column]:
    """Mean quantity and margin and revenue concentration of a group."""
    total = lambda values: f"aggregate({values}, 0D, (a, v) -> a + v)"
    mean = lambda values: F.expr(f"try_divide({total(values)}, size({values}))")
    known = lambda array, field: f"filter(transform({array}, x -> x.{field}), v -> v is not null)"
    sold = "filter(transform(items, x -> x.qty), v -> coalesce(v > 0, false))"
    share = lambda k: F.when(F.col("group_sales") > 0, rounded(
        F.expr(f"{total(known(f'slice(items, 1, {k})', 'sales'))} / group_sales * 100"), 1)).otherwise(0.0)
    return [
        rounded(mean(sold), 1).alias("avg_qty_sold"), rounded(mean(known("items", "margin"))).alias("avg_margin_pct"),
        share(1).alias("top1_revenue_share_pct"), share(3).alias("top3_revenue_share_pct")]


def _concentration(figures: DataFrame) -> DataFrame:
    return figures.withColumn("concentration_flag", F.col("top3_revenue_share_pct") > CONCENTRATION_LIMIT)


def group_figures(rows: DataFrame) -> DataFrame:
    """One row per store, period and dimension: mean quantity and margin, revenue concentration."""
    return _concentration(signal_groups(rows).select(*GROUP, *_figures()))


def intelligence_summary(rows: DataFrame, previous: DataFrame = None) -> DataFrame:
    """One row per store, period and dimension: the group figures and every signal as JSON.

    Each list holds report rows of one group, so it has at most 100 entries.
    """
    fields = ["name", "sales", "qty", "margin", "contrib", "sales_change", "qty_change", "margin_shift", "risk_score"]
    row = ", ".join(f"items[place - 1].{f} as {f}" for f in fields)
    lists = [F.expr(f"to_json(transform({s}, (place, i) -> struct(i + 1 as position, {row})))").alias(s) for s in SIGNAL_SIZES]
    trend = F.exists("items", lambda x: x["prev_sales"].isNotNull()).alias("has_matched_trend")
    return _concentration(signal_groups(rows, previous).select(*GROUP, *lists, trend, *_figures()))
