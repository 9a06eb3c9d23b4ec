"""Current report rows beside the snapshot of the previous period.

Report rows carry (storeName, period_start, dim, name) as key. Snapshot tables carry one dimension
each; ``snapshot_rows`` gives them the same key.
"""

from pyspark.sql import DataFrame, functions as F

from basketry.functions.clean import clean_numeric, rounded
from basketry.functions.labels import pct_change, pct_label

KEY = ["storeName", "period_start", "dim", "name"]
GROUP = ["storeName", "period_start", "dim"]


def snapshot_rows(snapshot: DataFrame, dim: str, period_col: str) -> DataFrame:
    return snapshot.select(
        F.col("storename").alias("storeName"), F.col(period_col).alias("period_start"),
        F.lit(dim).alias("dim"), "name", "total_sales", "quantity_sold", "profit_margin")


def _previous(snapshot: DataFrame, next_period) -> DataFrame:
    zero = F.lit(0.0)
    return snapshot.select(
        "storeName", next_period.alias("period_start"), "dim", "name",
        F.coalesce(F.col("total_sales").cast("double"), zero).alias("prev_sales"),
        F.coalesce(F.col("quantity_sold").cast("bigint"), F.lit(0)).alias("prev_qty"),
        F.coalesce(F.col("profit_margin").cast("double"), zero).alias("prev_margin"))


def wow_previous(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows keyed by the week they are the previous week of, seven days later."""
    return _previous(snapshot, F.date_add("period_start", 7))


def mom_previous(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows keyed by the month they are the previous month of."""
    return _previous(snapshot, F.add_months("period_start", 1))


def _value(rows: DataFrame, column: str):
    """Number in a report column, which may be text with a percent sign."""
    if column not in rows.columns:
        return F.lit(None).cast("double")
    if dict(rows.dtypes)[column] == "string":
        return clean_numeric(column)
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


def numeric_report(rows: DataFrame) -> DataFrame:
    """Report rows with plain numbers: sales, qty (0 when missing), margin and contrib."""
    return rows.select(
        *KEY, _value(rows, "total_sales").alias("sales"),
        F.coalesce(_value(rows, "quantity_sold"), F.lit(0.0)).alias("qty"),
        _value(rows, "profit_margin").alias("margin"), _value(rows, "contrib_percent").alias("contrib"))


def with_changes(numbers: DataFrame, previous: DataFrame) -> DataFrame:
    """Left join to the previous period with the percent and point changes."""
    joined = numbers.join(previous, KEY, "left")
    return joined.withColumns({
        "sales_change": rounded(pct_change("sales", "prev_sales"), 1),
        "qty_change": rounded(pct_change("qty", "prev_qty"), 1),
        "margin_shift": rounded(F.col("margin") - F.col("prev_margin"), 1)})


def enrich_with_trends(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Report rows with sales_change, qty_change (percent) and margin_shift (points); null without a base."""
    return with_changes(numeric_report(rows), previous)


def trend_labels(enriched: DataFrame) -> DataFrame:
    """Changes as text, for example '+20.0%' and '-5.0pp'."""
    return enriched.withColumns({
        "sales_change_label": pct_label("sales_change"), "qty_change_label": pct_label("qty_change"),
        "margin_shift_label": pct_label("margin_shift", "pp")})


def has_trend_data(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """One row per store, period and dimension with a flag for any previous row."""
    groups = rows.select(*GROUP).distinct()
    known = previous.select(*GROUP).distinct().withColumn("has_trend_data", F.lit(True))
    return groups.join(known, GROUP, "left").na.fill(False, ["has_trend_data"])
