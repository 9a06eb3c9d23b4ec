"""The weekly and monthly report job: all stores, all dimensions, with trends, signals and stock."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators import recommend, signals, store_reports as sr, trends
from basketry.operators.staging import stage
from basketry.sinks.tables import overwrite_dates, table_exists, upsert_snapshot

SNAPSHOTS = {"brandName": "brand", "categoryName": "category", "productName": "product"}


def _stored_rows(spark: SparkSession, root: str, kind: str, period_col: str) -> DataFrame | None:
    """Rows of the three snapshot tables of a kind, or None before the first run."""
    found = None
    for dim, label in SNAPSHOTS.items():
        path = f"{root}/{kind}_{label}_snapshot"
        if table_exists(spark, path):
            part = trends.snapshot_rows(spark.read.parquet(path), dim, period_col)
            found = part if found is None else found.unionByName(part)
    return found


def _run(spark: SparkSession, root: str, kind: str, period_col: str, lines: DataFrame, financials: DataFrame,
         comparison: DataFrame, shift, stock: DataFrame | None) -> None:
    rows = stage(sr.dimension_reports(lines))
    stored = _stored_rows(spark, root, kind, period_col)
    previous = None if stored is None else stage(shift(stored))
    groups = stage(signals.signal_groups(rows, previous))
    report = rows
    if stock is None:
        report = report.withColumn("current_stock", F.lit(None).cast("double"))
    else:
        report = report.join(sr.stock_lookup(stock), ["storeName", "dim", "name"], "left")
    tables = {
        "report": report,
        "financials": financials,
        "signals": signals.ranked_signals(groups),
        "figures": signals.group_figures(groups),
        "summary": signals.intelligence_summary(groups),
        "anomalies": signals.anomaly_text(groups),
        "reserved": recommend.reserved_top2(groups),
        "margin_risk": recommend.margin_risk_candidates(groups),
        "gems": recommend.gem_candidates(groups),
        "bands": recommend.action_bands(groups),
        "concentration": recommend.concentration_label(groups),
    }
    if previous is not None:
        tables["headline"] = recommend.headline_signal(groups)
    tables = {name: table.withColumnRenamed("period_start", period_col) for name, table in tables.items()}
    for name, table in tables.items():
        overwrite_dates(table, f"{root}/{kind}_{name}", period_col)
    comparison.write.mode("overwrite").parquet(f"{root}/{kind}_comparison")
    for dim, label in SNAPSHOTS.items():
        incoming = sr.as_snapshot(rows.where(F.col("dim") == dim), "name", period_col)
        upsert_snapshot(incoming, f"{root}/{kind}_{label}_snapshot", ["storename", "name", period_col], period_col)


def run_weekly(spark: SparkSession, lines: DataFrame, root: str, stock: DataFrame = None) -> None:
    """Write the weekly tables of every store; trends come from the snapshots of earlier runs."""
    weeks = stage(sr.store_weeks(lines))
    in_week = sr.week_lines(lines, weeks)
    _run(spark, root, "weekly", "week_start", in_week, sr.weekly_financials(lines, weeks),
         sr.weekly_comparison(lines, weeks), trends.wow_previous, stock)


def run_monthly(spark: SparkSession, lines: DataFrame, root: str, as_of, stock: DataFrame = None) -> None:
    months = stage(sr.store_report_months(lines, as_of))
    in_month = sr.month_lines(lines, months)
    _run(spark, root, "monthly", "month_start", in_month, sr.monthly_financials(lines, months),
         sr.monthly_comparison(lines, months), trends.mom_previous, stock)
