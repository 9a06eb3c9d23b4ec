"""Data behind report delivery and run monitoring."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from basketry.functions.clean import normalise_phone
from basketry.functions.names import strip_space


def report_name(period: str):
    return F.concat(F.replace("storeName", F.lit(" "), F.lit("_")), F.lit(f"_{period}_report"))


def delivery_manifest(partners: DataFrame, reports: DataFrame, period: str, month_label: str = None) -> DataFrame:
    """Each partner with the expected report, the mail subject and whether the report exists.

    ``reports`` has one column, report_name.
    """
    subject = F.concat(F.lit("Weekly Store Report - "), F.col("storeName"))
    if period == "monthly":
        subject = F.concat(F.lit("Monthly Performance Report - "), F.col("storeName"), F.lit(f" ({month_label})"))
    present = reports.select("report_name").distinct().withColumn("found", F.lit(True))
    return (
        partners.withColumn("report_name", report_name(period)).join(present, "report_name", "left")
        .select("storeName", "email", "report_name", subject.alias("subject"),
                F.coalesce("found", F.lit(False)).alias("found")))


def unsent_dates(reports: DataFrame, ledger: DataFrame, date_col: str = "report_date") -> DataFrame:
    return reports.select(date_col).distinct().join(ledger.select(date_col), date_col, "left_anti")


def report_links(partners: DataFrame) -> DataFrame:
    """Partners with a number and a link, with the message that carries the link."""
    link = strip_space("pdf_link")
    return partners.dropna(subset=["wa_number", "pdf_link"]).where(link != "").select(
        "storeName", normalise_phone("wa_number").alias("wa_number"), link.alias("pdf_link"),
        F.format_string("Weekly Store Report — %s\nYour weekly performance report is ready: %s\nThis link is "
                        "valid for 7 days.", F.col("storeName"), link).alias("message"))


def etl_rows_loaded(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def store_run_status(runs: DataFrame) -> DataFrame:
    """Reports and time by store, type and status from a run log."""
    return runs.groupBy("store", "report_type", "status").agg(
        F.count("*").alias("reports"), F.sum("duration_seconds").alias("total_seconds"),
        F.max("duration_seconds").alias("longest_seconds"))


def stores_processed(runs: DataFrame) -> DataFrame:
    return runs.groupBy("report_type", "status").agg(F.count_distinct("store").alias("stores"))


def delivery_counts(tracking: DataFrame) -> DataFrame:
    return tracking.groupBy("event").agg(
        F.count("*").alias("messages"), F.count_distinct("recipient").alias("recipients"))
