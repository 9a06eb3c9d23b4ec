"""The daily load: raw text in, the fact table and four aggregate tables by day out."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from basketry.functions.clean import date_readings, first_reading
from basketry.operators import aggregates, validate
from basketry.operators.delivery import etl_rows_loaded
from basketry.operators.staging import drop_scratch, scratch_path, shuffles_dropped, stage
from basketry.operators.transform import sales_columns
from basketry.schemas import REQUIRED_SALES_COLUMNS, SALES_COLUMNS
from basketry.sinks.tables import fingerprint_metrics, load_fingerprint, overwrite_aggregates, overwrite_dates, overwrite_load


DATES, FAILED = "__dates", "__failed"


def aggregate_tables(lines: DataFrame) -> dict[str, DataFrame]:
    return {
        "brand_sales": aggregates.brand_sales(lines), "store_sales": aggregates.store_sales(lines),
        "category_sales": aggregates.category_sales(lines), "product_sales": aggregates.product_sales(lines)}


def _one_row(spark: SparkSession, counts: dict) -> DataFrame:
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


def land(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, dict]]:
    """(typed sales, rejected rows, counts) of raw text that is read once.

    The pass that writes typed and rejected rows to ``path`` in the shared folder also observes the counts: fingerprint,
    validation, date formats and nulls. Rules and dates are read once a row, for the counts and the rows, and nulls are
    counted in the columns that there are.
    """
    spark = raw.sparkSession
    seen = {name: Observation() for name in ("fingerprint", "validation", "dates", "profile")}
    text = raw.observe(seen["fingerprint"], *fingerprint_metrics(raw.columns))
    text = text.withColumns({FAILED: validate.failed_rules(raw), DATES: date_readings("orderDate")})
    text = text.observe(seen["validation"], *validate.validation_metrics(raw, F.col(FAILED)))
    text = text.observe(seen["dates"], *validate.date_format_metrics(dates=F.col(DATES)))
    as_text = [(F.col(c) if c in raw.columns else F.lit(None)).cast("string").alias(c) for c in SALES_COLUMNS]
    rows = text.select(
        F.col(FAILED).alias("failed_rules"), F.struct(*sales_columns(raw, {"orderDate": first_reading(F.col(DATES))})).alias("sale"),
        F.when(F.size(FAILED) > 0, F.struct(*as_text)).alias("rejected"))
    valid = F.size("failed_rules") == 0
    there = [c for c in SALES_COLUMNS if c in raw.columns]
    rows = rows.observe(seen["profile"], *validate.profile_metrics(there, lambda c: F.col(f"sale.{c}"), valid))
    rows.write.option("compression", "zstd").parquet(path)
    landed = spark.read.schema(rows.schema).parquet(path)
    counts = {name: observation.get for name, observation in seen.items()}
    profile = counts["profile"]
    for c in SALES_COLUMNS:  # in this order; all rows lack a column that isn't there
        profile[f"null_{c}"] = profile.pop(f"null_{c}", profile["total_rows"])
    return landed.where(valid).select("sale.*"), landed.where(~valid).select("failed_rules", "rejected.*"), counts


def load_sales(spark: SparkSession, raw: DataFrame, root: str, excluded_store: str = None, load_id: str = None) -> DataFrame:
    """Validate, type and load ``raw`` under ``root``; returns (table_name, row_count) of what the load wrote.

    Dated rows replace their days in billing_data and, summed, in the four aggregate tables. Rows without a valid
    date (undated_data), rows that fail a rule (rejected_data), the validation counts (load_validation), the null
    counts (load_profile) and the date formats (load_date_formats) are kept apart for each load. ``load_id`` names the
    source; without one it is made of the rows, so the same load again replaces only its own rows and gives the same
    tables. The raw text is read once. The landed rows and all shuffles go when they have been used.
    """
    validate.require_columns(raw, REQUIRED_SALES_COLUMNS)
    root, landed = root.rstrip("/"), scratch_path(spark, "landed")
    with shuffles_dropped(spark):
        try:
            return _load(spark, raw, root, landed, excluded_store, load_id)
        finally:
            drop_scratch(spark, landed)


def _load(spark: SparkSession, raw: DataFrame, root: str, landed: str, excluded_store: str, load_id: str) -> DataFrame:
    typed, rejected, counts = land(raw, landed)
    load_id = load_id or load_fingerprint(counts["fingerprint"])
    dates = stage(aggregates.dates_in_load(typed))
    validate.guard_not_empty(dates, "dated sales")
    kept = {
        "undated_data": typed.where("orderDate is null"), "rejected_data": rejected,
        "load_validation": _one_row(spark, counts["validation"]), "load_profile": _one_row(spark, counts["profile"]),
        "load_date_formats": _one_row(spark, counts["dates"])}
    kept = {name: overwrite_load(df, f"{root}/{name}", load_id) for name, df in kept.items()}
    overwrite_dates(typed.where("orderDate is not null"), f"{root}/billing_data")

    loaded = spark.read.parquet(f"{root}/billing_data").join(dates, "orderDate", "left_semi")
    names = refresh_aggregates(spark, loaded, root, dates, excluded_store)
    days = dates.select(F.col("orderDate").alias("orderdate"))
    written = {name: spark.read.parquet(f"{root}/{name}").join(days, "orderdate", "left_semi") for name in names}
    if excluded_store is not None:
        validate.assert_store_absent(written["store_sales"], "storename", excluded_store)
    return etl_rows_loaded({"billing_data": loaded, **kept, **written})


def refresh_aggregates(spark: SparkSession, loaded: DataFrame, root: str, dates: DataFrame, excluded_store: str = None) -> list[str]:
    """Write the aggregates of the given days anew from their fact rows; returns the names of the tables."""
    lines = loaded.where("totalProductPrice is not null")
    validate.validate_agg_input(lines)
    if excluded_store is not None:
        lines = validate.exclude_store(lines, excluded_store)
    names = aggregate_tables(lines)
    overwrite_aggregates(names, root, dates.select(F.col("orderDate").alias("orderdate")))
    return list(names)
