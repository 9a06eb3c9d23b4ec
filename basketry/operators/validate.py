"""Validation rules of the sales load. Counts come from one pass; nothing is collected per row."""

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.clean import coerce_money, date_readings, first_reading, is_blank, reading_name, DATE_SHAPES
from basketry.schemas import REQUIRED_AGGREGATE_COLUMNS


class SalesDataError(ValueError):
    """A load that must stop."""


def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SalesDataError(f"missing columns {missing}; available columns {df.columns}")
    return df


def _number(c: str) -> Column:
    return F.col(c).try_cast("double")


def rule_negative_price(c: str = "totalProductPrice") -> Column:
    return F.coalesce(_number(c) < 0, F.lit(False))


def rule_nonpositive_quantity(c: str = "quantity") -> Column:
    return F.coalesce(_number(c) <= 0, F.lit(False))


def rule_blank_invoice(c: str = "invoice") -> Column:
    return is_blank(c)


RULES = {
    "negative_price": ("totalProductPrice", rule_negative_price),
    "nonpositive_quantity": ("quantity", rule_nonpositive_quantity),
    "blank_invoice": ("invoice", rule_blank_invoice),
}


def active_rules(df: DataFrame) -> dict[str, Column]:
    """Rules whose column exists."""
    return {name: rule(column) for name, (column, rule) in RULES.items() if column in df.columns}


def _any_rule(df: DataFrame) -> Column:
    failed = F.lit(False)
    for condition in active_rules(df).values():
        failed = failed | condition
    return failed


def validation_metrics(df: DataFrame, failed: Column = None) -> list[Column]:
    """Total, dropped and remaining rows and the flagged count of each rule, as aggregates. ``failed`` is a column with the
    names of ``failed_rules``, if there is one."""
    rules = active_rules(df)
    bad = _any_rule(df)
    if failed is not None:
        rules, bad = {name: F.array_contains(failed, name) for name in rules}, F.size(failed) > 0
    return [
        F.count("*").alias("total_rows"),
        F.count_if(bad).alias("dropped_rows"),
        F.count_if(~bad).alias("remaining_rows"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()]]


def validation_report(df: DataFrame) -> DataFrame:
    """One row: total, dropped and remaining rows and the flagged count of each rule."""
    return df.agg(*validation_metrics(df))


def validation_samples(df: DataFrame, n: int = 5) -> DataFrame:
    """Up to n bad values per rule. Each rule stops reading once it has its sample."""
    parts = [
        df.where(rule).select(F.lit(name).alias("rule"), F.col(RULES[name][0]).cast("string").alias("value")).limit(n)
        for name, rule in active_rules(df).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def drop_invalid(df: DataFrame) -> DataFrame:
    return df.where(~_any_rule(df))


def failed_rules(df: DataFrame) -> Column:
    """Names of the rules that a row fails."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in active_rules(df).items()]))


def quarantine(df: DataFrame) -> DataFrame:
    """Rows that fail a rule, with the names of the failed rules."""
    return df.where(_any_rule(df)).withColumn("failed_rules", failed_rules(df))


def guard_not_empty(df: DataFrame, what: str = "sales") -> DataFrame:
    if df.isEmpty():
        raise SalesDataError(f"no valid {what} rows left")
    return df


def aggregate_input_profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count(coerce_money("totalProductPrice")).alias("numeric_prices"),
        F.count("orderDate").alias("dated_rows"))


def validate_agg_input(df: DataFrame) -> DataFrame:
    """Stop unless there are rows with a numeric price and rows with a date; returns the counts."""
    require_columns(df, REQUIRED_AGGREGATE_COLUMNS)
    profile = aggregate_input_profile(df)
    counts = profile.first()
    for column in ("total_rows", "numeric_prices", "dated_rows"):
        if counts[column] == 0:
            raise SalesDataError(f"aggregate input has no {column}")
    return profile


def numeric_price_only(df: DataFrame) -> DataFrame:
    return df.withColumn("totalProductPrice", coerce_money("totalProductPrice")).where("totalProductPrice is not null")


def exclude_store(df: DataFrame, store: str) -> DataFrame:
    """All rows but those of one store; rows without a store name stay."""
    require_columns(df, ["storeName"])
    return df.where(~F.col("storeName").eqNullSafe(F.lit(store)))


def exclusion_report(df: DataFrame, store: str) -> DataFrame:
    excluded = F.col("storeName").eqNullSafe(F.lit(store))
    return df.agg(
        F.count("*").alias("total_rows"), F.count_if(excluded).alias("excluded_rows"),
        F.count_if(~excluded).alias("used_rows"))


def assert_store_absent(df: DataFrame, column: str, store: str) -> DataFrame:
    """Stop if the store is still there."""
    if not df.where(F.col(column) == F.lit(store)).isEmpty():
        raise SalesDataError(f"{store} is still in {column}")
    return df


def profile_metrics(columns, of=F.col, keep: Column = None) -> list[Column]:
    """Row count, dated and timed rows, and the null count of every column, of the rows to keep, as aggregates."""
    keep = F.lit(True) if keep is None else keep
    return [
        F.count_if(keep).alias("total_rows"), F.count_if(keep & of("orderDate").isNotNull()).alias("order_date_not_null"),
        F.count_if(keep & of("time").isNotNull()).alias("time_not_null"),
        *[F.count_if(keep & of(c).isNull()).alias(f"null_{c}") for c in columns]]


def load_profile(df: DataFrame) -> DataFrame:
    """One row: row count, dated and timed rows, and the null count of every column."""
    return df.agg(*profile_metrics(df.columns))


def date_format_metrics(c: str = "orderDate", dates=None) -> list[Column]:
    """Counts of what each pattern parses by itself, and of what parses at all. ``dates`` is a column with the struct of
    ``date_readings``, if there is one."""
    dates = date_readings(c) if dates is None else dates
    counts = [
        F.count(dates[reading_name(pattern)]).alias(f"fmt_{reading_name(pattern)}")
        for _, patterns in DATE_SHAPES for pattern in patterns]
    return [F.count(c).alias("not_null"), *counts, F.count(first_reading(dates)).alias("parsed")]


def date_format_profile(df: DataFrame, c: str = "orderDate") -> DataFrame:
    """How many values each date pattern parses by itself, and how many parse at all."""
    return df.agg(*date_format_metrics(c))


def date_format_samples(df: DataFrame, c: str = "orderDate", n: int = 10) -> DataFrame:
    return df.select(c).dropna().limit(n)
