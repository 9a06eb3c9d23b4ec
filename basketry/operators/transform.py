"""Typing of the sales fact, renames and small column-level reshapes."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions import clean
from basketry.operators.staging import stage
from basketry.operators.validate import SalesDataError
from basketry.schemas import (
    BIGINT_COLUMNS, INTEGER_COLUMNS, MONEY_COLUMNS, NUMERIC_COLUMNS, SALES_COLUMNS, sales_type)


def _typed(column: str) -> Column:
    if column == "orderDate":
        return clean.parse_order_date(column)
    if column == "time":
        return clean.clean_time(column)
    if column in INTEGER_COLUMNS:
        return clean.coerce_int(column)
    if column in BIGINT_COLUMNS:
        return clean.coerce_bigint(column)
    if column in NUMERIC_COLUMNS:
        return clean.coerce_double(column)
    if column in MONEY_COLUMNS:
        return clean.coerce_money(column)
    return clean.clean_string(column)


def sales_columns(df: DataFrame, known: dict[str, Column] = None) -> list[Column]:
    """The columns of the sales fact, typed from the text columns that there are; ``known`` has those that are typed already."""
    typed = lambda c: known[c] if c in (known or {}) else _typed(c)
    return [(typed(c) if c in df.columns else F.lit(None)).cast(sales_type(c)).alias(c) for c in SALES_COLUMNS]


def transform_sales(df: DataFrame) -> DataFrame:
    """Text columns to the typed sales fact in one projection; unknown columns are dropped."""
    return df.select(*sales_columns(df))


def conform_schema(df: DataFrame) -> DataFrame:
    """Fixed columns and order without changing values; missing columns are null."""
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast(sales_type(c)).alias(c) for c in SALES_COLUMNS])


def resolve_rules(rules) -> dict[str, str]:
    """Final name of each old name after all rules ran in order, each on the result of the last.

    Read backwards, what becomes of a rule's new name is known when the rule is met.
    """
    names = {}
    for old, new in reversed(list(rules)):
        names[old] = names.get(new, new)
    return names


def resolve_rule_table(rules: DataFrame) -> DataFrame:
    """(old, new) as ``resolve_rules`` gives them, of a table (seq, old, new) of any size; seq is a unique integer.

    Each rule is linked to the next later rule on its new name. Links are doubled until no chain goes on. A null or
    repeated seq is an error, since the order of such rules is not known.
    """
    rules = stage(rules.select(F.col("seq").cast("long").alias("seq"), "old", "new"))
    if not rules.groupBy("seq").count().where("count > 1 or seq is null").isEmpty():
        raise SalesDataError("seq of the rename rules holds a null or a number twice")
    rule = lambda name, target: rules.select(F.col(name).alias("name"), "seq", target.cast("long").alias("rule"), F.lit(name).alias("kind"))
    later = Window.partitionBy("name").orderBy(F.col("seq").desc()).rangeBetween(Window.unboundedPreceding, -1)
    events = rule("old", F.col("seq")).unionByName(rule("new", F.lit(None)))
    links = stage(events.withColumn("next", F.min("rule").over(later)).where("kind = 'new'").select("seq", "next"))
    while not links.join(links.select(F.col("seq").alias("next"), F.col("next").alias("after")), "next").where("after is not null").isEmpty():
        onward = links.select(F.col("seq").alias("next"), F.col("next").alias("after"))
        links = stage(links.join(onward, "next", "left").select("seq", F.coalesce("after", "next").alias("next")))
    ends = rules.select(F.col("seq").alias("next"), F.col("new").alias("last"))
    solved = rules.join(links, "seq").join(ends, "next", "left").select("seq", "old", F.coalesce("last", "new").alias("new"))
    return solved.groupBy("old").agg(F.min_by("new", "seq").alias("new"))


def rename_lookup(spark, rules) -> DataFrame:
    """(old, new) of the names that change, from a list of (old, new) or a DataFrame (seq, old, new) of any size."""
    if isinstance(rules, DataFrame):
        return resolve_rule_table(rules).where("old <> new")
    changed = [(old, new) for old, new in resolve_rules(rules).items() if old != new]
    return spark.createDataFrame(changed, "old string, new string")


def rename_values(df: DataFrame, column: str, rules) -> DataFrame:
    """Exact-match renames. ``rules`` is a list of (old, new) or a DataFrame (seq, old, new) of any size.

    Chains are resolved once on the rules, not on the data; the optimiser picks the join by the size of the result.
    """
    lookup = rename_lookup(df.sparkSession, rules).select(F.col("old").alias(column), F.col("new").alias("__new"))
    return (
        df.join(lookup, column, "left")
        .withColumn(column, F.coalesce("__new", column)).select(*df.columns))


def rename_products(df: DataFrame, rules, column: str = "productname") -> DataFrame:
    return rename_values(df, column, rules)


def rename_stores(df: DataFrame, rules, column: str = "storename") -> DataFrame:
    return rename_values(df, column, rules)


def standardise_columns(df: DataFrame) -> DataFrame:
    """Columns renamed by what their name contains; two columns for one name are an error."""
    wanted = [("Product Name", ("product",)), ("Sales", ("price", "sales")), ("Quantity Sold", ("qty", "quantity"))]
    mapping = {}
    for column in df.columns:
        text = column.strip().lower()
        target = next((name for name, parts in wanted if any(p in text for p in parts)), None)
        if target:
            mapping[column] = target
    if len(set(mapping.values())) < len(mapping):
        raise SalesDataError(f"several columns stand for the same name: {mapping}")
    return df.withColumnsRenamed(mapping)


def zero_fill_numeric(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: clean.zero_fill(c) for c in columns if c in df.columns})
