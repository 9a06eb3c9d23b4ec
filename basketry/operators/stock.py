"""Stock signals per store. Group keys that are null are left out; every top list is cut per store
before its shuffle, so a store with very many products is no bottleneck."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.clean import normalise_phone, rounded
from basketry.operators.serial import top_per_group
from basketry.operators.staging import stage

LOW_STOCK_THRESHOLD = 5
GROUP_TOP = 10
PATTERN_MIN = 3
NEGATIVE, OUT, LOW, OK = "NEGATIVE", "OUT", "LOW", "OK"


def classify_stock(stock: DataFrame, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    q = F.col("quantity")
    status = F.when(q < 0, NEGATIVE).when(q == 0, OUT).when((q > 0) & (q <= threshold), LOW).otherwise(OK)
    return stock.withColumn("status", status)


def stock_counts(stock: DataFrame, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    return classify_stock(stock, threshold).groupBy("storeName").agg(
        F.count("*").alias("total_skus"), count(NEGATIVE).alias("neg_count"), count(OUT).alias("oos_count"),
        count(LOW).alias("low_count"))


def _with_status(stock: DataFrame, status: str, threshold: float) -> DataFrame:
    return classify_stock(stock, threshold).where(F.col("status") == status)


def _top_groups(rows: DataFrame, group_col: str, measures) -> DataFrame:
    grouped = rows.where(F.col(group_col).isNotNull()).groupBy("storeName", group_col).agg(
        F.count("productName").alias("sku_count"), *measures)
    return top_per_group(grouped, "storeName", [F.col("sku_count").desc(), F.col(group_col)], GROUP_TOP, "position")


def _at_risk(rows: DataFrame, group_col: str) -> DataFrame:
    return _top_groups(rows, group_col, [
        F.min("quantity").alias("min_qty"), rounded(F.avg("sellingPrice")).alias("avg_selling_price"),
        rounded(F.sum("sellingPrice")).alias("total_value_at_risk")])


def oos_groups(stock: DataFrame, group_col: str = "brand", threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _at_risk(_with_status(stock, OUT, threshold), group_col)


def low_groups(stock: DataFrame, group_col: str = "brand", threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _at_risk(_with_status(stock, LOW, threshold), group_col)


def negative_groups(stock: DataFrame, group_col: str = "brand", threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _top_groups(_with_status(stock, NEGATIVE, threshold), group_col, [
        rounded(F.min("quantity")).alias("min_qty"), rounded(F.sum("quantity")).alias("total_qty"),
        rounded(F.avg("sellingPrice")).alias("avg_selling_price")])


_ITEM = ["productName", "brand", "categoryName", "quantity", "sellingPrice", "vendorName"]


def _top_items(stock: DataFrame, status: str, by_price: bool, n: int, threshold: float) -> DataFrame:
    rows = _with_status(stock, status, threshold).select("storeName", *_ITEM)
    lead = F.col("sellingPrice").desc_nulls_last() if by_price else F.col("quantity").asc()
    ties = [F.col(c).asc_nulls_last() for c in ("productName", "quantity", "vendorName", "brand", "sellingPrice")]
    return top_per_group(rows, "storeName", [lead, *ties], n, "position")


def negative_products(stock: DataFrame, n: int = 10, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _top_items(stock, NEGATIVE, False, n, threshold)


def high_value_oos(stock: DataFrame, n: int = 5, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _top_items(stock, OUT, True, n, threshold)


def product_oos_top(stock: DataFrame, n: int = 10, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _top_items(stock, OUT, True, n, threshold)


def product_low_top(stock: DataFrame, n: int = 8, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    return _top_items(stock, LOW, True, n, threshold)


def dominant_pattern(items: DataFrame) -> DataFrame:
    """Per store the most frequent brand with three rows or more, else the most frequent such vendor."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    counted = [
        items.where(filled(c)).groupBy("storeName", F.lit(kind).alias("kind"), F.col(c).alias("pattern"))
        .agg(F.count("*").alias("sku_count"))
        for kind, c in (("brand", "brand"), ("vendor", "vendorName"))]
    frequent = counted[0].unionByName(counted[1]).where(F.col("sku_count") >= PATTERN_MIN)
    order = [F.col("kind"), F.col("sku_count").desc(), F.col("pattern")]
    return top_per_group(frequent, "storeName", order, 1)


def alert_pattern(stock: DataFrame, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    """Pattern over all negative rows, as used by the alert."""
    return dominant_pattern(_with_status(stock, NEGATIVE, threshold)).withColumn("status", F.lit(NEGATIVE))


def report_pattern(stock: DataFrame, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    """Pattern over the ten listed negative products; over the ten listed missing ones only without the first."""
    negative = dominant_pattern(negative_products(stock, threshold=threshold)).withColumn("status", F.lit(NEGATIVE))
    missing = dominant_pattern(product_oos_top(stock, threshold=threshold)).withColumn("status", F.lit(OUT))
    return top_per_group(negative.unionByName(missing), "storeName", [F.col("status")], 1)


def _bullet(rows: DataFrame, priority: int, kind: str, text: Column, position="position") -> DataFrame:
    return rows.select(
        "storeName", F.lit(priority).alias("priority"), F.col(position).alias("position"), F.lit(kind).alias("kind"),
        text.alias("text"))


def _troubled(stock: DataFrame, threshold: float) -> DataFrame:
    """The rows that are not in order, staged: every part of an alert reads them, none reads the rest."""
    rows = classify_stock(stock, threshold).where(F.col("status") != OK)
    return stage(rows.select("storeName", *_ITEM))


def stock_insight_bullets(stock: DataFrame, dim: str, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    """Ordered alert lines per store for 'brand', 'categoryName' or 'productName'."""
    stock = _troubled(stock, threshold)
    if dim == "productName":
        return _product_bullets(stock, threshold)
    first = lambda df, n: df.where(F.col("position") <= n)
    text = F.format_string
    high = high_value_oos(stock, threshold=threshold)
    parts = [
        _bullet(first(negative_groups(stock, dim, threshold), 3), 1, NEGATIVE, text(
            "%s: %d SKU(s) with negative stock (worst: %.0f units)", dim, "sku_count", "min_qty")),
        _bullet(first(oos_groups(stock, dim, threshold), 2), 2, OUT, text(
            "%s: %d SKU(s) out of stock (₹%.0f at risk)", dim, "sku_count", "total_value_at_risk")),
        _bullet(first(low_groups(stock, dim, threshold), 2), 3, LOW, text(
            f"%s: %d SKU(s) with ≤{threshold:.0f} units (min %.0f units)", dim, "sku_count", "min_qty")),
        _bullet(first(high, 1), 4, "HIGH_VALUE", text(
            "%s (%s, ₹%.0f): out of stock", "productName", F.coalesce(F.col(dim), F.lit("nan")), "sellingPrice")),
    ]
    return reduce(DataFrame.unionByName, parts)


def _product_bullets(stock: DataFrame, threshold: float) -> DataFrame:
    first = lambda df, n: df.where(F.col("position") <= n)
    text, vendor = F.format_string, F.coalesce(F.col("vendorName"), F.lit("nan"))
    counts = stock_counts(stock, threshold).where(F.col("neg_count") > 3).withColumn("position", F.lit(1))
    pattern = report_pattern(stock, threshold).withColumn("position", F.lit(1))
    parts = [
        _bullet(first(negative_products(stock, threshold=threshold), 3), 1, NEGATIVE, text(
            "%s (qty %.0f, vendor: %s): negative stock", "productName", "quantity", vendor)),
        _bullet(counts, 2, "NEGATIVE_TOTAL", text("%d SKUs have negative stock", "neg_count")),
        _bullet(first(product_oos_top(stock, threshold=threshold), 2), 3, OUT, text(
            "%s (₹%.0f, vendor: %s): out of stock", "productName", "sellingPrice", vendor)),
        _bullet(first(product_low_top(stock, threshold=threshold), 2), 4, LOW, text(
            "%s (qty %.0f, ₹%.0f, vendor: %s): low", "productName", "quantity", "sellingPrice", vendor)),
        _bullet(pattern, 5, "PATTERN", F.when(F.col("status") == NEGATIVE, text(
            "%s: %d SKUs with negative stock", "pattern", "sku_count")).otherwise(text(
                "%s: %d SKUs out of stock", "pattern", "sku_count"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def stock_alert_rows(stock: DataFrame, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    """Lines of the alert of each store with negative or low stock; clean stores have none."""
    stock = _troubled(stock, threshold)
    first = lambda df, n: df.where(F.col("position") <= n)
    text = F.format_string
    vendor = F.coalesce(F.col("vendorName"), F.lit("unknown"))
    one = F.lit(1)
    counts = stock_counts(stock, threshold)
    pattern = alert_pattern(stock, threshold).withColumn("position", one)
    parts = [
        _bullet(first(negative_groups(stock, "brand", threshold), 3), 1, "NEGATIVE_BRAND", text(
            "%s: %d SKU(s), worst qty %d", "brand", "sku_count", F.col("min_qty").cast("bigint"))),
        _bullet(negative_products(stock, 5, threshold), 2, "NEGATIVE_PRODUCT", text(
            "%s (qty %d, vendor: %s)", "productName", F.col("quantity").cast("bigint"), vendor)),
        _bullet(pattern, 3, "PATTERN", text("%s has %d negative-stock SKUs", "pattern", "sku_count")),
        _bullet(counts.where("neg_count > 0").withColumn("position", one), 4, "NEGATIVE_TOTAL",
                text("Total negative-stock SKUs: %d", "neg_count")),
        _bullet(first(low_groups(stock, "brand", threshold), 3), 5, "LOW_BRAND", text(
            "%s: %d SKU(s), min %d unit(s)", "brand", "sku_count", F.col("min_qty").cast("bigint"))),
        _bullet(product_low_top(stock, 5, threshold), 6, "LOW_PRODUCT", text(
            "%s (qty %d, ₹%.0f, vendor: %s)", "productName", F.col("quantity").cast("bigint"), "sellingPrice", vendor)),
        _bullet(counts.where("low_count > 0").withColumn("position", one), 7, "LOW_TOTAL",
                text("Total low-stock SKUs: %d", "low_count")),
    ]
    return reduce(DataFrame.unionByName, parts)


def stock_alerts(stock: DataFrame, partners: DataFrame, threshold: float = LOW_STOCK_THRESHOLD) -> DataFrame:
    """One message per partner whose store has negative or low stock. A message has at most 19 lines."""
    lines = F.sort_array(F.collect_list(F.struct("priority", "position", "text")))
    messages = stock_alert_rows(stock, threshold).groupBy("storeName").agg(
        F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("message"))
    contacts = partners.dropna(subset=["wa_number"]).select("storeName", normalise_phone("wa_number").alias("wa_number"))
    return contacts.join(messages, "storeName").select("storeName", "wa_number", "message")
