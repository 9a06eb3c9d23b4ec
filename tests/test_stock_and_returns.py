"""Stock and return-to-vendor signals."""

import datetime as dt

import pytest

from basketry.operators import returns, stock, store_reports

SCHEMA = ("storeName string, productName string, brand string, categoryName string, quantity double, "
          "sellingPrice double, costPrice double, vendorName string, row_no bigint")


def rows(spark, items):
    base = dict(storeName="S", productName="Oat biscuits", brand="Hillside", categoryName="Pantry", quantity=34.0,
                sellingPrice=80.0, costPrice=52.5, vendorName="Northern Mills")
    full = [{**base, **item, "row_no": i} for i, item in enumerate(items)]
    order = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(float(r[c]) if c == "quantity" else r[c] for c in order) for r in full], SCHEMA)


def test_counts_and_boundaries(spark):
    df = rows(spark, [{"quantity": q} for q in (9, -3, 0, 1, 5, 7, -8, 0, 0, 2)])
    counts = stock.stock_counts(df).first()
    assert counts["neg_count"] == 2 and sorted(counts[1:]) == [2, 3, 3, 10]


@pytest.mark.parametrize("quantity, status", [(5, "LOW"), (6, "OK"), (0, "OUT"), (-1, "NEGATIVE"), (0.5, "LOW")])
def test_status(spark, quantity, status):
    assert stock.classify_stock(rows(spark, [{"quantity": quantity}])).first()["status"] == status


def test_all_in_stock_gives_nothing(spark):
    df = rows(spark, [{"quantity": 20}, {"quantity": 50}])
    assert stock.stock_counts(df).first()[1:] == (2, 0, 0, 0)
    for dim in ("brand", "categoryName", "productName"):
        assert stock.stock_insight_bullets(df, dim).count() == 0


def test_empty_stock(spark):
    assert stock.oos_groups(rows(spark, [{}]).where("false")).count() == 0


def test_groups(spark):
    item = lambda brand, quantity, product, price=80.0: {
        "brand": brand, "quantity": quantity, "productName": product, "sellingPrice": price}
    df = rows(spark, [
        item("Alpine", -4, "Rye bread"), item("Brook", -3, "Milk"), item("Alpine", -6, "Oat bread"), item(None, 0, "Salt"),
        item("Alpine", 0, "Butter"), item("Brook", 0, "Cream"), item("Alpine", 0, "Cheese", 240.0)])
    negative = {r["brand"]: r for r in stock.negative_groups(df).collect()}
    assert (negative["Alpine"]["min_qty"], negative["Alpine"]["total_qty"], negative["Alpine"]["position"]) == (-6.0, -10.0, 1)
    missing = stock.oos_groups(df).orderBy("position").collect()
    assert [(r["brand"], r["sku_count"], r["total_value_at_risk"]) for r in missing] == [("Alpine", 2, 320.0), ("Brook", 1, 80.0)]
    assert stock.high_value_oos(df).orderBy("position").first()["productName"] == "Cheese"
    assert stock.negative_products(df).orderBy("position").first()["productName"] == "Oat bread"


def test_category_dimension(spark):
    df = rows(spark, [{"categoryName": "Drinks", "quantity": 0}, {"categoryName": "Drinks", "quantity": 0}, {"categoryName": "Snacks", "quantity": 3}])
    assert stock.oos_groups(df, "categoryName").first()["categoryName"] == "Drinks"
    assert stock.low_groups(df, "categoryName").first()["categoryName"] == "Snacks"


def test_group_lists_are_cut_at_ten(spark):
    df = rows(spark, [{"brand": f"B{i:02}", "quantity": 0} for i in range(15)])
    assert stock.oos_groups(df).count() == 10


def test_pattern_prefers_brand_then_vendor(spark):
    brand = rows(spark, [{"quantity": -1, "brand": "A", "vendorName": f"V{i}"} for i in range(3)])
    assert tuple(stock.alert_pattern(brand).select("kind", "pattern", "sku_count").first()) == ("brand", "A", 3)
    vendor = rows(spark, [{"quantity": -1, "brand": f"B{i}", "vendorName": "V"} for i in range(3)])
    assert stock.alert_pattern(vendor).first()["kind"] == "vendor"
    assert stock.alert_pattern(rows(spark, [{"quantity": -1}, {"quantity": -2}])).count() == 0


def test_pattern_scopes_differ(spark):
    """The report looks at its ten listed rows, the alert at all negative rows."""
    items = [{"quantity": -100 - i, "brand": f"B{i}", "vendorName": f"V{i}"} for i in range(10)]
    items += [{"quantity": -1, "brand": "A", "vendorName": f"W{i}"} for i in range(3)]
    df = rows(spark, items)
    assert stock.alert_pattern(df).first()["pattern"] == "A"
    assert stock.report_pattern(df).count() == 0


def test_alerts_only_for_stores_with_trouble(spark):
    df = rows(spark, [{"storeName": "Bad", "quantity": -2}, {"storeName": "Good", "quantity": 50}])
    partners = spark.createDataFrame([("Bad", "98 76"), ("Good", "1"), ("Bad", None)], "storeName string, wa_number string")
    found = stock.stock_alerts(df, partners).collect()
    assert [(r["storeName"], r["wa_number"]) for r in found] == [("Bad", "whatsapp:+9876")]
    assert "Total negative-stock SKUs: 1" in found[0]["message"]


def test_stock_lookup_takes_the_last_row(spark):
    df = rows(spark, [{"quantity": 4}, {"quantity": 7}])
    lookup = {r["dim"]: r["current_stock"] for r in store_reports.stock_lookup(df).collect()}
    assert lookup == {"brandName": 11.0, "categoryName": 11.0, "productName": 7.0}


def test_returns(spark):
    schema = ("storeName string, Date date, vendorName string, productName string, quantity double, price double, "
              "totalAmount double, description string")
    day = dt.date(2024, 4, 30)
    df = spark.createDataFrame([
        ("S", day, "V1", "P1", 2.0, 10.0, 20.0, " Damaged "), ("S", day, "V2", "P2", 1.0, 50.0, 50.0, "Expired"),
        ("S", day, None, "P3", 3.0, 30.0, 90.0, "Damaged"), ("S", day - dt.timedelta(days=1), "V1", "P4", 1.0, 1.0, 1.0, "")], schema)
    assert returns.rtv_summary(df).first()[1:] == (4, 7, 161.0)
    assert [r["vendorName"] for r in returns.rtv_top_vendors(df).orderBy("position").collect()] == ["V2", "V1"]
    assert returns.rtv_top_products(df).orderBy("position").first()["vendorName"] == "unknown"
    assert tuple(returns.rtv_top_reason(df).first())[1:] == ("Damaged", 2)
    assert returns.rtv_for_day(df, day, day).count() == 3
