"""Named queries beside their SQL on the smallest tables. tools/check_queries.py runs all of them."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import rows_of

CHECKED = [
    "brand_sales", "brand_daily", "product_monthly", "weekly_product", "weekly_comparison", "validation_report",
    "transform_sales", "headline_signal", "gem_candidates", "stock_alerts", "dominant_pattern", "rtv_top_reason",
    "rename_products", "consolidate_sales", "compare_thresholds_loose", "embedding_clusters_loose", "overwrite_dates",
    "upsert_snapshot", "delivery_manifest", "daily_load", "decode_report_payloads", "read_sales_csv", "read_store_csv_dir",
    "overwrite_aggregates", "analyze_groups", "consolidation_impact", "similar_products_loose",
]


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, db, name):
    df = entry.queries()[name](spark, sf_dir)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
