"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "transform_sales", "validation_report", "overwrite_dates",
    "brand_sales", "store_sales", "product_sales", "brand_daily", "product_daily", "store_monthly", "product_monthly",
    "weekly_brand", "weekly_product", "weekly_comparison", "monthly_product", "monthly_financials", "inject_stock",
    "intelligence_summary", "headline_signal", "stock_alerts", "stock_insight_bullets_by_product", "rtv_top_vendors",
    "similar_pairs_loose", "group_products_loose", "consolidate_sales", "cluster_rollup", "embedding_clusters",
    "fuzzy_name_clusters",
]


def main():
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("basketry-bench")
        .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from basketry.plans import catalog

    found, times = catalog.queries(), {}
    wanted = sys.argv[1:] or HEADLINE
    found["unique_stores"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in wanted:
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
