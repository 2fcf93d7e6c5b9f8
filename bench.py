"""Times the headline queries; prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the number of threads."""

from __future__ import annotations

import json
import os
import tempfile
import time

from checks import registry
from storeglass.session import build_session

HEADLINE = (
    # the pairs of forms with published numbers
    "q15_orders_in_range", "q19_month_totals_date_part", "q19_month_totals_range", "q20_page_by_offset", "q20_page_by_key",
    "q21_status_totals", "q22_frequent_spenders_join_first", "q22_frequent_spenders_pre_aggregated",
    # reports
    "q02_user_orders", "q04_monthly_category_growth", "q05_product_sales_profile", "q06_category_tree", "q07_cohort_retention",
    "q08_string_profile", "q09_behavior_products", "q11_dashboard_categories", "q13_category_sales", "q14_top_customers",
    "q17_product_sales", "q24_order_lines_auto", "q27_complex_window", "q29_recent_lines", "q31_product_stats",
    "q33_recommendation_score", "q34_daily_summary", "q35_trending", "q36_ratings", "q38_affinity_recommendations",
    "q41_search_products", "q47_order_documents", "q49b_log_time_trend", "q50b_revenue_by_brand",
)
RUNS = 2


def run(job, spark, root: str) -> float:
    """Seconds to build and fully evaluate a query, results thrown away where they arise."""
    begun = time.perf_counter()
    job(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    jobs = registry.queries()
    run(jobs["q01_status_breakdown"], spark, root)  # starts the engine, not measured
    seconds = {name: round(min(run(jobs[name], spark, root) for _ in range(RUNS)), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
