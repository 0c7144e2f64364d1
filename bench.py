"""Benchmark: the medallion flow at one scale factor, one JSON line out.

raw tables -> cleaned/pre-aggregated -> wide table written partitioned by
month (silver) -> gold KPIs and quality reports read from that silver table,
as a deployment runs them. Each step is forced with the ``noop`` sink (full
evaluation, nothing collected).

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ordermart.catalog import spark_queries as SQ  # noqa: E402
from ordermart.operators import kpis, quality, wide  # noqa: E402
from ordermart.plans import sinks  # noqa: E402
from ordermart.session import local_session  # noqa: E402
from ordermart.sources.adapter import SourceTables  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="ordermart-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # warm-up (JVM, JIT, class loading, file listing), not timed: one join +
    # aggregation over the two largest tables
    li, od = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), spark.read.parquet(f"{sf_dir}/orders.parquet")
    run(li.join(od, li.l_orderkey == od.o_orderkey).groupBy("o_custkey")
        .agg(F.sum("l_extendedprice"), F.countDistinct(F.md5(F.col("l_orderkey").cast("string")))))

    src = SourceTables(spark, sf_dir)
    silver_path = f"{sinks.scratch_root(spark)}/bench-{uuid.uuid4().hex}/silver/final_df"
    timed("wide_build_write", lambda: sinks.write_wide(wide.build_wide(src), silver_path))
    final = spark.read.parquet(silver_path)

    gold = {
        "k06_seller_revenue": lambda: kpis.seller_revenue(final),
        "k09_top_products": lambda: kpis.top_products(final),
        "k10_top_customers_rows": lambda: kpis.top_customers_by_rows(final),
        "k11_top_customers_spend": lambda: kpis.top_customers_by_spend(final),
        "k12_rank": lambda: kpis.top_rows_per_seller(spark, silver_path, 5),
        "k13_dense_rank": lambda: kpis.top_rows_per_seller(spark, silver_path, 5, dense=True),
        "k14_seller_scorecard": lambda: kpis.seller_scorecard(final),
        "k15_product_scorecard": lambda: kpis.product_scorecard(final),
        "k16_retention": lambda: kpis.customer_retention(final),
        "k17_state_volume": lambda: kpis.state_volume(final),
        "k18_row_count": lambda: kpis.row_count(final),
        "k17_month_pruned": lambda: kpis.state_volume(final.filter(F.col("order_year_month") == "1998-06")),
        "dq_nulls_final": lambda: quality.null_profile(final, "final"),
        "dq_having_dupes": lambda: quality.orders_per_key_having(spark, final),
    }
    for name, build in gold.items():
        timed(name, lambda b=build: run(b()))

    raw = ["k20_customer_spend", "k21_aov_segment", "dq_join_reconcile", "dq_duplicates", "dq_nulls",
           "dq_reconcile", "clean_products_size", "payments_per_order", "reviews_per_order"]
    for name in raw:
        timed(name, lambda n=name: run(SQ.QUERIES[n](spark, sf_dir)))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    sinks.clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
