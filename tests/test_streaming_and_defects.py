"""Streaming ingest restart semantics, and DQ reports against the defects
the adapter injects (counts documented for sf0.01)."""

import pytest
from pyspark.sql import functions as F

from ordermart.catalog import spark_queries as SQ
from ordermart.plans import sinks
from ordermart.sources.adapter import SourceTables
from ordermart.streaming import ingest

MID = "/root/testdata/sf0.01"


def test_available_now_ingest_resumes_without_duplicates(spark, small_dir, scratch):
    orders = SourceTables(spark, small_dir).orders
    first = orders.filter(F.col("order_status") == "delivered")
    rest = orders.filter(F.col("order_status") != "delivered")
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    sinks.write_csv(first, f"{landing}/batch=1")
    out1 = ingest.ingest_available(spark, f"{landing}/*", "orders", bronze, ckpt).count()
    assert out1 == first.count()
    # a rerun with no new files adds nothing
    assert ingest.ingest_available(spark, f"{landing}/*", "orders", bronze, ckpt).count() == out1
    # new files are picked up once
    sinks.write_csv(rest, f"{landing}/batch=2")
    out3 = ingest.ingest_available(spark, f"{landing}/*", "orders", bronze, ckpt)
    assert out3.count() == orders.count()
    assert out3.select("order_id").distinct().count() == orders.count()


def test_stateful_cleaners_are_not_streamed(spark, scratch):
    with pytest.raises(ValueError):
        ingest.start_bronze_ingest(spark, f"{scratch}/x", "products", f"{scratch}/y")


def _rows(df):
    return {tuple(r) for r in df.collect()}


def test_quality_reports_find_the_injected_defects(spark):
    assert SQ.QUERIES["clean_reviews_invalid"](spark, MID).count() == 1364
    anti = {r.relation: r.orphan_rows for r in SQ.QUERIES["dq_fk_anti"](spark, MID).collect()}
    assert anti["order_items.seller_id->sellers"] == 577
    nulls = {(r.table_name, r.column_name): r.null_count for r in SQ.QUERIES["dq_nulls"](spark, MID).collect()}
    assert nulls[("order_reviews", "review_score")] == 2500
    assert nulls[("order_reviews", "review_creation_date")] == 1661
    assert nulls[("orders", "order_delivered_customer_date")] == 10326
    dup = {r.column_name: r.count for r in SQ.QUERIES["dq_uniqueness"](spark, MID).collect()
           if r.table_name == "geolocation"}
    assert dup  # repeated latitudes exist by construction
    stages = {r.stage_name: r.output_rows for r in SQ.QUERIES["dq_join_reconcile"](spark, MID).collect()}
    assert nulls[("final", "payment_order_id")] == 24004 and nulls[("final", "review_order_id")] == 12574
    assert stages["orders_items"] == 60000 and stages["geolocation"] == 160412
