"""Customer spend and average-order-value (AOV) segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import stats

SEGMENT_KEY = "order_customer_id_customer_segmented"


def customer_spend(item_rows: DataFrame, customer: str = "order_customer_id") -> DataFrame:
    """Per customer over item-grain rows: row count (``total_orders``, the
    original's name for it), cent total, mean item price (``AOV``), and the
    plain orders beside them: ``distinct_orders`` and revenue per order
    (``avg_order_value``)."""
    return _with_order_value(item_rows.groupBy(customer).agg(
        F.count("order_id").alias("total_orders"),
        C.money_sum("price").alias("total_spent"),
        C.money_avg("price").alias("AOV"),
        F.countDistinct("order_id").alias("distinct_orders"),
    ))


def _with_order_value(spend: DataFrame) -> DataFrame:
    value = F.try_divide(F.col("total_spent").cast("decimal(20,2)"), F.col("distinct_orders"))
    return spend.withColumn("avg_order_value", F.round(value, 2).cast("double"))


def customer_spend_from_orders(orders_clean: DataFrame, items_clean: DataFrame,
                               fanout: DataFrame | None = None, largest_order: bool = False) -> DataFrame:
    """The same figures as ``customer_spend`` over the wide table, computed
    from a narrow path: items collapse to one row per order (map-side), meet
    ``(order_id, customer)`` and collapse again per customer. ``fanout``
    ``(order_customer_id, k)`` weights customers whose wide rows are
    repeated k times (geolocation fan-out). ``largest_order`` adds the item
    rows of the customer's largest order, and a row without a customer for
    the items that have no order."""
    per_order = items_clean.filter(F.col("item_order_id").isNotNull()).groupBy(C.pack_id("item_order_id").alias("item_order_id")).agg(
        F.count("*").alias("_rows"), F.count("price").alias("_priced"), C.money_total("price").alias("_sum"))
    j = (orders_clean.select(C.pack_id("order_id").alias("order_id"), "order_customer_id")
         .join(per_order, F.col("order_id") == F.col("item_order_id"), "right" if largest_order else "inner"))
    k = F.lit(1)
    if fanout is not None:
        j = j.join(fanout, "order_customer_id", "left")
        k = F.coalesce(F.col("k"), F.lit(1))
    agg = j.groupBy("order_customer_id").agg(
        F.sum(F.col("_rows") * k).alias("total_orders"),
        F.sum(F.col("_sum") * k).cast("decimal(28,2)").alias("_spent"),
        F.sum(F.col("_priced") * k).alias("_priced"),
        F.countDistinct("item_order_id").alias("distinct_orders"),     # the key that the joined rows are dealt by
        *([F.max("_rows").alias("largest_order")] if largest_order else []),
    )
    aov = F.round(F.try_divide(F.col("_spent"), F.col("_priced")), 2).cast("double")
    return _with_order_value(agg.select("order_customer_id", "total_orders",
                                        F.col("_spent").cast("double").alias("total_spent"), aov.alias("AOV"),
                                        "distinct_orders", *(["largest_order"] if largest_order else [])))


def segment_customers(spend: DataFrame, approximate: bool = False) -> DataFrame:
    """Add ``aov_segment`` from the 25th/75th AOV percentiles (exact by
    default, an in-plan scalar; ``approximate`` uses a bounded sketch)."""
    quant = stats.approx_quantiles if approximate else stats.quantiles
    low, high = quant(spend, "AOV", (0.25, 0.75))
    return spend.withColumn("aov_segment", C.aov_band("AOV", low, high))


def segments_for_join(segmented: DataFrame) -> DataFrame:
    return segmented.select(F.col("order_customer_id").alias(SEGMENT_KEY), "total_orders", "total_spent", "AOV",
                            "aov_segment")
