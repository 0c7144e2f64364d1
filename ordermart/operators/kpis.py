"""Gold-layer KPI queries over the wide table and the source tables.

Every KPI is one aggregation (partial on the executors, final after one
shuffle on its keys); top-k reports end in ``orderBy(..).limit(k)``, which
the planner turns into a per-partition top-k plus a k-row merge, with the
group key as the last sort column so ties resolve the same way every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.quantiles import column_values, exact_quantiles


# --- review scores: per-order lists, or the list-free summary columns ------
def _scored(arr: str = "review_scores") -> Column:
    return F.filter(arr, lambda x: x != C.SENTINEL_SCORE)


def review_score_sum(arr: str = "review_scores") -> Column:
    return F.aggregate(_scored(arr), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def review_score_count(arr: str = "review_scores") -> Column:
    return F.size(_scored(arr))


def _has_lists(df: DataFrame) -> bool:
    return "review_scores" in df.columns


def avg_review(df: DataFrame) -> Column:
    """Mean of all real review scores (the -1 'no score' sentinel excluded)
    over the rows of a group, rounded to 2 decimals."""
    if _has_lists(df):
        total, n = review_score_sum(), review_score_count()
    else:
        total, n = F.col("review_score_sum"), F.col("review_score_n")
    return F.round(F.try_divide(F.sum(total).cast("double"), F.sum(n)), 2)


def review_count(df: DataFrame) -> Column:
    per_row = F.size("review_scores") if _has_lists(df) else F.col("review_count")
    return F.sum(F.coalesce(per_row, F.lit(0))).cast("bigint")


# --- source-table KPIs --------------------------------------------------------
def customers_by_state(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_state", "customer_city").count().orderBy(F.desc("count"))


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").count().orderBy(F.desc("count"))


def payments_by_type(payments: DataFrame) -> DataFrame:
    """Payment rows per (recoded) type."""
    return payments.groupBy("payment_type").count().orderBy(F.desc("count"))


def orders_by_payment_type_set(payments_per_order: DataFrame) -> DataFrame:
    """Orders per set of payment types (the array key rendered as sorted text)."""
    return (payments_per_order.groupBy(C.sorted_text("payment_type").alias("payment_type"))
            .count().orderBy(F.desc("count")))


def product_sales(items: DataFrame, product: str = "product_id") -> DataFrame:
    return (items.groupBy(product).agg(C.money_sum("price").alias("total_sales"))
            .orderBy(F.desc("total_sales")))


def price_summary(items: DataFrame, column: str = "price") -> DataFrame:
    """count, mean, stddev, min, exact quartiles and max (one row)."""
    v, q = F.col("v"), F.col("quantiles")
    found = exact_quantiles(column_values(items, column), ["column_name"], (0.25, 0.5, 0.75), count=F.count(v),
                            mean=F.round(F.avg(v), 4), stddev=F.round(F.stddev_samp(v), 4), min=F.min(v), max=F.max(v))
    return found.select("count", "mean", "stddev", "min", q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max")


def price_quartiles(wide: DataFrame, group: str = "seller_id") -> DataFrame:
    """Exact quartiles of the item price within each seller (or another
    group), beside the number of priced items."""
    q = F.col("quantiles")
    found = exact_quantiles(wide.select(group, F.col("price").alias("v")), [group], (0.25, 0.5, 0.75), items=F.count("v"))
    return found.select(group, "items", q[0].alias("price_p25"), q[1].alias("price_median"), q[2].alias("price_p75"))


def seller_revenue_with_attributes(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Revenue per seller from raw items, with the seller's attributes."""
    rev = items.groupBy("seller_id").agg(C.money_sum("price").alias("total_revenue_per_seller"))
    return rev.join(sellers, on="seller_id", how="left").orderBy(F.desc("total_revenue_per_seller"))


# --- wide-table KPIs ----------------------------------------------------------
def seller_revenue(wide: DataFrame) -> DataFrame:
    return (wide.groupBy("seller_id").agg(C.money_sum("price").alias("total_revenue_per_seller"))
            .orderBy(F.desc("total_revenue_per_seller")))


def distinct_sellers(seller_rev: DataFrame) -> DataFrame:
    return seller_rev.select("seller_id").distinct()


def seller_review(wide: DataFrame) -> DataFrame:
    return (wide.groupBy("seller_id").agg(avg_review(wide).alias("avg_review_per_seller"))
            .orderBy(F.desc("avg_review_per_seller")))


def _delivered(wide: DataFrame) -> DataFrame:
    return wide.filter(F.col("order_status") == "delivered")


def top_products(wide: DataFrame, k: int = 10) -> DataFrame:
    keys = ["product_id", "product_category_name_english"]
    return (_delivered(wide).groupBy(*keys)
            .agg(C.money_sum("price").alias("top_10_most_sold_product"))
            .orderBy(F.desc("top_10_most_sold_product"), *keys).limit(k))


def top_customers_by_rows(wide: DataFrame, k: int = 10) -> DataFrame:
    return (_delivered(wide).groupBy("customer_id")
            .agg(F.count("order_id").alias("total_order_per_customer"),
                 F.countDistinct("order_id").alias("distinct_orders"))
            .orderBy(F.desc("total_order_per_customer"), "customer_id").limit(k))


def top_customers_by_spend(wide: DataFrame, k: int = 10) -> DataFrame:
    return (_delivered(wide).groupBy("customer_id")
            .agg(C.money_sum("price").alias("top_customer_per_spending"))
            .orderBy(F.desc("top_customer_per_spending"), "customer_id").limit(k))


def _seller_price_window():
    return Window.partitionBy("seller_id").orderBy(F.desc("price"))


def top_items_per_seller(wide: DataFrame, k: int = 5, dense: bool = False) -> DataFrame:
    """Whole item rows ranked by price within each seller, ranks <= k. The
    filter on the rank lets Spark cut each group to its top rows on the map
    side (``WindowGroupLimit``) before the shuffle, so a hot seller is
    reduced before it reaches a single task."""
    name = "dense_rank" if dense else "rank"
    fn = F.dense_rank() if dense else F.rank()
    return wide.withColumn(name, fn.over(_seller_price_window())).filter(F.col(name) <= k)


def top_rows_per_seller(spark: SparkSession, path: str, k: int = 5, dense: bool = False) -> DataFrame:
    """The same over a written wide table, whole rows out. Only the seller,
    the price and each row's address (file and row in it) are ranked and
    shuffled; the addresses that are left are written, and the other columns
    are read for them. They are broadcast only if what was written is small:
    ties at the last rank can be any number of rows."""
    import uuid

    from ..plans import physical, sinks
    name = "dense_rank" if dense else "rank"
    rows = spark.read.parquet(path)
    address = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    ranked = top_items_per_seller(rows.withColumns(address).select("seller_id", "price", *address), k, dense)
    kept = sinks.materialize(ranked.select(*address, name), spark, f"top-rows-{uuid.uuid4().hex}")
    return (rows.withColumns(address).join(physical.broadcast_if_small(kept), list(address))
            .select(*rows.columns, name))


def seller_revenue_rank(wide: DataFrame) -> DataFrame:
    """Sellers ranked by summed item price (``rank``, ties share a rank),
    computed with a distributed whole-table rank."""
    from .ranking import global_rank
    rev = wide.groupBy("seller_id").agg(C.money_sum("price").alias("total_revenue"))
    return global_rank(rev, "total_revenue", "revenue_rank")


def seller_scorecard(wide: DataFrame) -> DataFrame:
    return (wide.groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("order_id").alias("distinct_orders"),
        C.money_sum("price").alias("total_revenue"),
        avg_review(wide).alias("avg_review_score"),
        F.round(F.stddev_samp("price"), 2).alias("price_variability"),
    ).orderBy(F.desc("total_revenue")))


def product_scorecard(wide: DataFrame) -> DataFrame:
    return (wide.groupBy("product_id", "product_category_name_english").agg(
        F.count("order_id").alias("total_sales"),
        C.money_sum("price").alias("total_revenue"),
        C.money_avg("price").alias("avg_price"),
        F.round(F.stddev_samp("price"), 2).alias("price_volatility"),
        F.collect_set("seller_id").alias("unique_seller"),
        avg_review(wide).alias("avg_review_score"),
        review_count(wide).alias("total_reviewes"),
    ).orderBy(F.desc("total_sales")))


def customer_retention(wide: DataFrame) -> DataFrame:
    return (wide.groupBy("customer_id").agg(
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        F.count("order_id").alias("total_orders"),
        C.money_sum("price").alias("total_revenue"),
        C.money_avg("price").alias("avg_price"),
    ).orderBy(F.desc("total_orders")))


def state_volume(wide: DataFrame) -> DataFrame:
    return (_delivered(wide).groupBy("geolocation_state").agg(
        F.count("order_id").alias("order_volume"),
        C.money_sum("price").alias("total_spending"),
    ).orderBy(F.desc("order_volume")))


def zip_points(wide: DataFrame, geo_points: DataFrame) -> DataFrame:
    """Rows, revenue and orders per point when every item row meets all points
    of its customer's zip: items are summed up by zip first, so the fan-out
    is one of zips, not of items."""
    per_zip = wide.groupBy("customer_zip_code_prefix").agg(
        F.count("*").alias("rows"), C.money_sum("price").alias("revenue"), F.countDistinct("order_id").alias("orders"))
    points = geo_points.select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")
    return (per_zip.join(points, F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left")
            .select("customer_zip_code_prefix", "geolocation_lat", "geolocation_lng", "rows", "revenue", "orders"))


def state_volume_as_written(wide: DataFrame, geo_points: DataFrame) -> DataFrame:
    """``state_volume`` with every point of a zip counted: the zip's sums times
    its points in each state."""
    per_zip = (_delivered(wide).groupBy("customer_zip_code_prefix")
               .agg(F.count("order_id").alias("_n"), C.money_total("price").alias("_spent")))
    points = (geo_points.groupBy("geolocation_zip_code_prefix", "geolocation_state").agg(F.count("*").alias("_k")))
    rows = per_zip.join(points, F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left")
    k = F.coalesce("_k", F.lit(1))
    return (rows.groupBy("geolocation_state").agg(
        F.sum(F.col("_n") * k).alias("order_volume"),
        F.sum(F.col("_spent") * k).cast("double").alias("total_spending")).orderBy(F.desc("order_volume")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


ORDER_DIMENSION = ["order_id", "order_customer_id", "order_status", "order_purchase_timestamp",
                   "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
                   "order_estimated_delivery_date", "order_year_month"]
ITEM_FACT = ["order_id", "item_order_item_id", "item_product_id", "item_seller_id", "order_customer_id",
             "order_year_month", "price", "freight_value", "order_revenue", "is_delivered", "is_canceled",
             "is_late", "delivery_delay_time"]


def dim_orders(wide: DataFrame) -> DataFrame:
    """Order dimension: one row per order (order columns depend on the
    order id only, so the kept row does not matter)."""
    return wide.select(*ORDER_DIMENSION).dropDuplicates(["order_id"])


def fact_items(wide: DataFrame) -> DataFrame:
    return wide.select(*ITEM_FACT)
