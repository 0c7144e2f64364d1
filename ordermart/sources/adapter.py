"""Adapter from the driver's TPC-H-style test tables to the nine source tables.

The test tables carry no nulls, no bad ids and no orphan keys, so each
mapping also injects the defects the cleaning and quality operators are
built for, each by a deterministic expression on the row's own keys (never
by dropping or sampling rows). Every table is a lazy projection of a
Parquet scan; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# --- fixed values: defect-injection moduli and literals --------------------
DATE_LIKE_ORDER_ID = "2018-01-01 10:00:00"
REVIEW_EPOCH = "1998-01-01 00:00:00"
UNTRANSLATED_CATEGORY = "PROMO"
UNKNOWN_SELLER = "-1"
# ----------------------------------------------------------------------------


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n.cast("int"), ts)


def _days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n.cast("int"), ts)


def _zip(nation: Column) -> Column:
    return F.lpad(nation.cast("string"), 5, "0")


def _state(nation: Column) -> Column:
    return F.concat(F.lit("S"), (nation % 5).cast("string"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day, st = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    return _scan(spark, sf_dir, "orders").select(
        F.md5(k.cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(st == "F", "delivered").when(st == "P", "canceled")
        .when(k % 10 == 0, "invoiced").otherwise("shipped").alias("order_status"),
        _hours(day, k % 24).alias("order_purchase_timestamp"),
        F.when(k % 13 != 0, _hours(day, k % 24 + 1)).alias("order_approved_at"),
        _days(day, F.lit(2)).alias("order_delivered_carrier_date"),
        F.when((st == "F") & (k % 19 != 0), _days(day, 5 + k % 30)).alias("order_delivered_customer_date"),
        _days(day, F.lit(20)).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    return _scan(spark, sf_dir, "lineitem").select(
        F.md5(k.cast("string")).alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(k % 101 == 7, F.lit(UNKNOWN_SELLER)).otherwise(F.col("l_suppkey").cast("string")).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment row per event, spread over the orders: every tenth event
    pays for its neighbour's order, so orders have none, one or two rows.
    ``payment_sequential`` numbers an order's rows in time order."""
    e, t = F.col("event_id"), F.col("event_type")
    key = F.when(e % 10 == 0, e + 1).otherwise(e)
    seq = Window.partitionBy(key).orderBy("ts", "event_id")
    return _scan(spark, sf_dir, "events").select(
        F.md5(key.cast("string")).alias("order_id"),
        F.row_number().over(seq).cast("int").alias("payment_sequential"),
        F.when(t == "view", "boleto").when(t == "click", "credit_card")
        .when(t == "purchase", "debit_card").when(t == "signup", "voucher")
        .otherwise("not_defined").alias("payment_type"),
        (e % 12 + 1).cast("int").alias("payment_installments"),
        F.when(e % 29 != 0, F.col("value")).alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review row per order key, its text a turn of a conversation: the
    keys go round the conversations and, in each, round its turns, so all
    turns are used. Every seventh review is about its neighbour's order, so
    orders have none, one or two."""
    texts = _scan(spark, sf_dir, "conversations")
    size = texts.groupBy("conv_id").agg(F.count("*").alias("turns"))
    n = texts.agg(F.max("conv_id") + 1).scalar()
    keys = (_scan(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % n).alias("conv_id"),
                                                  F.floor(F.col("o_orderkey") / n).alias("round"))
            .join(size, "conv_id").withColumn("turn", F.col("round") % F.col("turns")))
    k = F.col("k")
    c, t = k % 365, k % 7
    ct = c + t
    about = F.when(k % 7 == 0, k + 1).otherwise(k)
    epoch = F.lit(REVIEW_EPOCH).cast("timestamp_ntz")
    return keys.join(texts, ["conv_id", "turn"]).select(
        F.md5(F.concat(F.lit("r"), k.cast("string"))).alias("review_id"),
        F.when(k % 11 == 3, F.lit(DATE_LIKE_ORDER_ID)).otherwise(F.md5(about.cast("string"))).alias("order_id"),
        F.when(ct % 6 != 0, (ct % 6).cast("int")).alias("review_score"),
        F.when(ct % 3 != 0, F.col("role")).alias("review_comment_title"),
        F.when(ct % 2 != 0, F.col("text")).alias("review_comment_message"),
        F.when(ct % 9 != 0, _days(epoch, c).cast("date")).alias("review_creation_date"),
        _days(epoch, ct).alias("review_answer_timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    return _scan(spark, sf_dir, "part").select(
        k.cast("string").alias("product_id"),
        F.when(k % 17 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        F.when(k % 23 != 0, size * 10).alias("product_description_lenght"),
        (k % 6).cast("int").alias("product_photos_qty"),
        F.when(k % 31 != 0, F.col("p_retailprice")).alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (size % 10).cast("double").alias("product_height_cm"),
        (size % 7).cast("double").alias("product_width_cm"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("s_nationkey")
    return _scan(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        _zip(n).alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        _state(n).alias("seller_state"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    return _scan(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.md5("c_name").alias("customer_unique_id"),
        _zip(n).alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        _state(n).alias("customer_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four points per zip prefix, a third of them repeated (lat, lng)."""
    n = F.col("s_nationkey")
    return _scan(spark, sf_dir, "supplier").select(
        _zip(n).alias("geolocation_zip_code_prefix"),
        (n + (F.col("s_suppkey") % 4).cast("double") * F.lit(0.25)).alias("geolocation_lat"),
        (-n).cast("double").alias("geolocation_lng"),
        F.col("s_name").alias("geolocation_city"),
        _state(n).alias("geolocation_state"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per category; one category has no English name."""
    ty = F.col("p_type")
    return (_scan(spark, sf_dir, "part")
            .select(ty.alias("product_category_name"),
                    F.when(ty != UNTRANSLATED_CATEGORY, F.lower(ty)).alias("product_category_name_english"))
            .distinct())


ADAPTERS = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "customers": customers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


class SourceTables:
    """Lazily built source tables for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ADAPTERS:
            return ADAPTERS[name](self.spark, self.sf_dir)
        raise AttributeError(name)

    def all(self) -> dict[str, DataFrame]:
        return {name: fn(self.spark, self.sf_dir) for name, fn in ADAPTERS.items()}
