"""Raw -> bronze cleaning: null handling, imputation, recodes, renames.

Each function maps a source-schema DataFrame to its cleaned form as one
lazy projection/filter chain. Statistics the rules need (mean payment,
weight quartiles) are in-plan scalar subqueries, not driver round trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import stats


def _typed_fill(df: DataFrame, name: str, value) -> Column:
    """``coalesce(col, value)`` with the literal cast to the column's own type
    (a string sentinel fills DATE, TIMESTAMP and TIMESTAMP_NTZ alike)."""
    return F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))


def fill(df: DataFrame, values: dict) -> DataFrame:
    """``fillna`` by column with type-aware literals, as one projection."""
    return df.withColumns({name: _typed_fill(df, name, v) for name, v in values.items()})


# --- reviews --------------------------------------------------------------
def reviews_with_comment_flags(reviews: DataFrame) -> DataFrame:
    """Score sentinel, joint-null comment flag, comment/date defaults."""
    title, message = F.col("review_comment_title"), F.col("review_comment_message")
    silent = title.isNull() & message.isNull()
    said = lambda c: F.when(silent, C.NO_REVIEW).otherwise(F.coalesce(c, F.lit(C.REVIEW_GIVEN)))
    return reviews.filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull()).select(
        "review_id", F.col("order_id").alias("review_order_id"),
        _typed_fill(reviews, "review_score", C.SENTINEL_SCORE).alias("review_score"),
        said(title).alias("review_comment_title"), said(message).alias("review_comment_message"),
        _typed_fill(reviews, "review_creation_date", C.SENTINEL_DATE).alias("review_creation_date"),
        _typed_fill(reviews, "review_answer_timestamp", C.SENTINEL_DATE).alias("review_answer_timestamp"),
        F.when(silent, C.NO_COMMENT).otherwise(C.HAS_COMMENT).alias("has_review"))


def invalid_review_rows(reviews: DataFrame) -> DataFrame:
    """Rows whose order id looks like a date: split CSV records (bad rows)."""
    return reviews_with_comment_flags(reviews).filter(F.col("review_order_id").rlike(C.DATE_LIKE_PATTERN))


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Cleaned reviews; rows with a date-like order id are dropped (and so are
    null ids, which match neither the pattern nor its negation)."""
    return reviews_with_comment_flags(reviews).filter(~F.col("review_order_id").rlike(C.DATE_LIKE_PATTERN))


# --- orders ---------------------------------------------------------------
def clean_orders(orders: DataFrame) -> DataFrame:
    """Drop rows missing an id or status; delivered orders without approval
    time take the purchase time; remaining gaps get the sentinel."""
    df = orders.dropna(subset=["order_id", "customer_id", "order_status"])
    approved = (F.when((F.col("order_status") == "delivered") & F.col("order_approved_at").isNull(),
                       F.col("order_purchase_timestamp"))
                .otherwise(F.col("order_approved_at")))
    df = df.withColumn("order_approved_at", approved)
    df = fill(df, {"order_approved_at": C.SENTINEL_TIMESTAMP})
    return df.withColumnRenamed("customer_id", "order_customer_id")


def undelivered_by_status(orders: DataFrame) -> DataFrame:
    """Orders without a delivery date, counted per status."""
    return (orders.filter(F.col("order_delivered_customer_date").isNull())
            .groupBy("order_status").count())


# --- products -------------------------------------------------------------
PRODUCT_DEFAULTS = {
    "product_category_name": C.UNKNOWN_CATEGORY,
    "product_name_lenght": 0, "product_description_lenght": 0, "product_photos_qty": 0,
    "product_weight_g": 0, "product_length_cm": 0, "product_height_cm": 0, "product_width_cm": 0,
}


def fill_products(products: DataFrame) -> DataFrame:
    """Defaults for missing attributes."""
    return fill(products, PRODUCT_DEFAULTS)


def clean_products(products: DataFrame, weights: str = "filled") -> DataFrame:
    """Defaults for missing attributes, then ``product_size`` by exact weight
    quartile: over the zero-filled weights, or with ``weights="present"``
    over those that are not missing (missing ones still count as 0 g)."""
    if weights not in ("filled", "present"):
        raise ValueError("weights must be 'filled' or 'present'")
    df = fill_products(products)
    q1, q2, q3 = stats.quantiles(df if weights == "filled" else products, "product_weight_g", (0.25, 0.5, 0.75))
    return df.withColumn("product_size", C.quartile_band("product_weight_g", q1, q2, q3))


def weight_frequency(products_clean: DataFrame) -> DataFrame:
    return products_clean.groupBy("product_weight_g").count()


# --- payments -------------------------------------------------------------
def clean_payments(payments: DataFrame) -> DataFrame:
    """Mean-impute ``payment_value`` into ``payment_value_imputed`` (the mean
    is a scalar subquery), recode the type, rename the order key."""
    mean_value = stats.money_mean(payments, "payment_value")
    df = payments.withColumn("payment_value_imputed", F.coalesce(F.col("payment_value"), mean_value))
    df = df.withColumn("payment_type", C.recode_payment_type("payment_type"))
    return df.withColumnRenamed("order_id", "payment_order_id")


def impute_mean_ml(payments: DataFrame) -> DataFrame:
    """The same imputation through ``pyspark.ml.feature.Imputer``."""
    from pyspark.ml.feature import Imputer
    imputer = (Imputer().setInputCols(["payment_value"]).setOutputCols(["payment_value_imputed"])
               .setStrategy("mean"))
    return imputer.fit(payments).transform(payments)


# --- items ----------------------------------------------------------------
ITEM_RENAMES = {
    "order_id": "item_order_id",
    "order_item_id": "item_order_item_id",
    "product_id": "item_product_id",
    "seller_id": "item_seller_id",
}


def clean_items(items: DataFrame) -> DataFrame:
    return items.withColumnsRenamed(ITEM_RENAMES)
