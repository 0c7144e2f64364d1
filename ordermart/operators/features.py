"""Derived order-item features, added as one projection (``withColumns``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

FEATURE_COLUMNS = (
    "is_delivered", "is_canceled", "order_revenue", "is_payment_missing", "has_review",
    "time_from_delivery_to_review", "time_to_response", "hour_of_day", "order_day_type",
    "actual_delivery_time", "estimated_delivery_time", "delivery_delay_time", "is_late",
)

#: those that read item columns; the others are the same for all items of an order
ITEM_FEATURES = ("order_revenue",)


def review_label(titles: str = "review_titles", messages: str = "review_message",
                 as_written: bool = False, summary: bool = False):
    """Both comment lists hold the 'No Review' marker -> ``No Reivew``.

    Orders with no review row at all (null lists) are labelled the same by
    default; ``as_written`` labels them 'Has Comment', as the original rule
    did through a null predicate. ``summary`` reads the same facts from the
    list-free review summary columns."""
    if summary:
        both = F.col("any_title_no_review") & F.col("any_message_no_review")
        missing = F.col("review_count").isNull()
    else:
        both = F.array_contains(titles, C.NO_REVIEW) & F.array_contains(messages, C.NO_REVIEW)
        missing = F.col(titles).isNull()
    if not as_written:
        both = both | missing
    return F.when(both, C.NO_REVIEW_FLAG).otherwise(C.HAS_COMMENT)


def feature_columns(keep_sentinels: bool = False, as_written_review_label: bool = False,
                    review_summary: bool = False) -> dict:
    """Feature expressions. By default sentinel dates (1900-01-01) are
    treated as missing before date differences; ``keep_sentinels`` keeps
    them, reproducing the very large lags of the original rules."""
    created = F.col("review_creation_date")
    answered = F.col("review_answer_timestamp")
    if not keep_sentinels:
        created, answered = C.not_sentinel(created), C.not_sentinel(answered)
    purchase = F.col("order_purchase_timestamp")
    actual = F.datediff("order_delivered_customer_date", purchase)
    estimated = F.datediff("order_estimated_delivery_date", purchase)
    delay = actual - estimated
    return {
        "is_delivered": C.flag(F.col("order_status") == "delivered"),
        "is_canceled": C.flag(F.col("order_status") == "canceled"),
        "order_revenue": F.col("price") + F.col("freight_value"),
        "is_payment_missing": C.flag(F.col("payment_value").isNull()),
        "has_review": review_label(as_written=as_written_review_label, summary=review_summary),
        "time_from_delivery_to_review": F.datediff(created, "order_delivered_customer_date"),
        "time_to_response": F.datediff(answered, created),
        "hour_of_day": F.hour(purchase),
        "order_day_type": F.when(F.dayofweek(purchase).isin(list(C.WEEKEND_DAYS)), C.WEEKEND).otherwise(C.WEEKDAY),
        "actual_delivery_time": actual,
        "estimated_delivery_time": estimated,
        "delivery_delay_time": delay,
        "is_late": C.flag(delay > 0),
    }


def add_features(wide: DataFrame, **options) -> DataFrame:
    return wide.withColumns(feature_columns(**options))


def year_month(ts: str = "order_purchase_timestamp") -> Column:
    return F.date_format(ts, "yyyy-MM")


def add_year_month(df: DataFrame, ts: str = "order_purchase_timestamp",
                   name: str = "order_year_month") -> DataFrame:
    return df.withColumn(name, year_month(ts))


DELIVERY_COLUMNS = ("order_id", "order_status", "order_purchase_timestamp",
                    "order_delivered_customer_date", "order_estimated_delivery_date")


def delivery_table(orders_clean: DataFrame) -> DataFrame:
    """Order-grain delivery facts (actual, estimated, delay, late flag)."""
    cols = feature_columns()
    return orders_clean.select(
        *DELIVERY_COLUMNS,
        *[cols[n].alias(n) for n in ("actual_delivery_time", "estimated_delivery_time",
                                     "delivery_delay_time", "is_late")],
    )
