"""Collapse many-rows-per-order tables to one row per order before joining.

Pre-aggregating avoids row multiplication in the wide join, and every
aggregate here is partial (map-side) so a hot order id is combined on the
executors before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def payments_per_order(payments_clean: DataFrame) -> DataFrame:
    """One row per order: last sequence number, the set of payment types,
    installments, number of payment rows and the paid totals."""
    return payments_clean.groupBy("payment_order_id").agg(
        F.max("payment_sequential").alias("max_payment_sequence"),
        F.collect_set("payment_type").alias("payment_type"),
        F.sum("payment_installments").alias("payment_installments"),
        F.count("*").alias("payment_split_count"),
        C.money_sum("payment_value").alias("payment_value"),
        C.money_sum("payment_value_imputed", places=10).alias("payment_value_imputed"),   # may hold the mean
    )


def reviews_per_order(reviews_clean: DataFrame) -> DataFrame:
    """One row per order: score, title and message lists kept aligned and in
    a stable order (by review id), plus the first creation/answer dates.

    The lists hold one element per review of the order (a handful), which
    is the data model of the wide table; ``review_summary_per_order`` is the
    list-free form whose buffers stay constant-size per order."""
    reviews = F.sort_array(F.collect_list(F.struct(
        "review_id", "review_score", "review_comment_title", "review_comment_message")))
    return (reviews_clean.groupBy("review_order_id")
            .agg(reviews.alias("_r"),
                 F.min("review_creation_date").alias("review_creation_date"),
                 F.min("review_answer_timestamp").alias("review_answer_timestamp"))
            .select("review_order_id",
                    F.col("_r.review_score").alias("review_scores"),
                    F.col("_r.review_comment_title").alias("review_titles"),
                    F.col("_r.review_comment_message").alias("review_message"),
                    "review_creation_date", "review_answer_timestamp"))


def reviews_in_chunks(reviews_clean: DataFrame, size: int = 1000) -> DataFrame:
    """The lists of ``reviews_per_order`` for orders with any number of
    reviews: one row per order and chunk, of about ``size`` reviews each,
    dealt out by the review id. An order of at most ``size`` reviews is one
    chunk (0) with the same lists. The orders cut into chunks are at most one
    in ``size`` reviews; counting them is a partial aggregate, and only the
    chunks, never a whole order, meet in one task."""
    many = (reviews_clean.groupBy("review_order_id").agg(F.count("*").alias("_n")).filter(F.col("_n") > size)
            .select(F.col("review_order_id").alias("_order"), F.ceil(F.col("_n") / size).cast("int").alias("_chunks")))
    dealt = reviews_clean.join(many, F.col("review_order_id") == F.col("_order"), "left")
    chunk = F.pmod(F.xxhash64("review_id", "review_comment_message"), F.coalesce("_chunks", F.lit(1))).cast("int")
    dealt = dealt.withColumn("chunk", chunk)
    reviews = F.sort_array(F.collect_list(F.struct("review_id", "review_score", "review_comment_title", "review_comment_message")))
    return (dealt.groupBy("review_order_id", "chunk").agg(reviews.alias("_r"), F.min("review_creation_date").alias("review_creation_date"),
                                                          F.min("review_answer_timestamp").alias("review_answer_timestamp"))
            .select("review_order_id", "chunk", F.col("_r.review_score").alias("review_scores"),
                    F.col("_r.review_comment_title").alias("review_titles"), F.col("_r.review_comment_message").alias("review_message"),
                    "review_creation_date", "review_answer_timestamp"))


def review_summary_per_order(reviews_clean: DataFrame) -> DataFrame:
    """Constant-size review summary per order: the same information the
    feature and KPI rules read from the lists (review count, sum and count
    of real scores, whether any title / any message is the no-review
    marker, first dates), with partial aggregates only, so an order with
    any number of reviews costs the same per task."""
    scored = F.when(F.col("review_score") != C.SENTINEL_SCORE, F.col("review_score"))
    return reviews_clean.groupBy("review_order_id").agg(
        F.count("*").alias("review_count"),
        F.sum(scored).cast("bigint").alias("review_score_sum"),
        F.count(scored).alias("review_score_n"),
        F.bool_or(F.col("review_comment_title") == C.NO_REVIEW).alias("any_title_no_review"),
        F.bool_or(F.col("review_comment_message") == C.NO_REVIEW).alias("any_message_no_review"),
        F.min("review_creation_date").alias("review_creation_date"),
        F.min("review_answer_timestamp").alias("review_answer_timestamp"),
    )


def one_per_key(dimension: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest of its rows. A dimension joined this way
    never multiplies rows, and a join whose columns nobody reads can be left
    out of the plan."""
    rest = [c for c in dimension.columns if c != key]
    return (dimension.groupBy(key).agg(F.min(F.struct(*rest)).alias("_d"))
            .select(*[F.col(c) if c == key else F.col(f"_d.{c}").alias(c) for c in dimension.columns]))


GEO_ATTRS = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
             "geolocation_city", "geolocation_state")


def geo_dedupe(geo: DataFrame) -> DataFrame:
    """One row per (lat, lng); the survivor is the smallest (zip, city, state)
    so the result is deterministic (a plain dropDuplicates keeps any row)."""
    rest = F.min(F.struct("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"))
    return (geo.groupBy("geolocation_lat", "geolocation_lng").agg(rest.alias("_g"))
            .select("_g.geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "_g.geolocation_city", "_g.geolocation_state"))


def geo_one_per_zip(geo: DataFrame) -> DataFrame:
    """One row per zip prefix: the point with the smallest (lat, lng). Its
    size is bounded by the number of 5-digit prefixes (at most 100,000)."""
    first = F.min(F.struct("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"))
    return (geo.groupBy("geolocation_zip_code_prefix").agg(first.alias("_g"))
            .select("geolocation_zip_code_prefix", "_g.geolocation_lat", "_g.geolocation_lng",
                    "_g.geolocation_city", "_g.geolocation_state"))
