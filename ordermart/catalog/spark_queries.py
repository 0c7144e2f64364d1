"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables through the source adapter and
returns a presentation-stable frame: list columns are rendered as text (sets
sorted, ordered lists in their own order) and DATE columns as ISO text, so
results compare by value across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType

from ..functions import columns as C
from ..operators import clean, features, kpis, preagg, wide
from ..sources.adapter import SourceTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Array columns whose element order carries no meaning (sets).
SET_COLUMNS = {"payment_type", "unique_seller"}


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


def presentable(df: DataFrame) -> DataFrame:
    conv = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            conv[f.name] = C.sorted_text(f.name) if f.name in SET_COLUMNS else C.ordered_text(f.name)
        elif isinstance(f.dataType, DateType):
            conv[f.name] = F.date_format(f.name, "yyyy-MM-dd")
    return df.withColumns(conv) if conv else df


def src(spark: SparkSession, d: str) -> SourceTables:
    return SourceTables(spark, d)


def silver(spark: SparkSession, d: str, geo_mode: str = "one_per_zip") -> wide.Silver:
    return wide.Silver(src(spark, d), geo_mode)


def wide_table(spark: SparkSession, d: str, columns=None, **kw) -> DataFrame:
    return wide.build_wide(src(spark, d), columns, **kw)


def written_wide(spark: SparkSession, d: str) -> str:
    """Write the wide table partitioned by month; its path."""
    import uuid

    from ..plans import sinks
    path = f"{sinks.scratch_root(spark)}/silver-{uuid.uuid4().hex}/final_df"
    sinks.write_wide(wide_table(spark, d, by_month=True), path)
    return path


ITEM_KEY = ["order_id", "item_order_item_id"]
REVIEW_SUMS = ["review_count", "review_score_sum", "review_score_n"]


# --- step 1: the flagship KPI ----------------------------------------------------
@query("k09_top_products")
def k09(spark, d):
    """Top-10 products by delivered revenue."""
    return kpis.top_products(wide_table(spark, d, ["order_status", "product_id", "product_category_name_english", "price"]))


# --- step 2: cleaning ------------------------------------------------------------
@query("clean_reviews")
def q_clean_reviews(spark, d):
    return clean.clean_reviews(src(spark, d).order_reviews)


@query("clean_reviews_invalid")
def q_invalid_reviews(spark, d):
    return clean.invalid_review_rows(src(spark, d).order_reviews)


@query("clean_orders")
def q_clean_orders(spark, d):
    return clean.clean_orders(src(spark, d).orders)


@query("clean_products_size")
def q_clean_products(spark, d):
    return clean.clean_products(src(spark, d).products)


@query("clean_payments_mean")
def q_clean_payments(spark, d):
    return clean.clean_payments(src(spark, d).order_payments)


@query("clean_items_rename")
def q_clean_items(spark, d):
    return clean.clean_items(src(spark, d).order_items)


@query("clean_products_size_present")
def q_clean_products_present(spark, d):
    """Size bands from the quartiles of the weights that are not missing."""
    return clean.clean_products(src(spark, d).products, weights="present")


@query("k22_weight_freq")
def k22(spark, d):
    return clean.weight_frequency(clean.fill_products(src(spark, d).products)).orderBy(F.desc("count"))


# --- step 3: pre-aggregates ----------------------------------------------------
@query("payments_per_order")
def q_payments_per_order(spark, d):
    return silver(spark, d).payments


@query("reviews_per_order")
def q_reviews_per_order(spark, d):
    return silver(spark, d).reviews


@query("reviews_in_chunks")
def q_reviews_in_chunks(spark, d):
    """Lists of at most about 1000 reviews, an order's lists in chunks."""
    return preagg.reviews_in_chunks(clean.clean_reviews(src(spark, d).order_reviews))


@query("review_summary_per_order")
def q_review_summary(spark, d):
    return preagg.review_summary_per_order(clean.clean_reviews(src(spark, d).order_reviews))


@query("wide_review_summary")
def q_wide_review_summary(spark, d):
    """The wide table built with the list-free review summary."""
    return wide_table(spark, d, [*ITEM_KEY, *wide.REVIEW_SUMMARY_COLUMNS, "has_review", "time_from_delivery_to_review"],
                      review_mode="summary")


@query("geo_dedupe")
def q_geo_dedupe(spark, d):
    return preagg.geo_dedupe(src(spark, d).geolocation)


@query("geo_one_per_zip")
def q_geo_one_per_zip(spark, d):
    return preagg.geo_one_per_zip(src(spark, d).geolocation)


# --- step 4: joins (projections of the one wide table) ---------------------------
def _wide_cols(spark, d, cols, **kw):
    return wide_table(spark, d, cols, **kw)


@query("orders_items_inner")
def q_orders_items(spark, d):
    return _wide_cols(spark, d, wide.ORDER_COLUMNS + wide.ITEM_COLUMNS)


@query("wide_left_products")
def q_wide_products(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["item_product_id", "product_category_name"] + wide.PRODUCT_COLUMNS)


@query("wide_left_sellers")
def q_wide_sellers(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["item_seller_id"] + wide.SELLER_COLUMNS)


@query("wide_left_payments")
def q_wide_payments(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + wide.PAYMENT_COLUMNS)


@query("wide_left_customers")
def q_wide_customers(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["order_customer_id"] + wide.CUSTOMER_COLUMNS)


@query("wide_left_reviews")
def q_wide_reviews(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + wide.REVIEW_COLUMNS)


@query("wide_geo_default")
def q_wide_geo(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["customer_zip_code_prefix"] + wide.GEO_COLUMNS)


@query("wide_geo_as_written")
def q_wide_geo_fanout(spark, d):
    """Geolocation joined on zip after (lat, lng) dedupe: rows multiply by the
    points in the zip. Rows, revenue and orders per point."""
    s = silver(spark, d, geo_mode="as_written")
    return kpis.zip_points(wide_table(spark, d, ["customer_zip_code_prefix", "order_id", "price"]), s.geo)


@query("wide_geo_as_written_rows")
def q_wide_geo_rows(spark, d):
    """The wide table as written, every item row with every point of its
    zip: rows, revenue and points per month, state and status."""
    w = wide_table(spark, d, ["order_year_month", "geolocation_state", "order_status", "price", "geolocation_lat",
                              "geolocation_lng", "order_id"], geo_mode="as_written")
    return w.groupBy("order_year_month", "geolocation_state", "order_status").agg(
        F.count("*").alias("rows"), C.money_sum("price").alias("revenue"),
        F.countDistinct("order_id").alias("orders"), F.countDistinct("geolocation_lat", "geolocation_lng").alias("points"))


@query("wide_translation_using")
def q_wide_translation(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["product_category_name", "product_category_name_english"])


@query("wide_segments")
def q_wide_segments(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["order_customer_id"] + wide.SEGMENT_COLUMNS)


# --- step 5: features --------------------------------------------------------------
@query("feat_flags")
def q_feat_flags(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["order_status", "price", "freight_value", "payment_value",
                                            "is_delivered", "is_canceled", "order_revenue", "is_payment_missing"])


@query("feat_review_lags")
def q_feat_lags(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["review_creation_date", "review_answer_timestamp",
                                            "order_delivered_customer_date", "time_from_delivery_to_review",
                                            "time_to_response"])


@query("feat_calendar")
def q_feat_calendar(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["order_purchase_timestamp", "hour_of_day", "order_day_type",
                                            "order_year_month"])


@query("feat_delivery")
def q_feat_delivery(spark, d):
    return features.delivery_table(clean.clean_orders(src(spark, d).orders))


@query("feat_has_review")
def q_feat_has_review(spark, d):
    return _wide_cols(spark, d, ITEM_KEY + ["review_titles", "review_message", "has_review"])


# --- step 6: segments ----------------------------------------------------------------
@query("k20_customer_spend")
def k20(spark, d):
    return silver(spark, d).customer_spend().orderBy(F.desc("total_spent"))


@query("k21_aov_segment")
def k21(spark, d):
    return silver(spark, d).customer_segments()


# --- step 7: KPIs ----------------------------------------------------------------------
@query("k01_customers_by_state")
def k01(spark, d):
    return kpis.customers_by_state(src(spark, d).customers)


@query("k02_orders_by_status")
def k02(spark, d):
    return kpis.orders_by_status(clean.clean_orders(src(spark, d).orders))


@query("k03_payment_types")
def k03(spark, d):
    return kpis.payments_by_type(clean.clean_payments(src(spark, d).order_payments))


@query("k03_payment_type_sets")
def k03s(spark, d):
    return kpis.orders_by_payment_type_set(silver(spark, d).payments)


@query("k04_product_sales")
def k04(spark, d):
    return kpis.product_sales(src(spark, d).order_items)


@query("k05_price_summary")
def k05(spark, d):
    return kpis.price_summary(src(spark, d).order_items)


@query("k06_seller_revenue")
def k06(spark, d):
    return kpis.seller_revenue(wide_table(spark, d, ["seller_id", "price"]))


@query("k07_distinct_sellers")
def k07(spark, d):
    return kpis.distinct_sellers(wide_table(spark, d, ["seller_id"]))


@query("k08_seller_review")
def k08(spark, d):
    return kpis.seller_review(wide_table(spark, d, ["seller_id", *REVIEW_SUMS], review_mode="summary"))


@query("k10_top_customers_rows")
def k10(spark, d):
    return kpis.top_customers_by_rows(wide_table(spark, d, ["order_status", "customer_id", "order_id"]))


@query("k11_top_customers_spend")
def k11(spark, d):
    return kpis.top_customers_by_spend(wide_table(spark, d, ["order_status", "customer_id", "price"]))


@query("k12_rank")
def k12(spark, d):
    """Whole rows of the written wide table."""
    return kpis.top_rows_per_seller(spark, written_wide(spark, d), 5)


@query("k12_seller_revenue_rank")
def k12r(spark, d):
    return kpis.seller_revenue_rank(wide_table(spark, d, ["seller_id", "price"]))


@query("k13_dense_rank")
def k13(spark, d):
    return kpis.top_rows_per_seller(spark, written_wide(spark, d), 5, dense=True)


@query("k14_seller_scorecard")
def k14(spark, d):
    return kpis.seller_scorecard(wide_table(spark, d, ["seller_id", "order_id", "price", *REVIEW_SUMS], review_mode="summary"))


@query("k14_seller_price_quartiles")
def k14q(spark, d):
    return kpis.price_quartiles(wide_table(spark, d, ["seller_id", "price"]))


@query("k15_product_scorecard")
def k15(spark, d):
    return kpis.product_scorecard(wide_table(
        spark, d, ["product_id", "product_category_name_english", "seller_id", "order_id", "price", *REVIEW_SUMS],
        review_mode="summary"))


@query("k16_retention")
def k16(spark, d):
    return kpis.customer_retention(wide_table(spark, d, ["customer_id", "order_id", "order_purchase_timestamp", "price"]))


@query("k17_state_volume")
def k17(spark, d):
    return kpis.state_volume(wide_table(spark, d, ["order_status", "geolocation_state", "order_id", "price"]))


@query("k17_state_volume_as_written")
def k17w(spark, d):
    w = wide_table(spark, d, ["order_status", "customer_zip_code_prefix", "order_id", "price"])
    return kpis.state_volume_as_written(w, silver(spark, d, geo_mode="as_written").geo)


@query("k18_row_count")
def k18(spark, d):
    return kpis.row_count(wide_table(spark, d, ["order_id"]))


@query("k19_seller_revenue_attrs")
def k19(spark, d):
    t = src(spark, d)
    return kpis.seller_revenue_with_attributes(t.order_items, t.sellers)


@query("k23_dim_orders")
def k23d(spark, d):
    return kpis.dim_orders(wide_table(spark, d, kpis.ORDER_DIMENSION))


@query("k23_fact_items")
def k23f(spark, d):
    return kpis.fact_items(wide_table(spark, d, kpis.ITEM_FACT))


# --- step 8: data quality (checks the original ran) -------------------------------
from ..operators import quality as Q  # noqa: E402

# Allowed and legacy code lists of the data model.
ORDER_STATUSES = ["approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped",
                  "unavailable"]
PAYMENT_CODES = ["boleto", "credit_card", "debit_card", "voucher"]
LEGACY_CODES = {"order_payments.payment_type": ["not_defined"], "orders.order_status": ["invoiced"]}


@query("dq_row_counts")
def dq_row_counts(spark, d):
    return Q.row_counts(src(spark, d).all())


@query("dq_duplicates")
def dq_duplicates(spark, d):
    t = src(spark, d)
    return Q.uniqueness({
        "customers": (t.customers, ["customer_id"]), "order_items": (t.order_items, ["order_id"]),
        "order_reviews": (t.order_reviews, ["review_id"]), "orders": (t.orders, ["order_id"]),
        "products": (t.products, ["product_id"]), "sellers": (t.sellers, ["seller_id"]),
    })


@query("dq_nulls")
def dq_nulls(spark, d):
    tables = {k: v for k, v in src(spark, d).all().items() if k != "category_translation"}
    tables["final"] = wide_table(spark, d, presence=True)
    return Q._union(Q.null_profile(df, name) for name, df in tables.items())


@query("dq_nulls_nan")
def dq_nulls_nan(spark, d):
    """Null+NaN profile of the payment rows and of the per-order payments."""
    s = silver(spark, d)
    return Q._union([Q.missing_profile(clean.clean_payments(src(spark, d).order_payments), "order_payments"),
                     Q.missing_profile(s.payments, "order_payments_per_order")])


@query("dq_hex_ids")
def dq_hex_ids(spark, d):
    t = src(spark, d)
    return Q._union([
        Q.hex_id_report(wide_table(spark, d, ["review_order_id"]), "review_order_id", "final"),
        Q.hex_id_report(t.orders, "order_id", "orders"),
        Q.hex_id_report(t.order_items, "order_id", "order_items"),
        Q.hex_id_report(t.order_reviews, "order_id", "order_reviews"),
        Q.hex_id_report(t.order_payments, "order_id", "order_payments"),
    ])


@query("dq_hex_ids_valid")
def dq_hex_ids_valid(spark, d):
    return Q.valid_hex_ids(wide_table(spark, d, [*ITEM_KEY, "review_order_id"]), "review_order_id")


@query("dq_uniqueness")
def dq_uniqueness(spark, d):
    t = src(spark, d)
    return Q.uniqueness({
        "geolocation": (t.geolocation, ["geolocation_lat"]),
        "customers": (t.customers, ["customer_id", "customer_unique_id"]),
        "orders": (clean.clean_orders(t.orders), ["order_id", "order_customer_id"]),
        "sellers": (t.sellers, ["seller_id", "seller_zip_code_prefix"]),
        "products": (t.products, ["product_id", "product_category_name"]),
        "order_reviews": (clean.clean_reviews(t.order_reviews), ["review_id", "review_order_id"]),
        "category_translation": (t.category_translation,
                                 ["product_category_name", "product_category_name_english"]),
        "order_items": (clean.clean_items(t.order_items), list(clean.ITEM_RENAMES.values())),
        "order_payments": (clean.clean_payments(t.order_payments), ["payment_order_id"]),
    })


@query("dq_join_reconcile")
def dq_join_reconcile(spark, d):
    return Q.join_reconciliation(silver(spark, d, geo_mode="as_written"))


@query("dq_nulls_by_status")
def dq_nulls_by_status(spark, d):
    return clean.undelivered_by_status(clean.clean_orders(src(spark, d).orders))


@query("dq_having_dupes")
def dq_having_dupes(spark, d):
    return Q.orders_per_key_having(spark, wide_table(spark, d, ["order_id"]))


# --- step 9: data quality (the written checklist) ---------------------------------
KEY_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
    "order_reviews": ["review_id", "order_id"],
    "order_payments": ["order_id"],
    "products": ["product_id"],
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
}


@query("dq_null_threshold")
def dq_null_threshold(spark, d):
    t = src(spark, d).all()
    return Q._union(Q.null_thresholds(t[name], name, {c: 0.0 for c in keys}, default_limit=0.5)
                    for name, keys in KEY_COLUMNS.items())


@query("dq_dup_rows")
def dq_dup_rows(spark, d):
    return Q._union(Q.duplicate_rows(df, name) for name, df in src(spark, d).all().items())


ZIP_PATTERN = r"^\d{5}$"
YEAR_MONTH_PATTERN = r"^\d{4}-\d{2}$"


@query("dq_format")
def dq_format(spark, d):
    t = src(spark, d)
    return Q._union([
        Q.rule_counts(t.customers, "customers", {"zip_5_digits": Q.format_rule("customer_zip_code_prefix", ZIP_PATTERN)}),
        Q.rule_counts(t.sellers, "sellers", {"zip_5_digits": Q.format_rule("seller_zip_code_prefix", ZIP_PATTERN)}),
        Q.rule_counts(t.geolocation, "geolocation",
                      {"zip_5_digits": Q.format_rule("geolocation_zip_code_prefix", ZIP_PATTERN)}),
        Q.rule_counts(t.order_reviews, "order_reviews", {"order_id_hex": Q.format_rule("order_id", C.HEX_ID_PATTERN)}),
        Q.rule_counts(t.orders, "orders", {"order_id_hex": Q.format_rule("order_id", C.HEX_ID_PATTERN)}),
        Q.rule_counts(wide_table(spark, d, ["order_year_month"]), "final",
                      {"year_month_format": Q.format_rule("order_year_month", YEAR_MONTH_PATTERN)}),
        Q.rule_counts(t.order_reviews.withColumn("_day", F.col("review_creation_date").cast("string")), "order_reviews",
                      {"iso_date": Q.format_rule("_day", Q.ISO_DATE_PATTERN),
                       "order_id_iso_date": Q.format_rule("order_id", Q.ISO_DATE_PATTERN)}),
        Q.rule_counts(customer_mail(t.customers), "customers", {"email": Q.format_rule("email", Q.EMAIL_PATTERN)}),
    ])


def customer_mail(customers: DataFrame) -> DataFrame:
    """The source has no mail column; one is made of its own: a mail address
    where the key is even, the bare key elsewhere."""
    key = F.col("customer_id")
    return customers.withColumn("email", F.when(key.cast("long") % 2 == 0, F.concat(key, F.lit("@mail.example.org")))
                                .otherwise(key))


@query("dq_allowed")
def dq_allowed(spark, d):
    t = src(spark, d)
    return Q._union([
        Q.allowed_values(t.orders, "orders", "order_status", ORDER_STATUSES),
        Q.allowed_values(t.order_payments, "order_payments", "payment_type", PAYMENT_CODES),
        Q.values_missing_from(t.products, "products", "product_category_name",
                              t.category_translation.filter(F.col("product_category_name_english").isNotNull()),
                              "product_category_name"),
    ])


@query("dq_range")
def dq_range(spark, d):
    t = src(spark, d)
    return Q._union([
        Q.rule_counts(t.order_items, "order_items", {"price_positive": Q.range_rule("price", low=0.01),
                                                     "freight_non_negative": Q.range_rule("freight_value", low=0)}),
        Q.rule_counts(t.order_reviews, "order_reviews", {"score_1_to_5": Q.range_rule("review_score", 1, 5)}),
        Q.rule_counts(t.order_payments, "order_payments", {
            "installments_1_to_24": Q.range_rule("payment_installments", 1, 24),
            "value_non_negative": Q.range_rule("payment_value", low=0)}),
        Q.rule_counts(t.geolocation, "geolocation", {"lat_valid": Q.range_rule("geolocation_lat", -90, 90),
                                                     "lng_valid": Q.range_rule("geolocation_lng", -180, 180)}),
        Q.rule_counts(t.products, "products", {"weight_non_negative": Q.range_rule("product_weight_g", low=0)}),
    ])


@query("dq_iqr")
def dq_iqr(spark, d):
    t = src(spark, d)
    return Q.iqr_outliers({"order_items": (t.order_items, ["price", "freight_value"]),
                           "order_payments": (t.order_payments, ["payment_value"])})


@query("dq_iqr_by_category")
def dq_iqr_by_category(spark, d):
    """Price outliers within each product category."""
    return Q.group_outliers(wide_table(spark, d, ["product_category_name", "price"]), "product_category_name", "price")


@query("dq_zscore")
def dq_zscore(spark, d):
    t = src(spark, d)
    return Q._union([Q.zscore_outliers(t.order_items, "price", "order_items"),
                     Q.zscore_outliers(t.order_items, "freight_value", "order_items"),
                     Q.zscore_outliers(t.order_payments, "payment_value", "order_payments")])


CROSS_FIELD_RULES = {
    "approved_after_purchase": ("order_purchase_timestamp", "order_approved_at"),
    "carrier_after_purchase": ("order_purchase_timestamp", "order_delivered_carrier_date"),
    "delivered_after_purchase": ("order_purchase_timestamp", "order_delivered_customer_date"),
    "estimate_after_purchase": ("order_purchase_timestamp", "order_estimated_delivery_date"),
    "shipping_limit_after_purchase": ("order_purchase_timestamp", "shipping_limit_date"),
}


@query("dq_cross_field")
def dq_cross_field(spark, d):
    rules = {k: Q.order_rule(a, b) for k, (a, b) in CROSS_FIELD_RULES.items()}
    columns = sorted({c for pair in CROSS_FIELD_RULES.values() for c in pair})
    return Q.rule_counts(wide_table(spark, d, columns), "final", rules)


def _fk_relations(t):
    o = clean.clean_orders(t.orders)
    return {
        "orders.customer_id->customers": (o, "order_customer_id", t.customers, "customer_id"),
        "order_items.order_id->orders": (t.order_items, "order_id", o, "order_id"),
        "order_items.product_id->products": (t.order_items, "product_id", t.products, "product_id"),
        "order_items.seller_id->sellers": (t.order_items, "seller_id", t.sellers, "seller_id"),
        "order_payments.order_id->orders": (t.order_payments, "order_id", o, "order_id"),
        "order_reviews.order_id->orders": (t.order_reviews, "order_id", o, "order_id"),
    }


@query("dq_fk_anti")
def dq_fk_anti(spark, d):
    """Orphan child rows per relation (left anti join)."""
    frames = []
    for name, (child, ck, parent, pk) in _fk_relations(src(spark, d)).items():
        keys = parent.select(F.col(pk).alias("_pk")).distinct()
        orphans = child.join(keys, F.col(ck) == F.col("_pk"), "left_anti")
        frames.append(orphans.agg(F.count("*").alias("orphan_rows"),
                                  F.countDistinct(ck).alias("orphan_keys")).select(
            F.lit(name).alias("relation"), "orphan_rows", "orphan_keys"))
    return Q._union(frames)


@query("dq_fk_semi")
def dq_fk_semi(spark, d):
    """Child rows whose key exists in the parent (left semi join)."""
    frames = []
    for name, (child, ck, parent, pk) in _fk_relations(src(spark, d)).items():
        keys = parent.select(F.col(pk).alias("_pk"))
        valid = child.join(keys, F.col(ck) == F.col("_pk"), "left_semi")
        frames.append(valid.agg(F.count("*").alias("valid_rows")).select(F.lit(name).alias("relation"), "valid_rows"))
    return Q._union(frames)


@query("dq_reconcile")
def dq_reconcile(spark, d):
    """Item totals (price + freight) against paid totals, per order."""
    s = silver(spark, d)
    items = s.items.groupBy(F.col("item_order_id").alias("order_id")).agg(
        C.money_sum(F.col("price") + F.col("freight_value")).alias("items_total"))
    pays = s.payments.select(F.col("payment_order_id").alias("order_id"), "payment_value")
    return Q.reconcile_totals(items, pays, "order_id", "items_total", "payment_value")


@query("dq_row_differences")
def dq_row_differences(spark, d):
    """Rows of the raw orders that cleaning changed, and what became of them."""
    t = src(spark, d)
    cleaned = clean.clean_orders(t.orders).withColumnRenamed("order_customer_id", "customer_id")
    return Q.row_differences(t.orders, cleaned.select(*t.orders.columns), "order_id")


@query("dq_numeric_drift")
def dq_numeric_drift(spark, d):
    """Stability of the item price from month to month."""
    return Q.numeric_drift(wide_table(spark, d, ["order_year_month", "price"]), "order_year_month", "price")


@query("dq_observed_write")
def dq_observed_write(spark, d):
    """What the write of the wide table counted on the way."""
    return Q.observed_write(wide_table(spark, d, by_month=True), _scratch(spark, "silver") + "/final_df")


@query("dq_drift")
def dq_drift(spark, d):
    o = features.add_year_month(clean.clean_orders(src(spark, d).orders))
    return Q.category_drift(o, "order_year_month", "order_status")


@query("dq_stats")
def dq_stats(spark, d):
    t = src(spark, d)
    return Q.summary_stats({"order_items": (t.order_items, ["price", "freight_value"]),
                            "order_payments": (t.order_payments, ["payment_value"]),
                            "products": (t.products, ["product_weight_g"])})


@query("dq_line_count")
def dq_line_count(spark, d):
    """Land the reviews as a headered CSV in the shared scratch folder, then
    compare physical lines with parsed records (messages hold newlines)."""
    import uuid
    from ..plans import sinks
    from ..sources.readers import layer_path
    root = sinks.scratch_root(spark)
    path = layer_path(f"{root}/landing-{uuid.uuid4().hex}", "raw", "order_reviews")
    sinks.write_csv(src(spark, d).order_reviews, path)
    return Q.line_count_check(spark, path, "order_reviews")


@query("dq_encoding")
def dq_encoding(spark, d):
    t = src(spark, d)
    return Q._union([Q.encoding_report(t.order_reviews, "order_reviews",
                                       ["review_comment_title", "review_comment_message"]),
                     Q.encoding_report(t.customers, "customers", ["customer_city"]),
                     Q.encoding_report(t.products, "products", ["product_category_name"])])


FRESHNESS_AS_OF = "2002-01-01"


@query("dq_freshness")
def dq_freshness(spark, d):
    t = src(spark, d)
    return Q._union([Q.freshness(t.orders, "order_purchase_timestamp", "orders", FRESHNESS_AS_OF, 30),
                     Q.freshness(t.order_items, "shipping_limit_date", "order_items", FRESHNESS_AS_OF, 30),
                     Q.freshness(t.order_reviews, "review_answer_timestamp", "order_reviews", FRESHNESS_AS_OF, 30)])


@query("dq_mask")
def dq_mask(spark, d):
    return Q.mask_customers(src(spark, d).customers)


#: stands for a key from a secret store
MASK_KEY = b"a key for tests"


@query("dq_mask_keyed")
def dq_mask_keyed(spark, d):
    return Q.mask_customers(src(spark, d).customers, MASK_KEY)


@query("dq_units")
def dq_units(spark, d):
    return Q.standardize_product_units(clean.clean_products(src(spark, d).products))


@query("dq_unit_table")
def dq_unit_table(spark, d):
    """The same by a join with the unit table, one row per measure."""
    return Q.standardize_units(clean.fill_products(src(spark, d).products), Q.unit_table(spark), {
        "product_weight_g": "g", "product_length_cm": "cm", "product_height_cm": "cm", "product_width_cm": "cm"})


@query("dq_deprecated")
def dq_deprecated(spark, d):
    t = src(spark, d)
    return Q._union([
        Q.deprecated_codes(t.order_payments, "order_payments", "payment_type",
                           LEGACY_CODES["order_payments.payment_type"]),
        Q.deprecated_codes(t.orders, "orders", "order_status", LEGACY_CODES["orders.order_status"]),
    ])


def _order_rules():
    p = F.col("order_purchase_timestamp")
    return {
        "approved_before_purchase": F.col("order_approved_at") < p,
        "delivered_before_purchase": F.col("order_delivered_customer_date") < p,
        "delivered_without_date": (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNull(),
        "late_delivery": F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"),
    }


def _item_rules():
    return {"price_not_positive": F.col("price") <= 0,
            "freight_negative": F.col("freight_value") < 0,
            "product_missing": F.col("item_product_id").isNull()}


@query("dq_failure_log")
def dq_failure_log(spark, d):
    s = silver(spark, d)
    item_id = F.concat_ws("-", "item_order_id", "item_order_item_id")
    return Q._union([Q.failure_log(s.orders, "orders", F.col("order_id"), _order_rules()),
                     Q.failure_log(s.items, "order_items", item_id, _item_rules())])


@query("dq_summary")
def dq_summary(spark, d):
    s = silver(spark, d)
    return Q._union([Q.failure_summary(s.orders, "orders", _order_rules()),
                     Q.failure_summary(s.items, "order_items", _item_rules())])


# --- step 10: sinks and the SQL surface ------------------------------------------------
from ..plans import sinks as S  # noqa: E402
from ..sources import readers as R  # noqa: E402


def _scratch(spark, what: str) -> str:
    import uuid
    return f"{S.scratch_root(spark)}/{what}-{uuid.uuid4().hex}"


@query("sink_roundtrip")
def sink_roundtrip(spark, d):
    """Wide table written partitioned by month, read back; rows and revenue
    per month partition."""
    path = _scratch(spark, "silver") + "/final_df"
    S.write_wide(wide_table(spark, d, by_month=True), path)
    back = R.read_table(spark, path)
    return back.groupBy("order_year_month").agg(F.count("*").alias("rows"), C.money_sum("price").alias("revenue"))


@query("bronze_roundtrip")
def bronze_roundtrip(spark, d):
    """The five cleaned tables written to the bronze layer and read back."""
    t = src(spark, d)
    root = _scratch(spark, "lake")
    cleaned = {"orders": clean.clean_orders(t.orders), "order_items": clean.clean_items(t.order_items),
               "products": clean.clean_products(t.products),
               "order_payments": clean.clean_payments(t.order_payments),
               "order_reviews": clean.clean_reviews(t.order_reviews)}
    frames = []
    for name, df in cleaned.items():
        path = R.layer_path(root, "bronze", name)
        S.write_parquet(df, path)
        frames.append(R.read_table(spark, path).agg(F.count("*").alias("row_count"))
                      .select(F.lit(name).alias("table_name"), "row_count"))
    from ..operators.quality import _union
    return _union(frames)


@query("sql_path_scan")
def sql_path_scan(spark, d):
    """``SELECT * FROM parquet.`path` ORDER BY order_year_month DESC``."""
    path = _scratch(spark, "silver") + "/final_df"
    S.write_wide(wide_table(spark, d, by_month=True), path)
    return S.path_scan(spark, path, order_by="order_year_month DESC").select(
        *ITEM_KEY, "order_year_month", "price", "aov_segment")


@query("sql_table_surface")
def sql_table_surface(spark, d):
    """External table over the written wide table (database created first),
    then the row-count and duplicate-order SQL run against it."""
    import uuid
    path = _scratch(spark, "silver") + "/final_df"
    S.write_wide(wide_table(spark, d, by_month=True), path)
    name = f"ordermart_prod.ecommerce_{uuid.uuid4().hex[:12]}"
    S.create_external_table(spark, name, path)
    return spark.sql(f"SELECT order_year_month, count(*) AS rows, count(DISTINCT order_id) AS orders "
                     f"FROM {name} GROUP BY order_year_month")


@query("k23_dim_orders_table")
def k23_table(spark, d):
    """Order dimension persisted as a catalog table over the shared folder."""
    import uuid
    path = _scratch(spark, "gold") + "/dim_orders"
    S.write_parquet(kpis.dim_orders(wide_table(spark, d, kpis.ORDER_DIMENSION)), path)
    name = f"ordermart_gold.dim_orders_{uuid.uuid4().hex[:12]}"
    return S.create_external_table(spark, name, path)


@query("delivery_sink")
def delivery_sink(spark, d):
    """Order-grain delivery facts written to bronze and read back."""
    path = _scratch(spark, "bronze") + "/delivery"
    S.write_parquet(features.delivery_table(clean.clean_orders(src(spark, d).orders)), path)
    return R.read_table(spark, path)


@query("stream_bronze_orders")
def stream_bronze_orders(spark, d):
    """Orders landed as CSV, ingested by an availableNow file stream with
    the row-level cleaner, read back from bronze."""
    from ..streaming import ingest
    root = _scratch(spark, "stream")
    landing = f"{root}/landing/orders"
    S.write_csv(src(spark, d).orders, landing)
    out = ingest.ingest_available(spark, landing, "orders", f"{root}/bronze/orders", f"{root}/checkpoint")
    return out.select(*[F.col(c).cast("timestamp_ntz") if c.endswith(("_timestamp", "_at", "_date")) else F.col(c)
                        for c in out.columns])


@query("managed_table")
def managed_table(spark, d):
    """Managed table partitioned by month, read back from the catalog."""
    import uuid
    name = f"ordermart_silver.final_{uuid.uuid4().hex[:12]}"
    S.create_database(spark, name.split(".")[0])
    S.save_table(wide_table(spark, d, by_month=True), name)
    return spark.table(name).groupBy("order_year_month").agg(F.count("*").alias("rows"), C.money_sum("price").alias("revenue"))


@query("bucketed_orders_items")
def bucketed_orders_items(spark, d):
    """Orders and items as managed tables bucketed by the order id: the join
    of the two needs no shuffle."""
    import uuid
    s, tag = silver(spark, d), uuid.uuid4().hex[:12]
    S.create_database(spark, "ordermart_silver")
    for name, df, key in (("orders", s.orders, "order_id"), ("items", s.items, "item_order_id")):
        S.save_bucketed(df, f"ordermart_silver.{name}_{tag}", key, int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders, items = (spark.table(f"ordermart_silver.{x}_{tag}") for x in ("orders", "items"))
    return orders.join(items, F.col("order_id") == F.col("item_order_id")).select(*wide.ORDER_COLUMNS, *wide.ITEM_COLUMNS)


@query("raw_csv_roundtrip")
def raw_csv_roundtrip(spark, d):
    """All nine source tables landed as headered CSV and read back with the
    declared schemas (multi-line text kept whole); row counts per table."""
    root = _scratch(spark, "landing")
    frames = []
    for name, df in src(spark, d).all().items():
        path = R.layer_path(root, "raw", name)
        S.write_csv(df, path)
        back = R.read_csv(spark, path, name)
        frames.append(back.agg(F.count("*").alias("row_count"),
                               F.count_if(F.col(back.columns[0]).isNull()).alias("null_first_column"))
                      .select(F.lit(name).alias("table_name"), "row_count", "null_first_column"))
    from ..operators.quality import _union
    return _union(frames)
