"""The wide order-item table: cleaned sources, pre-aggregates and eight joins.

Every dimension has one row per key (``preagg.one_per_key``; geolocation one
per zip), so the left joins never multiply rows and a build that does not
ask for a dimension's columns leaves its join out. Join plan:

1. items  <- products, sellers only when they are not small (joined while
                                             item rows are narrow)
2. orders <- customers, segments, payments/order, reviews/order
                                            (one row per order), then the
                                            order's features and month
3. (2) INNER (1) on order id               the only join of two large sides
4. <- small products/sellers, geolocation and category translation,
   broadcast after the shuffle, so the big shuffle carries only the narrow
   item columns.

Order-level tables meet the items exactly once. Building the table runs no
job, unless segment columns are asked for (``Silver.customer_segments``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..plans import physical
from . import clean, features, preagg, segments

ORDER_COLUMNS = ["order_id", "order_customer_id", "order_status", "order_purchase_timestamp",
                 "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
                 "order_estimated_delivery_date"]
ITEM_COLUMNS = ["item_order_id", "item_order_item_id", "item_product_id", "item_seller_id",
                "shipping_limit_date", "price", "freight_value"]
PRODUCT_COLUMNS = ["product_id", "product_name_lenght", "product_description_lenght",
                   "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                   "product_width_cm", "product_size"]
SELLER_COLUMNS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
PAYMENT_COLUMNS = ["payment_order_id", "max_payment_sequence", "payment_type", "payment_installments",
                   "payment_split_count", "payment_value", "payment_value_imputed"]
CUSTOMER_COLUMNS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                    "customer_state"]
REVIEW_COLUMNS = ["review_order_id", "review_scores", "review_titles", "review_message",
                  "review_creation_date", "review_answer_timestamp"]
REVIEW_SUMMARY_COLUMNS = ["review_order_id", "review_count", "review_score_sum", "review_score_n",
                          "any_title_no_review", "any_message_no_review", "review_creation_date",
                          "review_answer_timestamp"]
REVIEW_MODES = ("lists", "summary")
GEO_COLUMNS = list(preagg.GEO_ATTRS)
SEGMENT_COLUMNS = [segments.SEGMENT_KEY, "total_orders", "total_spent", "AOV", "aov_segment"]

# Column order of the joined table: the USING join on the category puts the
# merged key first.
JOINED_COLUMNS = (["product_category_name"] + ORDER_COLUMNS + ITEM_COLUMNS + PRODUCT_COLUMNS
                  + SELLER_COLUMNS + PAYMENT_COLUMNS + CUSTOMER_COLUMNS + REVIEW_COLUMNS + GEO_COLUMNS
                  + ["product_category_name_english"])
WIDE_COLUMNS = JOINED_COLUMNS + SEGMENT_COLUMNS + list(features.FEATURE_COLUMNS) + ["order_year_month"]

GEO_MODES = ("one_per_zip", "as_written")



def _table(src, name: str) -> DataFrame:
    return src[name] if isinstance(src, Mapping) else getattr(src, name)


class Silver:
    """Cleaned and pre-aggregated inputs of the wide table (all lazy; each is
    planned when it is first asked for)."""

    def __init__(self, src, geo_mode: str = "one_per_zip", review_mode: str = "lists", presence: bool = False):
        if geo_mode not in GEO_MODES:
            raise ValueError(f"geo_mode must be one of {GEO_MODES}")
        if review_mode not in REVIEW_MODES:
            raise ValueError(f"review_mode must be one of {REVIEW_MODES}")
        self.src, self.geo_mode, self.review_mode, self.presence = src, geo_mode, review_mode, presence

    def raw(self, name: str) -> DataFrame:
        return _table(self.src, name)

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return clean.clean_items(self.raw("order_items"))

    @cached_property
    def products(self) -> DataFrame:
        return preagg.one_per_key(clean.clean_products(self.raw("products")), "product_id")

    @cached_property
    def products_unsized(self) -> DataFrame:
        """Without ``product_size``, for builds that do not ask for it: no
        quartiles are computed."""
        return preagg.one_per_key(clean.fill_products(self.raw("products")), "product_id")

    @cached_property
    def payments(self) -> DataFrame:
        return self.payments_in(None)

    def payments_in(self, partitions: int | None, packed: bool = False) -> DataFrame:
        payments = _packed(clean.clean_payments(self.raw("order_payments")), packed, "payment_order_id")
        return preagg.payments_per_order(_dealt(payments, "payment_order_id", partitions))

    @cached_property
    def reviews(self) -> DataFrame:
        return self.reviews_in(None)

    def reviews_in(self, partitions: int | None, packed: bool = False) -> DataFrame:
        reviews = _packed(clean.clean_reviews(self.raw("order_reviews")), packed, "review_order_id", "review_id")
        reviews = _dealt(reviews, "review_order_id", partitions)
        if packed:
            reviews = reviews.withColumn("review_id", C.unpack_id("review_id"))
        if self.presence:       # of a text, whether there is one and whether it is the no-review marker
            reviews = reviews.withColumns({c: F.when(F.col(c) == C.NO_REVIEW, F.col(c)).when(F.col(c).isNotNull(), F.lit(""))
                                           for c in ("review_comment_title", "review_comment_message")})
        return (preagg.reviews_per_order(reviews) if self.review_mode == "lists"
                else preagg.review_summary_per_order(reviews))

    @cached_property
    def customers(self) -> DataFrame:
        return preagg.one_per_key(self.raw("customers"), "customer_id")

    @cached_property
    def sellers(self) -> DataFrame:
        return preagg.one_per_key(self.raw("sellers"), "seller_id")

    @cached_property
    def translation(self) -> DataFrame:
        return preagg.one_per_key(self.raw("category_translation"), "product_category_name")

    @cached_property
    def geo(self) -> DataFrame:
        return (preagg.geo_one_per_zip if self.geo_mode == "one_per_zip" else preagg.geo_dedupe)(self.raw("geolocation"))

    def fanout(self) -> DataFrame | None:
        """Rows each customer's items are repeated by the geolocation join
        (as-written mode only): points in the customer's zip, at least 1."""
        if self.geo_mode == "one_per_zip":
            return None
        points = self.geo.groupBy("geolocation_zip_code_prefix").agg(F.count("*").alias("_pts"))
        return (self.customers
                .join(points, F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left")
                .select(F.col("customer_id").alias("order_customer_id"),
                        F.greatest(F.coalesce("_pts", F.lit(0)), F.lit(1)).alias("k")))

    def customer_spend(self) -> DataFrame:
        return segments.customer_spend_from_orders(self.orders, self.items, self.fanout())

    @cached_property
    def _spend(self) -> DataFrame:
        """Written spend, with the item rows of each customer's largest order
        and a row for items without an order."""
        import uuid

        from ..plans.sinks import materialize
        spend = segments.customer_spend_from_orders(self.orders, self.items, self.fanout(), largest_order=True)
        return materialize(spend, spend.sparkSession, f"customer_spend-{uuid.uuid4().hex}")

    @cached_property
    def _segments(self) -> DataFrame:
        return segments.segment_customers(self._spend.filter(F.col("order_customer_id").isNotNull()).drop("largest_order"))

    @cached_property
    def row_figures(self) -> tuple[int, int]:
        """Item rows (as often as the wide table repeats them), and those of
        the order id that has most, whether there is such an order or not;
        read from the written spend table (one row per customer)."""
        found = self._spend.agg(F.sum("total_orders"), F.max("largest_order")).first()
        return found[0] or 0, found[1] or 0

    def customer_segments(self) -> DataFrame:
        """AOV segments. The spend table (one row per customer, from a scan
        of all items) is read by the percentiles and by the banding, so it is
        written once to the shared folder, which also cuts the lineage: this
        is the one build step that runs a job (``row_figures`` reads its
        totals)."""
        return self._segments


def _dealt(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    return df.repartition(partitions, key) if partitions else df


def _packed(df: DataFrame, packed: bool, *ids: str) -> DataFrame:
    """With packed ids; rows whose first one is null join nothing and go."""
    return df.filter(F.col(ids[0]).isNotNull()).withColumns({c: C.pack_id(c) for c in ids}) if packed else df


def _attach(df: DataFrame, dim: DataFrame, raw: DataFrame, cond, max_bytes: int | None) -> DataFrame:
    """Left join of a dimension, broadcast when its raw table is small."""
    return df.join(F.broadcast(dim) if physical.is_small(raw, max_bytes) else dim, cond, "left")


def _attach_item_dims(df: DataFrame, silver: Silver, needed: set[str], max_bytes: int | None,
                      small: bool) -> DataFrame:
    """Join those of products and sellers that are needed and small (after
    the order join) or not small (before it, while rows are narrow)."""
    products = silver.products if "product_size" in needed else silver.products_unsized
    translated = {"product_category_name", "product_category_name_english"}
    for name, dim, columns, cond in (
        ("products", products, {*PRODUCT_COLUMNS, *translated}, F.col("item_product_id") == F.col("product_id")),
        ("sellers", silver.sellers, set(SELLER_COLUMNS), F.col("item_seller_id") == F.col("seller_id")),
    ):
        if needed & columns and physical.is_small(silver.raw(name), max_bytes) == small:
            df = _attach(df, dim, silver.raw(name), cond, max_bytes)
    return df


ZIP_ROWS = 1_000_000        # item rows of a zip that one task joins with the zip's points


def _attach_points(df: DataFrame, silver: "Silver", rows: int | None = None) -> DataFrame:
    """Left join of every point of the customer's zip, for a geolocation that
    is not small. A zip with many item rows is cut into slices of about
    ``rows`` of them: its items are dealt out by their key, its points are
    repeated once for each slice. Slices come from a count of items by zip
    over narrow columns; zips of one slice are not in that table."""
    per_order = silver.items.groupBy("item_order_id").agg(F.count("*").alias("_n"))
    per_zip = (silver.orders.select("order_id", "order_customer_id")
               .join(per_order, F.col("order_id") == F.col("item_order_id"))
               .join(silver.customers.select("customer_id", "customer_zip_code_prefix"),
                     F.col("order_customer_id") == F.col("customer_id"))
               .groupBy(F.col("customer_zip_code_prefix").alias("_zip")).agg(F.sum("_n").alias("_n")))
    cut = (per_zip.withColumn("_slices", F.ceil(F.col("_n") / F.lit(rows or ZIP_ROWS)).cast("int"))
           .filter("_slices > 1").select("_zip", "_slices"))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    points = (silver.geo.join(cut, F.col("geolocation_zip_code_prefix") == F.col("_zip"), "left")
              .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("_zip", "_slices"))
    items = (df.join(cut, F.col("customer_zip_code_prefix") == F.col("_zip"), "left")
             .withColumn("_of", F.pmod(F.xxhash64("order_id", "item_order_item_id"), slices).cast("int")).drop("_zip", "_slices"))
    return items.join(points, (F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"))
                      & (F.col("_of") == F.col("_slice")), "left").drop("_of", "_slice")


def order_side(silver: Silver, needed: set[str], partitions: int | None = None, packed: bool = False) -> DataFrame:
    """One row per order with what is needed of customer, segment, payments
    and reviews. Customer-keyed joins come first and order-keyed ones last,
    so orders are shuffled once per key (by order into ``partitions``, or as
    many as the session names). ``packed`` shuffles the order's and the
    customer's unique id packed, and leaves the packed order id in
    ``_order``, by which the rows are partitioned."""
    o = _packed(silver.orders, packed, "order_id")
    customers = silver.customers
    if packed:
        customers = customers.withColumn("customer_unique_id", C.pack_id("customer_unique_id"))
    if needed & set(SEGMENT_COLUMNS):
        # customers and segments share their key: combined first (full outer
        # keeps segments of customers missing from the customer table), so
        # orders meet customer data in one join that AQE can split
        seg = segments.segments_for_join(silver.customer_segments())
        cust = (customers.join(seg, F.col("customer_id") == F.col(segments.SEGMENT_KEY), "full")
                .withColumn("_cust_key", F.coalesce(F.col("customer_id"), F.col(segments.SEGMENT_KEY))))
        o = o.join(cust, F.col("order_customer_id") == F.col("_cust_key"), "left").drop("_cust_key")
    elif needed & {*CUSTOMER_COLUMNS, *GEO_COLUMNS}:
        o = o.join(customers, F.col("order_customer_id") == F.col("customer_id"), "left")
    o = _dealt(o, "order_id", partitions)
    if needed & set(PAYMENT_COLUMNS):
        o = o.join(silver.payments_in(partitions, packed), F.col("order_id") == F.col("payment_order_id"), "left")
    if needed & {*REVIEW_COLUMNS, *REVIEW_SUMMARY_COLUMNS}:
        o = o.join(silver.reviews_in(partitions, packed), F.col("order_id") == F.col("review_order_id"), "left")
    if packed:
        o = o.withColumn("_order", F.col("order_id")).withColumn("order_id", C.unpack_id("_order"))
        same = {c: F.when(F.col(c).isNotNull(), F.col("order_id")) for c in ("payment_order_id", "review_order_id") if c in o.columns}
        whose = {"customer_unique_id": C.unpack_id("customer_unique_id")} if "customer_unique_id" in o.columns else {}
        o = o.withColumns(same | whose)
    return o


def order_item_join(orders: DataFrame, items: DataFrame) -> DataFrame:
    """INNER join of order-grain rows with item rows on the order id, safe
    for an order that holds a large share of all items.

    AQE splits a skewed partition only where both inputs come straight from
    a shuffle, but the order side leaves its own joins partitioned by order
    id already. The join is therefore keyed by (hash of the id, id): no input
    has that partitioning, so both are shuffled and AQE can split a hot order
    (``SortMergeJoin(skew=true)``)."""
    return orders.join(items, (F.xxhash64("order_id") == F.xxhash64("item_order_id"))
                       & (F.col("order_id") == F.col("item_order_id")), "inner")


ORDER_ROWS = 100_000        # most item rows of an order for which monthly_join is used
TASK_ROWS = 500_000         # wide rows of a task that writes them


def monthly_join(orders: DataFrame, items: DataFrame) -> DataFrame:
    """INNER join on the order id whose rows leave each task in order of
    month, for a partitioned write: the order rows of a task are sorted by
    month while there is one per order, and look up their items, so the wide
    rows need no sort. The order side stays as its own joins left it; only
    the narrow items are shuffled. For orders of a bounded number of items:
    those of one partition are held in memory. Both sides come with packed
    order ids (``order_side``).

    Spark drops a sort below a join, whose order nothing relies on in
    general, but not below the filter on a row number (always true)."""
    ordered = orders.sortWithinPartitions("order_year_month").filter(F.monotonically_increasing_id() >= 0)
    joined = ordered.join(items.hint("shuffle_hash"), F.col("_order") == F.col("item_order_id"), "inner")
    return joined.withColumn("item_order_id", F.col("order_id"))


#: joined columns that features read
_FEATURE_INPUTS = {
    "order_revenue": {"price", "freight_value"}, "is_payment_missing": {"payment_value"},
    "has_review": {"review_titles", "review_message", "review_count", "any_title_no_review", "any_message_no_review"},
    "time_from_delivery_to_review": {"review_creation_date"},
    "time_to_response": {"review_creation_date", "review_answer_timestamp"},
}


def _present(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """0 for each value and null for each null, except in the keys of joins
    that are still to come."""
    return df.select(*[F.col(c) if c in keys else F.when(F.col(c).isNotNull(), F.lit(0)).alias(c) for c in df.columns])


def join_wide(silver: Silver, needed: Iterable[str] | None = None, *, partitions: int | None = None,
              max_bytes: int | None = None, order_features: Mapping[str, Column] | None = None,
              by_month: bool = False) -> DataFrame:
    """The joins that the needed columns ask for (all by default), without
    features: rows = items with a matching order (times the geolocation
    fan-out in as-written mode). ``order_features`` are columns to derive
    from the order side, before the items are joined. ``by_month`` joins by
    ``monthly_join`` where no order is too large for it, in as many
    partitions as keep a task to ``TASK_ROWS`` rows; otherwise by
    ``order_item_join``."""
    every = joined_columns(silver.review_mode) + SEGMENT_COLUMNS
    needed = set(every if needed is None else needed)
    dealt = None
    if by_month:
        rows, largest = silver.row_figures
        by_month = largest <= ORDER_ROWS
        cores = silver.orders.sparkSession.sparkContext.defaultParallelism
        dealt = max(cores, -(-rows // TASK_ROWS)) if by_month else None
    orders_part = order_side(silver, needed, dealt, packed=by_month).withColumns(dict(order_features or {}))
    items = _attach_item_dims(_packed(silver.items, by_month, "item_order_id"), silver, needed, max_bytes, small=False)
    if silver.presence:
        orders_part = _present(orders_part, {"order_id", "customer_zip_code_prefix"})
        items = _present(items, {"item_order_id", "item_product_id", "item_seller_id", "product_category_name"})
    if partitions:
        orders_part = orders_part.repartition(partitions, "order_id")
        items = items.repartition(partitions, "item_order_id")
        wide = orders_part.join(items, F.col("order_id") == F.col("item_order_id"), "inner")
    elif by_month:
        wide = monthly_join(orders_part, _dealt(items, "item_order_id", dealt))
    else:
        wide = order_item_join(orders_part, items)
    wide = _attach_item_dims(wide, silver, needed, max_bytes, small=True)
    if needed & set(GEO_COLUMNS) or silver.geo_mode == "as_written":
        if "customer_zip_code_prefix" not in wide.columns:
            raise ValueError("as_written geolocation needs a customer or geolocation column")
        if silver.geo_mode == "as_written" and not physical.is_small(silver.raw("geolocation"), max_bytes):
            wide = _attach_points(wide, silver)
        else:
            wide = _attach(wide, silver.geo, silver.raw("geolocation"),
                           F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), max_bytes)
    if "product_category_name_english" in needed:
        dim = silver.translation.withColumnRenamed("product_category_name", "_category")
        wide = _attach(wide, dim, silver.raw("category_translation"),
                       F.col("product_category_name") == F.col("_category"), max_bytes)
    return wide.select(*[c for c in every if c in needed], *(order_features or {}))


def joined_columns(review_mode: str = "lists") -> list[str]:
    if review_mode == "lists":
        return list(JOINED_COLUMNS)
    i = JOINED_COLUMNS.index(REVIEW_COLUMNS[0])
    return JOINED_COLUMNS[:i] + REVIEW_SUMMARY_COLUMNS + JOINED_COLUMNS[i + len(REVIEW_COLUMNS):]


def wide_columns(review_mode: str = "lists") -> list[str]:
    return joined_columns(review_mode) + SEGMENT_COLUMNS + list(features.FEATURE_COLUMNS) + ["order_year_month"]


def build_wide(src, columns: Iterable[str] | None = None, *, geo_mode: str = "one_per_zip", review_mode: str = "lists",
               partitions: int | None = None, max_bytes: int | None = None,
               keep_sentinels: bool = False, as_written_review_label: bool = False, presence: bool = False,
               by_month: bool = False) -> DataFrame:
    """The wide table with features and ``order_year_month``: 72 columns with
    per-order review lists (the original data model), or with the
    constant-size review summary (``review_mode="summary"``) when an order
    may carry unbounded reviews. With ``columns`` only these are built, and
    only the joins that they need are in the plan. ``presence`` builds the
    same rows and columns for null counts: what is null is null, and other
    values need not be kept, so the joins carry keys and marks instead of
    texts. Features that hold for a whole order are derived once an order,
    before its items are joined. ``by_month`` is for a build that is written
    partitioned by month: its rows leave each task in order of month
    (``monthly_join``); it needs segment columns, whose spend table tells the
    size of the largest order."""
    silver = src if isinstance(src, Silver) else Silver(src, geo_mode, review_mode, presence)
    every = wide_columns(silver.review_mode)
    wanted = every if columns is None else list(columns)
    unknown = set(wanted) - set(every)
    if unknown:
        raise ValueError(f"not columns of the wide table: {sorted(unknown)}")
    joined = set(joined_columns(silver.review_mode)) | set(SEGMENT_COLUMNS)
    needed = (set(wanted) & joined) | set().union(*[_FEATURE_INPUTS.get(c, set()) for c in wanted]) & joined
    needed |= {"order_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
               "order_estimated_delivery_date"}
    if silver.geo_mode == "as_written":
        needed.add("customer_zip_code_prefix")
    derived = features.feature_columns(keep_sentinels=keep_sentinels, as_written_review_label=as_written_review_label,
                                       review_summary=silver.review_mode == "summary")
    derived = {n: e for n, e in derived.items() if n in wanted}
    early = {n: e for n, e in derived.items() if n not in features.ITEM_FEATURES} | {"order_year_month": features.year_month()}
    wide = join_wide(silver, needed, partitions=partitions, max_bytes=max_bytes, order_features=early,
                     by_month=by_month and not (partitions or silver.presence) and bool(needed & set(SEGMENT_COLUMNS)))
    return wide.withColumns({n: e for n, e in derived.items() if n in features.ITEM_FEATURES}).select(*wanted)
