"""Independent SQL oracle (DuckDB dialect) for the registered queries.

Written directly in SQL from the operator definitions, not generated from
the Spark code. The tables ``orders lineitem customer supplier part events
conversations`` are pre-registered views. Money rounding mirrors Spark's
half-up rounding of the shortest decimal form of a double by rounding the
value as ``DECIMAL(38,10)``.
"""

from __future__ import annotations


def r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def r4(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), 4) AS DOUBLE)"


def total(x: str, places: int = 2) -> str:
    """Exact decimal total, as a double."""
    return f"CAST(sum(CAST({x} AS DECIMAL({16 + places},{places}))) AS DOUBLE)"


def ordered_text(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda e: coalesce(CAST(e AS VARCHAR), 'null')), ',')"


def sorted_text(x: str) -> str:
    return f"array_to_string(list_sort(list_transform({x}, lambda e: CAST(e AS VARCHAR))), ',')"


def date_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


SOURCES = """
src_orders AS (
  SELECT md5(CAST(o_orderkey AS VARCHAR)) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'canceled'
              ELSE CASE WHEN o_orderkey % 10 = 0 THEN 'invoiced' ELSE 'shipped' END END AS order_status,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE o_orderdate + to_hours(CAST(o_orderkey % 24 + 1 AS INTEGER)) END AS order_approved_at,
         o_orderdate + to_days(2) AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 19 <> 0
              THEN o_orderdate + to_days(CAST(5 + o_orderkey % 30 AS INTEGER)) END AS order_delivered_customer_date,
         o_orderdate + to_days(20) AS order_estimated_delivery_date
  FROM orders),
src_order_items AS (
  SELECT md5(CAST(l_orderkey AS VARCHAR)) AS order_id,
         CAST(l_linenumber AS VARCHAR) AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_orderkey % 101 = 7 THEN '-1' ELSE CAST(l_suppkey AS VARCHAR) END AS seller_id,
         l_shipdate AS shipping_limit_date,
         l_extendedprice AS price,
         l_quantity AS freight_value
  FROM lineitem),
src_order_payments AS (
  SELECT md5(CAST(k AS VARCHAR)) AS order_id,
         CAST(row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS INTEGER) AS payment_sequential,
         CASE event_type WHEN 'view' THEN 'boleto' WHEN 'click' THEN 'credit_card'
              WHEN 'purchase' THEN 'debit_card' WHEN 'signup' THEN 'voucher' ELSE 'not_defined' END AS payment_type,
         CAST(event_id % 12 + 1 AS INTEGER) AS payment_installments,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS payment_value
  FROM (SELECT *, CASE WHEN event_id % 10 = 0 THEN event_id + 1 ELSE event_id END AS k FROM events)),
review_keys AS (
  SELECT k, k % 365 AS conv, k % 7 AS t, CASE WHEN k % 7 = 0 THEN k + 1 ELSE k END AS about, o.conv_id, o.lap % s.turns AS turn
  FROM (SELECT o_orderkey AS k, o_orderkey % (SELECT max(conv_id) + 1 FROM conversations) AS conv_id,
               o_orderkey // (SELECT max(conv_id) + 1 FROM conversations) AS lap FROM orders) o
  JOIN (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id) s ON o.conv_id = s.conv_id),
src_order_reviews AS (
  SELECT md5('r' || CAST(k AS VARCHAR)) AS review_id,
         CASE WHEN k % 11 = 3 THEN '2018-01-01 10:00:00' ELSE md5(CAST(about AS VARCHAR)) END AS order_id,
         CASE WHEN (conv + t) % 6 = 0 THEN NULL ELSE CAST((conv + t) % 6 AS INTEGER) END AS review_score,
         CASE WHEN (conv + t) % 3 = 0 THEN NULL ELSE role END AS review_comment_title,
         CASE WHEN (conv + t) % 2 = 0 THEN NULL ELSE text END AS review_comment_message,
         CASE WHEN (conv + t) % 9 = 0 THEN NULL
              ELSE CAST(TIMESTAMP '1998-01-01 00:00:00' + to_days(CAST(conv AS INTEGER)) AS DATE) END AS review_creation_date,
         TIMESTAMP '1998-01-01 00:00:00' + to_days(CAST(conv + t AS INTEGER)) AS review_answer_timestamp
  FROM review_keys rk JOIN conversations c ON rk.conv_id = c.conv_id AND rk.turn = c.turn),
src_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS product_category_name,
         CAST(length(p_name) AS INTEGER) AS product_name_lenght,
         CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_size * 10 END AS product_description_lenght,
         CAST(p_partkey % 6 AS INTEGER) AS product_photos_qty,
         CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_retailprice END AS product_weight_g,
         CAST(p_size AS DOUBLE) AS product_length_cm,
         CAST(p_size % 10 AS DOUBLE) AS product_height_cm,
         CAST(p_size % 7 AS DOUBLE) AS product_width_cm
  FROM part),
src_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
         lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         s_name AS seller_city,
         'S' || CAST(s_nationkey % 5 AS VARCHAR) AS seller_state
  FROM supplier),
src_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         md5(c_name) AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         c_mktsegment AS customer_city,
         'S' || CAST(c_nationkey % 5 AS VARCHAR) AS customer_state
  FROM customer),
src_geolocation AS (
  SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
         s_nationkey + CAST(s_suppkey % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS geolocation_lat,
         CAST(-s_nationkey AS DOUBLE) AS geolocation_lng,
         s_name AS geolocation_city,
         'S' || CAST(s_nationkey % 5 AS VARCHAR) AS geolocation_state
  FROM supplier),
src_category_translation AS (
  SELECT DISTINCT p_type AS product_category_name,
         CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS product_category_name_english
  FROM part)
"""

CLEAN = r"""
reviews_flagged AS (
  SELECT review_id,
         order_id AS review_order_id,
         coalesce(review_score, -1) AS review_score,
         CASE WHEN review_comment_title IS NULL AND review_comment_message IS NULL THEN 'No Review'
              ELSE coalesce(review_comment_title, 'Review Given') END AS review_comment_title,
         CASE WHEN review_comment_title IS NULL AND review_comment_message IS NULL THEN 'No Review'
              ELSE coalesce(review_comment_message, 'Review Given') END AS review_comment_message,
         coalesce(review_creation_date, DATE '1900-01-01') AS review_creation_date,
         coalesce(review_answer_timestamp, TIMESTAMP '1900-01-01 00:00:00') AS review_answer_timestamp,
         CASE WHEN review_comment_title IS NULL AND review_comment_message IS NULL THEN 'No Comment'
              ELSE 'Has Comment' END AS has_review
  FROM src_order_reviews
  WHERE review_id IS NOT NULL AND order_id IS NOT NULL),
clean_reviews AS (
  SELECT * FROM reviews_flagged WHERE NOT regexp_matches(review_order_id, '^\d{4}-\d{2}-\d{2}.*')),
clean_orders AS (
  SELECT order_id, customer_id AS order_customer_id, order_status, order_purchase_timestamp,
         coalesce(CASE WHEN order_status = 'delivered' AND order_approved_at IS NULL
                       THEN order_purchase_timestamp ELSE order_approved_at END,
                  TIMESTAMP '1900-01-01 00:00:00') AS order_approved_at,
         order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
  FROM src_orders
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL),
products_filled AS (
  SELECT product_id,
         coalesce(product_category_name, 'Unknown') AS product_category_name,
         coalesce(product_name_lenght, 0) AS product_name_lenght,
         coalesce(product_description_lenght, 0) AS product_description_lenght,
         coalesce(product_photos_qty, 0) AS product_photos_qty,
         coalesce(product_weight_g, 0) AS product_weight_g,
         coalesce(product_length_cm, 0) AS product_length_cm,
         coalesce(product_height_cm, 0) AS product_height_cm,
         coalesce(product_width_cm, 0) AS product_width_cm
  FROM src_products),
clean_products AS (
  SELECT *,
         CASE WHEN product_weight_g <= (SELECT quantile_disc(product_weight_g, 0.25) FROM products_filled) THEN 'Small'
              WHEN product_weight_g <= (SELECT quantile_disc(product_weight_g, 0.5) FROM products_filled) THEN 'Medium'
              WHEN product_weight_g <= (SELECT quantile_disc(product_weight_g, 0.75) FROM products_filled) THEN 'Large'
              ELSE 'Extra Large' END AS product_size
  FROM products_filled),
clean_payments AS (
  SELECT order_id AS payment_order_id, payment_sequential,
         CASE payment_type WHEN 'boleto' THEN 'Bank Transfer' WHEN 'credit_card' THEN 'Credit Card'
              WHEN 'debit_card' THEN 'Debit Card' WHEN 'voucher' THEN 'Voucher' ELSE 'other' END AS payment_type,
         payment_installments, payment_value,
         coalesce(payment_value, (SELECT CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DOUBLE) / count(payment_value) FROM src_order_payments)) AS payment_value_imputed
  FROM src_order_payments),
clean_items AS (
  SELECT order_id AS item_order_id, order_item_id AS item_order_item_id, product_id AS item_product_id,
         seller_id AS item_seller_id, shipping_limit_date, price, freight_value
  FROM src_order_items)
"""

PREAGG = f"""
pay_agg AS (
  SELECT payment_order_id,
         max(payment_sequential) AS max_payment_sequence,
         list(DISTINCT payment_type) AS payment_type,
         CAST(sum(payment_installments) AS BIGINT) AS payment_installments,
         count(*) AS payment_split_count,
         {total('payment_value')} AS payment_value,
         {r2(total('payment_value_imputed', 10))} AS payment_value_imputed
  FROM clean_payments GROUP BY payment_order_id),
rev_agg AS (
  SELECT review_order_id,
         list(review_score ORDER BY review_id) AS review_scores,
         list(review_comment_title ORDER BY review_id) AS review_titles,
         list(review_comment_message ORDER BY review_id) AS review_message,
         min(review_creation_date) AS review_creation_date,
         min(review_answer_timestamp) AS review_answer_timestamp
  FROM clean_reviews GROUP BY review_order_id),
geo_zip AS (
  SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
  FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                                     ORDER BY geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) AS rn
        FROM src_geolocation) WHERE rn = 1),
geo_dedup AS (
  SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
  FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_lat, geolocation_lng
                                     ORDER BY geolocation_zip_code_prefix, geolocation_city, geolocation_state) AS rn
        FROM src_geolocation) WHERE rn = 1)
"""


def joined(geo: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT p.product_category_name, o.*, i.*, p.* EXCLUDE (product_category_name), s.*, pa.*, c.*, r.*, g.*,
         t.product_category_name_english
  FROM clean_orders o
  JOIN clean_items i ON o.order_id = i.item_order_id
  LEFT JOIN clean_products p ON i.item_product_id = p.product_id
  LEFT JOIN src_sellers s ON i.item_seller_id = s.seller_id
  LEFT JOIN pay_agg pa ON o.order_id = pa.payment_order_id
  LEFT JOIN src_customers c ON o.order_customer_id = c.customer_id
  LEFT JOIN rev_agg r ON o.order_id = r.review_order_id
  LEFT JOIN {geo} g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix
  LEFT JOIN src_category_translation t ON p.product_category_name = t.product_category_name)"""


def spend(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT order_customer_id, count(order_id) AS total_orders,
         {total('price')} AS total_spent,
         {r2(total('price') + ' / count(price)')} AS AOV, count(DISTINCT order_id) AS distinct_orders,
         {r2(total('price') + ' / count(DISTINCT order_id)')} AS avg_order_value
  FROM {src} GROUP BY order_customer_id)"""


def segmented(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN AOV >= (SELECT quantile_disc(AOV, 0.75) FROM {src}) THEN 'High'
                 WHEN AOV < (SELECT quantile_disc(AOV, 0.25) FROM {src}) THEN 'Low'
                 ELSE 'Medium' END AS aov_segment
  FROM {src})"""


def not_sentinel(x: str) -> str:
    return f"CASE WHEN CAST({x} AS DATE) <> DATE '1900-01-01' THEN {x} END"


def days(a: str, b: str) -> str:
    """Spark datediff(end=a, start=b): calendar days."""
    return f"CAST(datediff('day', CAST({b} AS DATE), CAST({a} AS DATE)) AS INTEGER)"


FEATURES = f"""
  CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
  CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS is_canceled,
  price + freight_value AS order_revenue,
  CASE WHEN payment_value IS NULL THEN 1 ELSE 0 END AS is_payment_missing,
  CASE WHEN (list_contains(review_titles, 'No Review') AND list_contains(review_message, 'No Review'))
            OR review_titles IS NULL THEN 'No Reivew' ELSE 'Has Comment' END AS has_review,
  {days(not_sentinel('review_creation_date'), 'order_delivered_customer_date')} AS time_from_delivery_to_review,
  {days(not_sentinel('review_answer_timestamp'), not_sentinel('review_creation_date'))} AS time_to_response,
  CAST(hour(order_purchase_timestamp) AS INTEGER) AS hour_of_day,
  CASE WHEN dayofweek(order_purchase_timestamp) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS order_day_type,
  {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS actual_delivery_time,
  {days('order_estimated_delivery_date', 'order_purchase_timestamp')} AS estimated_delivery_time,
  {days('order_delivered_customer_date', 'order_purchase_timestamp')}
    - {days('order_estimated_delivery_date', 'order_purchase_timestamp')} AS delivery_delay_time,
  CASE WHEN {days('order_delivered_customer_date', 'order_purchase_timestamp')}
            - {days('order_estimated_delivery_date', 'order_purchase_timestamp')} > 0 THEN 1 ELSE 0 END AS is_late,
  strftime(order_purchase_timestamp, '%Y-%m') AS order_year_month"""


def wide(geo: str = "geo_zip", name: str = "wide") -> str:
    j, sp, sg = f"{name}_joined", f"{name}_spend", f"{name}_seg"
    return ",".join([
        joined(geo, j), spend(j, sp), segmented(sp, sg),
        f"""
{name} AS (
  SELECT {j}.*, {sg}.order_customer_id AS order_customer_id_customer_segmented,
         {sg}.total_orders, {sg}.total_spent, {sg}.AOV, {sg}.aov_segment,
         {FEATURES}
  FROM {j} LEFT JOIN {sg} ON {j}.order_customer_id = {sg}.order_customer_id)"""])


BASE = ",".join([SOURCES, CLEAN, PREAGG, wide("geo_zip", "wide"), wide("geo_dedup", "wide_aw")])


def with_base(body: str) -> str:
    return f"WITH {BASE}\n{body}"


ITEM_KEY = "order_id, item_order_item_id"
MASK_KEY = b"a key for tests"

# --- per-key query bodies -------------------------------------------------------------
BODIES: dict[str, str] = {}

BODIES["k09_top_products"] = f"""
SELECT product_id, product_category_name_english, {total('price')} AS top_10_most_sold_product
FROM wide WHERE order_status = 'delivered'
GROUP BY product_id, product_category_name_english
ORDER BY top_10_most_sold_product DESC NULLS LAST, product_id ASC NULLS FIRST,
         product_category_name_english ASC NULLS FIRST
LIMIT 10"""

REVIEW_COLS = (f"review_id, review_order_id, review_score, review_comment_title, review_comment_message, "
               f"{date_text('review_creation_date')} AS review_creation_date, review_answer_timestamp, has_review")
BODIES["clean_reviews"] = f"SELECT {REVIEW_COLS} FROM clean_reviews"
BODIES["clean_reviews_invalid"] = (f"SELECT {REVIEW_COLS} FROM reviews_flagged "
                                   r"WHERE regexp_matches(review_order_id, '^\d{4}-\d{2}-\d{2}.*')")
BODIES["clean_orders"] = "SELECT * FROM clean_orders"
BODIES["clean_products_size"] = "SELECT * FROM clean_products"
BODIES["clean_products_size_present"] = """
SELECT *, CASE WHEN product_weight_g <= (SELECT quantile_disc(product_weight_g, 0.25) FROM src_products) THEN 'Small'
               WHEN product_weight_g <= (SELECT quantile_disc(product_weight_g, 0.5) FROM src_products) THEN 'Medium'
               WHEN product_weight_g <= (SELECT quantile_disc(product_weight_g, 0.75) FROM src_products) THEN 'Large'
               ELSE 'Extra Large' END AS product_size
FROM products_filled"""
BODIES["clean_payments_mean"] = "SELECT * FROM clean_payments"
BODIES["clean_items_rename"] = "SELECT * FROM clean_items"
BODIES["k22_weight_freq"] = "SELECT product_weight_g, count(*) AS count FROM clean_products GROUP BY 1"

BODIES["payments_per_order"] = f"""
SELECT payment_order_id, max_payment_sequence, {sorted_text('payment_type')} AS payment_type,
       payment_installments, payment_split_count, payment_value, payment_value_imputed
FROM pay_agg"""
BODIES["reviews_per_order"] = f"""
SELECT review_order_id, {ordered_text('review_scores')} AS review_scores,
       {ordered_text('review_titles')} AS review_titles, {ordered_text('review_message')} AS review_message,
       {date_text('review_creation_date')} AS review_creation_date, review_answer_timestamp
FROM rev_agg"""
BODIES["reviews_in_chunks"] = BODIES["reviews_per_order"].replace("SELECT review_order_id,", "SELECT review_order_id, 0 AS chunk,")
BODIES["review_summary_per_order"] = f"""
SELECT review_order_id, count(*) AS review_count,
       CAST(sum(CASE WHEN review_score <> -1 THEN review_score END) AS BIGINT) AS review_score_sum,
       count(CASE WHEN review_score <> -1 THEN review_score END) AS review_score_n,
       bool_or(review_comment_title = 'No Review') AS any_title_no_review,
       bool_or(review_comment_message = 'No Review') AS any_message_no_review,
       {date_text('min(review_creation_date)')} AS review_creation_date,
       min(review_answer_timestamp) AS review_answer_timestamp
FROM clean_reviews GROUP BY review_order_id"""
BODIES["wide_review_summary"] = f"""
SELECT w.order_id, w.item_order_item_id, s.review_order_id, s.review_count, s.review_score_sum, s.review_score_n,
       s.any_title_no_review, s.any_message_no_review,
       {date_text('w.review_creation_date')} AS review_creation_date, w.review_answer_timestamp,
       w.has_review, w.time_from_delivery_to_review
FROM wide w LEFT JOIN (
  SELECT review_order_id, count(*) AS review_count,
         CAST(sum(CASE WHEN review_score <> -1 THEN review_score END) AS BIGINT) AS review_score_sum,
         count(CASE WHEN review_score <> -1 THEN review_score END) AS review_score_n,
         bool_or(review_comment_title = 'No Review') AS any_title_no_review,
         bool_or(review_comment_message = 'No Review') AS any_message_no_review
  FROM clean_reviews GROUP BY review_order_id) s ON w.order_id = s.review_order_id"""
BODIES["geo_dedupe"] = "SELECT * FROM geo_dedup"
BODIES["geo_one_per_zip"] = "SELECT * FROM geo_zip"

ORDER_COLS = ("order_id, order_customer_id, order_status, order_purchase_timestamp, order_approved_at, "
              "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date")
ITEM_COLS = ("item_order_id, item_order_item_id, item_product_id, item_seller_id, shipping_limit_date, "
             "price, freight_value")
PRODUCT_COLS = ("product_id, product_name_lenght, product_description_lenght, product_photos_qty, "
                "product_weight_g, product_length_cm, product_height_cm, product_width_cm, product_size")
WHOLE_ROW = f"""* REPLACE ({sorted_text('payment_type')} AS payment_type, {ordered_text('review_scores')} AS review_scores,
    {ordered_text('review_titles')} AS review_titles, {ordered_text('review_message')} AS review_message,
    {date_text('review_creation_date')} AS review_creation_date)"""
BODIES["orders_items_inner"] = f"SELECT {ORDER_COLS}, {ITEM_COLS} FROM wide"
BODIES["wide_left_products"] = (f"SELECT {ITEM_KEY}, item_product_id, product_category_name, {PRODUCT_COLS} "
                                "FROM wide")
BODIES["wide_left_sellers"] = (f"SELECT {ITEM_KEY}, item_seller_id, seller_id, seller_zip_code_prefix, "
                               "seller_city, seller_state FROM wide")
BODIES["wide_left_payments"] = (f"SELECT {ITEM_KEY}, payment_order_id, max_payment_sequence, "
                                f"{sorted_text('payment_type')} AS payment_type, payment_installments, "
                                "payment_split_count, payment_value, payment_value_imputed FROM wide")
BODIES["wide_left_customers"] = (f"SELECT {ITEM_KEY}, order_customer_id, customer_id, customer_unique_id, "
                                 "customer_zip_code_prefix, customer_city, customer_state FROM wide")
BODIES["wide_left_reviews"] = f"""
SELECT {ITEM_KEY}, review_order_id, {ordered_text('review_scores')} AS review_scores,
       {ordered_text('review_titles')} AS review_titles, {ordered_text('review_message')} AS review_message,
       {date_text('review_creation_date')} AS review_creation_date, review_answer_timestamp
FROM wide"""
GEO_COLS = ("geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, "
            "geolocation_state")
BODIES["wide_geo_default"] = f"SELECT {ITEM_KEY}, customer_zip_code_prefix, {GEO_COLS} FROM wide"
BODIES["wide_geo_as_written"] = f"""
SELECT customer_zip_code_prefix, geolocation_lat, geolocation_lng, count(*) AS rows,
       {total('price')} AS revenue, count(DISTINCT order_id) AS orders
FROM wide_aw GROUP BY customer_zip_code_prefix, geolocation_lat, geolocation_lng"""
BODIES["wide_geo_as_written_rows"] = f"""
SELECT order_year_month, geolocation_state, order_status, count(*) AS rows, {total('price')} AS revenue,
       count(DISTINCT order_id) AS orders,
       count(DISTINCT CASE WHEN geolocation_lat IS NOT NULL AND geolocation_lng IS NOT NULL
                           THEN (geolocation_lat, geolocation_lng) END) AS points
FROM wide_aw GROUP BY 1, 2, 3"""
BODIES["wide_translation_using"] = (f"SELECT {ITEM_KEY}, product_category_name, product_category_name_english "
                                    "FROM wide")
BODIES["wide_segments"] = (f"SELECT {ITEM_KEY}, order_customer_id, order_customer_id_customer_segmented, "
                           "total_orders, total_spent, AOV, aov_segment FROM wide")

BODIES["feat_flags"] = (f"SELECT {ITEM_KEY}, order_status, price, freight_value, payment_value, is_delivered, "
                        "is_canceled, order_revenue, is_payment_missing FROM wide")
BODIES["feat_review_lags"] = (f"SELECT {ITEM_KEY}, {date_text('review_creation_date')} AS review_creation_date, "
                              "review_answer_timestamp, order_delivered_customer_date, "
                              "time_from_delivery_to_review, time_to_response FROM wide")
BODIES["feat_calendar"] = (f"SELECT {ITEM_KEY}, order_purchase_timestamp, hour_of_day, order_day_type, "
                           "order_year_month FROM wide")
BODIES["feat_delivery"] = f"""
SELECT order_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
       order_estimated_delivery_date,
       {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS actual_delivery_time,
       {days('order_estimated_delivery_date', 'order_purchase_timestamp')} AS estimated_delivery_time,
       {days('order_delivered_customer_date', 'order_purchase_timestamp')}
         - {days('order_estimated_delivery_date', 'order_purchase_timestamp')} AS delivery_delay_time,
       CASE WHEN {days('order_delivered_customer_date', 'order_purchase_timestamp')}
              - {days('order_estimated_delivery_date', 'order_purchase_timestamp')} > 0 THEN 1 ELSE 0 END AS is_late
FROM clean_orders"""
BODIES["feat_has_review"] = (f"SELECT {ITEM_KEY}, {ordered_text('review_titles')} AS review_titles, "
                             f"{ordered_text('review_message')} AS review_message, has_review FROM wide")

BODIES["k20_customer_spend"] = "SELECT * FROM wide_spend"
BODIES["k21_aov_segment"] = "SELECT * FROM wide_seg"

BODIES["k01_customers_by_state"] = ("SELECT customer_state, customer_city, count(*) AS count "
                                    "FROM src_customers GROUP BY 1, 2")
BODIES["k02_orders_by_status"] = "SELECT order_status, count(*) AS count FROM clean_orders GROUP BY 1"
BODIES["k03_payment_types"] = "SELECT payment_type, count(*) AS count FROM clean_payments GROUP BY 1"
BODIES["k03_payment_type_sets"] = (f"SELECT {sorted_text('payment_type')} AS payment_type, count(*) AS count "
                                   "FROM pay_agg GROUP BY 1")
BODIES["k04_product_sales"] = (f"SELECT product_id, {total('price')} AS total_sales "
                               "FROM src_order_items GROUP BY 1")
BODIES["k05_price_summary"] = f"""
SELECT count(price) AS count, {r4('avg(price)')} AS mean, {r4('stddev_samp(price)')} AS stddev,
       min(price) AS min, quantile_disc(price, 0.25) AS p25, quantile_disc(price, 0.5) AS p50,
       quantile_disc(price, 0.75) AS p75, max(price) AS max
FROM src_order_items"""
BODIES["k06_seller_revenue"] = (f"SELECT seller_id, {total('price')} AS total_revenue_per_seller "
                                "FROM wide GROUP BY 1")
BODIES["k07_distinct_sellers"] = "SELECT DISTINCT seller_id FROM wide"

REVIEW_SUM = "list_sum(list_filter(review_scores, lambda x: x <> -1))"
REVIEW_N = "len(list_filter(review_scores, lambda x: x <> -1))"
AVG_REVIEW = r2(f"CAST(sum({REVIEW_SUM}) AS DOUBLE) / nullif(sum({REVIEW_N}), 0)")
BODIES["k08_seller_review"] = f"SELECT seller_id, {AVG_REVIEW} AS avg_review_per_seller FROM wide GROUP BY 1"
BODIES["k10_top_customers_rows"] = """
SELECT customer_id, count(order_id) AS total_order_per_customer, count(DISTINCT order_id) AS distinct_orders
FROM wide WHERE order_status = 'delivered' GROUP BY customer_id
ORDER BY total_order_per_customer DESC NULLS LAST, customer_id ASC NULLS FIRST LIMIT 10"""
BODIES["k11_top_customers_spend"] = f"""
SELECT customer_id, {total('price')} AS top_customer_per_spending
FROM wide WHERE order_status = 'delivered' GROUP BY customer_id
ORDER BY top_customer_per_spending DESC NULLS LAST, customer_id ASC NULLS FIRST LIMIT 10"""
BODIES["k12_rank"] = f"""
SELECT * FROM (
  SELECT {WHOLE_ROW},
         CAST(rank() OVER (PARTITION BY seller_id ORDER BY price DESC NULLS LAST) AS INTEGER) AS rank
  FROM wide) WHERE rank <= 5"""
BODIES["k12_seller_revenue_rank"] = f"""
SELECT seller_id, total_revenue,
       CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM (SELECT seller_id, {total('price')} AS total_revenue FROM wide GROUP BY seller_id)"""
BODIES["k13_dense_rank"] = f"""
SELECT * FROM (
  SELECT {WHOLE_ROW},
         CAST(dense_rank() OVER (PARTITION BY seller_id ORDER BY price DESC NULLS LAST) AS INTEGER) AS dense_rank
  FROM wide) WHERE dense_rank <= 5"""
BODIES["k14_seller_scorecard"] = f"""
SELECT seller_id, count(order_id) AS total_orders, count(DISTINCT order_id) AS distinct_orders,
       {total('price')} AS total_revenue, {AVG_REVIEW} AS avg_review_score,
       {r2('stddev_samp(price)')} AS price_variability
FROM wide GROUP BY seller_id"""
BODIES["k14_seller_price_quartiles"] = """
SELECT seller_id, count(price) AS items, quantile_disc(price, 0.25) AS price_p25, quantile_disc(price, 0.5) AS price_median,
       quantile_disc(price, 0.75) AS price_p75
FROM wide WHERE seller_id IS NOT NULL AND price IS NOT NULL GROUP BY seller_id"""
BODIES["k15_product_scorecard"] = f"""
SELECT product_id, product_category_name_english, count(order_id) AS total_sales,
       {total('price')} AS total_revenue,
       {r2(total('price') + ' / count(price)')} AS avg_price,
       {r2('stddev_samp(price)')} AS price_volatility,
       coalesce({sorted_text('list(DISTINCT seller_id) FILTER (WHERE seller_id IS NOT NULL)')}, '') AS unique_seller,
       {AVG_REVIEW} AS avg_review_score,
       CAST(sum(coalesce(len(review_scores), 0)) AS BIGINT) AS total_reviewes
FROM wide GROUP BY product_id, product_category_name_english"""
BODIES["k16_retention"] = f"""
SELECT customer_id, min(order_purchase_timestamp) AS first_order_date,
       max(order_purchase_timestamp) AS last_order_date, count(order_id) AS total_orders,
       {total('price')} AS total_revenue, {r2(total('price') + ' / count(price)')} AS avg_price
FROM wide GROUP BY customer_id"""
STATE_VOLUME = f"""
SELECT geolocation_state, count(order_id) AS order_volume, {total('price')} AS total_spending
FROM {{t}} WHERE order_status = 'delivered' GROUP BY geolocation_state"""
BODIES["k17_state_volume"] = STATE_VOLUME.format(t="wide")
BODIES["k17_state_volume_as_written"] = STATE_VOLUME.format(t="wide_aw")
BODIES["k18_row_count"] = "SELECT count(*) AS row_count FROM wide"
BODIES["k19_seller_revenue_attrs"] = f"""
SELECT r.seller_id, r.total_revenue_per_seller, s.seller_zip_code_prefix, s.seller_city, s.seller_state
FROM (SELECT seller_id, {total('price')} AS total_revenue_per_seller FROM src_order_items GROUP BY 1) r
LEFT JOIN src_sellers s ON r.seller_id = s.seller_id"""
BODIES["k23_dim_orders"] = f"SELECT DISTINCT {ORDER_COLS}, order_year_month FROM wide"
BODIES["k23_fact_items"] = """
SELECT order_id, item_order_item_id, item_product_id, item_seller_id, order_customer_id, order_year_month,
       price, freight_value, order_revenue, is_delivered, is_canceled, is_late, delivery_delay_time
FROM wide"""


# --- data quality ------------------------------------------------------------------------
def _dq_bodies() -> dict[str, str]:
    from ..operators.wide import WIDE_COLUMNS
    from ..sources.schemas import column_names

    src_tables = ["orders", "order_items", "order_payments", "order_reviews", "products", "sellers",
                  "customers", "geolocation", "category_translation"]
    cols = {t: column_names(t) for t in src_tables}
    b: dict[str, str] = {}
    union = "\nUNION ALL\n".join
    hexp = "'^[a-fA-F0-9]{32}$'"

    b["dq_row_counts"] = union(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM src_{t}" for t in src_tables)

    def dups(t, rel, c):
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS count "
                f"FROM {rel} GROUP BY {c} HAVING count(*) > 1")
    b["dq_duplicates"] = union([dups("customers", "src_customers", "customer_id"),
                                dups("order_items", "src_order_items", "order_id"),
                                dups("order_reviews", "src_order_reviews", "review_id"),
                                dups("orders", "src_orders", "order_id"),
                                dups("products", "src_products", "product_id"),
                                dups("sellers", "src_sellers", "seller_id")])
    b["dq_uniqueness"] = union([dups("geolocation", "src_geolocation", "geolocation_lat"),
                                dups("customers", "src_customers", "customer_id"),
                                dups("customers", "src_customers", "customer_unique_id"),
                                dups("orders", "clean_orders", "order_id"),
                                dups("orders", "clean_orders", "order_customer_id"),
                                dups("sellers", "src_sellers", "seller_id"),
                                dups("sellers", "src_sellers", "seller_zip_code_prefix"),
                                dups("products", "src_products", "product_id"),
                                dups("products", "src_products", "product_category_name"),
                                dups("order_reviews", "clean_reviews", "review_id"),
                                dups("order_reviews", "clean_reviews", "review_order_id"),
                                *[dups("order_items", "clean_items", c) for c in (
                                    "item_order_id", "item_order_item_id", "item_product_id", "item_seller_id")],
                                dups("order_payments", "clean_payments", "payment_order_id"),
                                dups("category_translation", "src_category_translation", "product_category_name"),
                                dups("category_translation", "src_category_translation",
                                     "product_category_name_english")])

    def nulls(t, rel, columns, value="null_count", nan=()):
        parts = []
        for c in columns:
            cond = f"{c} IS NULL" + (f" OR isnan({c})" if c in nan else "")
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {cond}) AS {value} "
                         f"FROM {rel}")
        return union(parts)
    b["dq_nulls"] = union([nulls(t, f"src_{t}", cols[t]) for t in src_tables if t != "category_translation"]
                          + [nulls("final", "wide", WIDE_COLUMNS)])
    b["dq_nulls_nan"] = union([
        nulls("order_payments", "clean_payments",
              ["payment_order_id", "payment_sequential", "payment_type", "payment_installments",
               "payment_value", "payment_value_imputed"], "missing_count",
              nan=("payment_value", "payment_value_imputed")),
        nulls("order_payments_per_order", "pay_agg",
              ["payment_order_id", "max_payment_sequence", "payment_type", "payment_installments",
               "payment_split_count", "payment_value", "payment_value_imputed"], "missing_count",
              nan=("payment_value", "payment_value_imputed"))])

    def hexrep(t, rel, c):
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                f"count(*) FILTER (WHERE regexp_matches({c}, {hexp})) AS valid, "
                f"count(*) FILTER (WHERE NOT regexp_matches({c}, {hexp})) AS invalid, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {rel}")
    b["dq_hex_ids"] = union([hexrep("final", "wide", "review_order_id"), hexrep("orders", "src_orders", "order_id"),
                             hexrep("order_items", "src_order_items", "order_id"),
                             hexrep("order_reviews", "src_order_reviews", "order_id"),
                             hexrep("order_payments", "src_order_payments", "order_id")])
    b["dq_hex_ids_valid"] = (f"SELECT order_id, item_order_item_id, review_order_id FROM wide "
                             f"WHERE regexp_matches(review_order_id, {hexp})")

    b["dq_join_reconcile"] = """
, j1 AS (SELECT o.order_id, o.order_customer_id, i.item_product_id, i.item_seller_id
         FROM clean_orders o JOIN clean_items i ON o.order_id = i.item_order_id),
j2 AS (SELECT j1.*, p.product_category_name AS cat FROM j1 LEFT JOIN clean_products p ON j1.item_product_id = p.product_id),
j3 AS (SELECT j2.* FROM j2 LEFT JOIN src_sellers s ON j2.item_seller_id = s.seller_id),
j4 AS (SELECT j3.*, pa.payment_order_id AS pay_key, pa.payment_value AS pay_value
       FROM j3 LEFT JOIN pay_agg pa ON j3.order_id = pa.payment_order_id),
j5 AS (SELECT j4.*, c.customer_zip_code_prefix AS zip FROM j4 LEFT JOIN src_customers c ON j4.order_customer_id = c.customer_id),
j6 AS (SELECT j5.* FROM j5 LEFT JOIN rev_agg r ON j5.order_id = r.review_order_id),
j7 AS (SELECT j6.* FROM j6 LEFT JOIN geo_dedup g ON j6.zip = g.geolocation_zip_code_prefix),
j8 AS (SELECT j7.* FROM j7 LEFT JOIN src_category_translation t ON j7.cat = t.product_category_name)
SELECT * FROM (
  SELECT 1 AS stage, 'orders_items' AS stage_name, (SELECT count(*) FROM clean_items) AS right_rows,
         (SELECT count(*) FROM j1) AS output_rows, CAST(NULL AS BIGINT) AS null_payment_rows
  UNION ALL SELECT 2, 'products', (SELECT count(*) FROM clean_products), (SELECT count(*) FROM j2), NULL
  UNION ALL SELECT 3, 'sellers', (SELECT count(*) FROM src_sellers), (SELECT count(*) FROM j3), NULL
  UNION ALL SELECT 4, 'payments', (SELECT count(*) FROM pay_agg), (SELECT count(*) FROM j4),
                   (SELECT count(*) FROM j4 WHERE pay_value IS NULL)
  UNION ALL SELECT 5, 'customers', (SELECT count(*) FROM src_customers), (SELECT count(*) FROM j5), NULL
  UNION ALL SELECT 6, 'reviews', (SELECT count(*) FROM rev_agg), (SELECT count(*) FROM j6), NULL
  UNION ALL SELECT 7, 'geolocation', (SELECT count(*) FROM geo_dedup), (SELECT count(*) FROM j7), NULL
  UNION ALL SELECT 8, 'translation', (SELECT count(*) FROM src_category_translation), (SELECT count(*) FROM j8), NULL)"""
    b["dq_nulls_by_status"] = ("SELECT order_status, count(*) AS count FROM clean_orders "
                               "WHERE order_delivered_customer_date IS NULL GROUP BY order_status")
    b["dq_having_dupes"] = "SELECT order_id, count(*) AS count FROM wide GROUP BY order_id HAVING count(*) > 1"

    key_columns = {
        "orders": ["order_id", "customer_id", "order_status"],
        "order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
        "order_reviews": ["review_id", "order_id"],
        "order_payments": ["order_id"],
        "products": ["product_id"],
        "customers": ["customer_id"],
        "sellers": ["seller_id"],
    }
    parts = []
    for t, keys in key_columns.items():
        for c in cols[t]:
            lim = "0.0" if c in keys else "0.5"
            ratio = f"(count(*) FILTER (WHERE {c} IS NULL))::DOUBLE / count(*)"
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count, "
                         f"CAST(round(CAST({ratio} AS DECIMAL(38,10)), 6) AS DOUBLE) AS null_ratio, "
                         f"CAST({lim} AS DOUBLE) AS max_ratio, coalesce({ratio}, 0.0) <= {lim} AS passed "
                         f"FROM src_{t}")
    b["dq_null_threshold"] = union(parts)

    b["dq_dup_rows"] = union(
        f"SELECT '{t}' AS table_name, count(*) AS duplicate_groups, "
        f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus_rows "
        f"FROM (SELECT count(*) AS c FROM src_{t} GROUP BY {', '.join(cols[t])} HAVING count(*) > 1)"
        for t in src_tables)

    def rule(t, rel, name, checked, bad):
        return (f"SELECT '{t}' AS table_name, '{name}' AS rule, count(*) FILTER (WHERE {checked}) AS checked_rows, "
                f"count(*) FILTER (WHERE ({checked}) AND ({bad})) AS violations FROM {rel}")

    def fmt(t, rel, name, c, pattern):
        return rule(t, rel, name, f"{c} IS NOT NULL", f"NOT regexp_matches({c}, '{pattern}')")
    b["dq_format"] = union([
        fmt("customers", "src_customers", "zip_5_digits", "customer_zip_code_prefix", r"^\d{5}$"),
        fmt("sellers", "src_sellers", "zip_5_digits", "seller_zip_code_prefix", r"^\d{5}$"),
        fmt("geolocation", "src_geolocation", "zip_5_digits", "geolocation_zip_code_prefix", r"^\d{5}$"),
        fmt("order_reviews", "src_order_reviews", "order_id_hex", "order_id", "^[a-fA-F0-9]{32}$"),
        fmt("orders", "src_orders", "order_id_hex", "order_id", "^[a-fA-F0-9]{32}$"),
        fmt("final", "wide", "year_month_format", "order_year_month", r"^\d{4}-\d{2}$"),
        fmt("order_reviews", "(SELECT strftime(review_creation_date, '%Y-%m-%d') AS d FROM src_order_reviews)", "iso_date",
            "d", r"^\d{4}-\d{2}-\d{2}$"),
        fmt("order_reviews", "src_order_reviews", "order_id_iso_date", "order_id", r"^\d{4}-\d{2}-\d{2}$"),
        fmt("customers", "(SELECT CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0 THEN customer_id || '@mail.example.org' "
            "ELSE customer_id END AS email FROM src_customers)", "email", "email",
            r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$")])

    b["dq_allowed"] = """
SELECT 'orders' AS table_name, 'order_status' AS column_name, CAST(order_status AS VARCHAR) AS value, count(*) AS count
FROM src_orders WHERE NOT coalesce(order_status IN ('approved', 'canceled', 'created', 'delivered', 'invoiced',
                                                    'processing', 'shipped', 'unavailable'), false)
GROUP BY order_status
UNION ALL
SELECT 'order_payments', 'payment_type', CAST(payment_type AS VARCHAR), count(*)
FROM src_order_payments WHERE NOT coalesce(payment_type IN ('boleto', 'credit_card', 'debit_card', 'voucher'), false)
GROUP BY payment_type
UNION ALL
SELECT 'products', 'product_category_name', CAST(product_category_name AS VARCHAR), count(*)
FROM src_products p
WHERE NOT EXISTS (SELECT 1 FROM src_category_translation t WHERE t.product_category_name = p.product_category_name
                  AND t.product_category_name_english IS NOT NULL)
GROUP BY product_category_name"""

    def rng(t, rel, name, c, lo=None, hi=None):
        bad = " OR ".join(([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else []))
        return rule(t, rel, name, f"{c} IS NOT NULL", bad)
    b["dq_range"] = union([
        rng("order_items", "src_order_items", "price_positive", "price", lo=0.01),
        rng("order_items", "src_order_items", "freight_non_negative", "freight_value", lo=0),
        rng("order_reviews", "src_order_reviews", "score_1_to_5", "review_score", 1, 5),
        rng("order_payments", "src_order_payments", "installments_1_to_24", "payment_installments", 1, 24),
        rng("order_payments", "src_order_payments", "value_non_negative", "payment_value", lo=0),
        rng("geolocation", "src_geolocation", "lat_valid", "geolocation_lat", -90, 90),
        rng("geolocation", "src_geolocation", "lng_valid", "geolocation_lng", -180, 180),
        rng("products", "src_products", "weight_non_negative", "product_weight_g", lo=0)])

    def iqr(t, rel, c):
        q1 = f"(SELECT quantile_disc({c}, 0.25) FROM {rel})"
        q3 = f"(SELECT quantile_disc({c}, 0.75) FROM {rel})"
        lo = f"({q1} - CAST(1.5 AS DOUBLE) * ({q3} - {q1}))"
        hi = f"({q3} + CAST(1.5 AS DOUBLE) * ({q3} - {q1}))"
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, {q1} AS q1, {q3} AS q3, "
                f"{r4(lo)} AS lower_fence, {r4(hi)} AS upper_fence, count({c}) AS checked_rows, "
                f"count(*) FILTER (WHERE {c} < {lo}) AS below, count(*) FILTER (WHERE {c} > {hi}) AS above FROM {rel}")
    b["dq_iqr"] = union([iqr("order_items", "src_order_items", "price"),
                         iqr("order_items", "src_order_items", "freight_value"),
                         iqr("order_payments", "src_order_payments", "payment_value")])

    lo, hi = (f"({a} {sign} CAST(1.5 AS DOUBLE) * (q3 - q1))" for a, sign in (("q1", "-"), ("q3", "+")))
    b["dq_iqr_by_category"] = f"""
, category_quartiles AS (
  SELECT product_category_name AS category, CAST(quantile_disc(price, 0.25) AS DOUBLE) AS q1,
         CAST(quantile_disc(price, 0.75) AS DOUBLE) AS q3
  FROM wide WHERE product_category_name IS NOT NULL AND price IS NOT NULL GROUP BY 1)
SELECT product_category_name, q1, q3, {r4(lo)} AS lower_fence, {r4(hi)} AS upper_fence, count(price) AS checked_rows,
       count(*) FILTER (WHERE price < {lo}) AS below, count(*) FILTER (WHERE price > {hi}) AS above
FROM wide JOIN category_quartiles ON product_category_name = category WHERE price IS NOT NULL
GROUP BY product_category_name, q1, q3"""

    def z(t, rel, c):
        mu, sd = f"(SELECT avg({c}) FROM {rel})", f"(SELECT stddev_samp({c}) FROM {rel})"
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, {r4(mu)} AS mean, {r4(sd)} AS stddev, "
                f"count({c}) AS checked_rows, count(*) FILTER (WHERE abs(({c} - {mu}) / {sd}) > 3) AS outliers "
                f"FROM {rel}")
    b["dq_zscore"] = union([z("order_items", "src_order_items", "price"),
                            z("order_items", "src_order_items", "freight_value"),
                            z("order_payments", "src_order_payments", "payment_value")])

    cross = {
        "approved_after_purchase": ("order_purchase_timestamp", "order_approved_at"),
        "carrier_after_purchase": ("order_purchase_timestamp", "order_delivered_carrier_date"),
        "delivered_after_purchase": ("order_purchase_timestamp", "order_delivered_customer_date"),
        "estimate_after_purchase": ("order_purchase_timestamp", "order_estimated_delivery_date"),
        "shipping_limit_after_purchase": ("order_purchase_timestamp", "shipping_limit_date"),
    }
    b["dq_cross_field"] = union(rule("final", "wide", n, f"{a} IS NOT NULL AND {c} IS NOT NULL", f"{c} < {a}")
                                for n, (a, c) in cross.items())

    rels = [("orders.customer_id->customers", "clean_orders", "order_customer_id", "src_customers", "customer_id"),
            ("order_items.order_id->orders", "src_order_items", "order_id", "clean_orders", "order_id"),
            ("order_items.product_id->products", "src_order_items", "product_id", "src_products", "product_id"),
            ("order_items.seller_id->sellers", "src_order_items", "seller_id", "src_sellers", "seller_id"),
            ("order_payments.order_id->orders", "src_order_payments", "order_id", "clean_orders", "order_id"),
            ("order_reviews.order_id->orders", "src_order_reviews", "order_id", "clean_orders", "order_id")]
    b["dq_fk_anti"] = union(
        f"SELECT '{n}' AS relation, count(*) AS orphan_rows, count(DISTINCT ch.{ck}) AS orphan_keys FROM {child} ch "
        f"WHERE NOT EXISTS (SELECT 1 FROM {parent} pa WHERE pa.{pk} = ch.{ck})"
        for n, child, ck, parent, pk in rels)
    b["dq_fk_semi"] = union(
        f"SELECT '{n}' AS relation, count(*) AS valid_rows FROM {child} ch "
        f"WHERE EXISTS (SELECT 1 FROM {parent} pa WHERE pa.{pk} = ch.{ck})"
        for n, child, ck, parent, pk in rels)

    b["dq_reconcile"] = f"""
SELECT coalesce(l.key, r.key) AS key, l.left_total, r.right_total,
       {r2('l.left_total - r.right_total')} AS difference,
       CASE WHEN r.right_total IS NULL AND l.left_total IS NOT NULL THEN 'left_only'
            WHEN l.left_total IS NULL AND r.right_total IS NOT NULL THEN 'right_only'
            WHEN abs(l.left_total - r.right_total) <= 0.005 THEN 'match' ELSE 'mismatch' END AS status
FROM (SELECT item_order_id AS key, {total('price + freight_value')} AS left_total FROM clean_items GROUP BY 1) l
FULL OUTER JOIN (SELECT payment_order_id AS key, payment_value AS right_total FROM pay_agg) r ON l.key = r.key"""

    raw = ("order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, "
           "order_delivered_customer_date, order_estimated_delivery_date")
    l, r = f"SELECT {raw} FROM src_orders", f"SELECT {raw.replace('customer_id', 'order_customer_id', 1)} FROM clean_orders"
    b["dq_row_differences"] = f"""
SELECT order_id, 'left' AS side, count(*) AS rows FROM ({l} EXCEPT ALL {r}) GROUP BY order_id
UNION ALL SELECT order_id, 'right', count(*) FROM ({r} EXCEPT ALL {l}) GROUP BY order_id"""

    b["dq_numeric_drift"] = """
, edges AS (SELECT quantile_disc(price, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS e FROM wide),
binned AS (SELECT order_year_month AS period, len(list_filter(e, lambda x: price > x)) AS bin, count(*) AS n
           FROM wide, edges WHERE order_year_month IS NOT NULL AND price IS NOT NULL GROUP BY 1, 2),
periods AS (SELECT period, sum(n) AS rows FROM binned GROUP BY period),
dense AS (SELECT period, rows, b.bin, (coalesce(n, 0) + 0.5::DOUBLE) / (rows + 4) AS share
          FROM periods CROSS JOIN (SELECT unnest(range(8)) AS bin) b LEFT JOIN binned USING (period, bin)),
pairs AS (SELECT p.period, any_value(q.rows) AS prev_rows, sum((p.share - q.share) * ln(p.share / q.share)) AS psi
          FROM dense p JOIN dense q ON p.bin = q.bin
            AND p.period = strftime(CAST(q.period || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') GROUP BY p.period)
SELECT period, CAST(rows AS BIGINT) AS rows, CAST(prev_rows AS BIGINT) AS prev_rows,
       CAST(round(CAST(psi AS DECIMAL(38,12)), 6) AS DOUBLE) AS psi
FROM periods LEFT JOIN pairs USING (period)"""

    partners = {"products": "product_id", "sellers": "seller_id", "payments": "payment_order_id", "customers": "customer_id",
                "reviews": "review_order_id", "geolocation": "geolocation_zip_code_prefix",
                "translation": "product_category_name_english"}
    b["dq_observed_write"] = union([
        "SELECT 'rows' AS metric, count(*) AS value FROM wide",
        "SELECT 'null_payment_value' AS metric, count(*) - count(payment_value) AS value FROM wide",
        *[f"SELECT 'without_{n}' AS metric, count(*) - count({c}) AS value FROM wide" for n, c in partners.items()]])

    b["dq_drift"] = """
, drift_counts AS (
  SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_year_month, order_status, count(*) AS rows
  FROM clean_orders GROUP BY 1, 2),
drift_share AS (
  SELECT c.order_year_month, c.order_status, c.rows,
         CAST(round(CAST(c.rows / t.total AS DECIMAL(38,10)), 6) AS DOUBLE) AS share
  FROM drift_counts c JOIN (SELECT order_year_month, sum(rows) AS total FROM drift_counts GROUP BY 1) t
    ON c.order_year_month = t.order_year_month)
SELECT s.order_year_month, s.order_status, s.rows, s.share, p.share AS prev_share,
       CAST(round(CAST(s.share - p.share AS DECIMAL(38,10)), 6) AS DOUBLE) AS delta
FROM drift_share s LEFT JOIN drift_share p
  ON s.order_status = p.order_status
 AND s.order_year_month = strftime(CAST(p.order_year_month || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m')"""

    def st(t, rel, c):
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS count, {r4(f'avg({c})')} AS mean, "
                f"{r4(f'stddev_samp({c})')} AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
                f"CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median, "
                f"CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {rel}")
    b["dq_stats"] = union([st("order_items", "src_order_items", "price"),
                           st("order_items", "src_order_items", "freight_value"),
                           st("order_payments", "src_order_payments", "payment_value"),
                           st("products", "src_products", "product_weight_g")])

    bad_text = r"'[\x{FFFD}\x{0000}-\x{0008}\x{000B}\x{000C}\x{000E}-\x{001F}\x{007F}]'"

    def enc(t, rel, c):
        return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                f"count(*) FILTER (WHERE regexp_matches({c}, {bad_text})) AS bad_rows FROM {rel}")
    b["dq_encoding"] = union([enc("order_reviews", "src_order_reviews", "review_comment_title"),
                              enc("order_reviews", "src_order_reviews", "review_comment_message"),
                              enc("customers", "src_customers", "customer_city"),
                              enc("products", "src_products", "product_category_name")])

    def fresh(t, rel, c):
        lag = f"CAST(datediff('day', CAST(max({c}) AS DATE), DATE '2002-01-01') AS INTEGER)"
        return (f"SELECT '{t}' AS table_name, max({c}) AS latest, {lag} AS lag_days, {lag} <= 30 AS fresh "
                f"FROM {rel}")
    b["dq_freshness"] = union([fresh("orders", "src_orders", "order_purchase_timestamp"),
                               fresh("order_items", "src_order_items", "shipping_limit_date"),
                               fresh("order_reviews", "src_order_reviews", "review_answer_timestamp")])

    b["dq_mask"] = """
SELECT customer_id, sha256(customer_unique_id) AS customer_unique_id,
       substring(customer_zip_code_prefix, 1, 2) || '***' AS customer_zip_code_prefix,
       substring(customer_city, 1, 1) || repeat('*', greatest(length(customer_city) - 1, 0)) AS customer_city,
       customer_state
FROM src_customers"""
    key = MASK_KEY.ljust(64, b"\0")
    inner, outer = (f"unhex('{bytes(c ^ pad for c in key).hex()}')" for pad in (0x36, 0x5C))
    b["dq_mask_keyed"] = b["dq_mask"].replace(
        "sha256(customer_unique_id)", f"sha256({outer} || unhex(sha256({inner} || encode(customer_unique_id))))")
    b["dq_units"] = """
SELECT product_id, product_weight_g / 1000.0 AS product_weight_kg, product_length_cm / 100.0 AS product_length_m,
       product_height_cm / 100.0 AS product_height_m, product_width_cm / 100.0 AS product_width_m,
       product_length_cm * product_height_cm * product_width_cm / 1000.0 AS product_volume_l
FROM clean_products"""
    b["dq_unit_table"] = "\nUNION ALL\n".join(
        f"SELECT product_id, '{c}' AS measure, '{u}' AS standard_unit, {c} / {k} AS standard_value FROM products_filled"
        for c, u, k in (("product_weight_g", "kg", "1000.0"), ("product_length_cm", "m", "100.0"),
                        ("product_height_cm", "m", "100.0"), ("product_width_cm", "m", "100.0")))
    # lines of the landed reviews: a record takes one line and one more for each newline in its message; a
    # reader without multi-line quoting takes each line that is not blank for a record
    b["dq_line_count"] = """
SELECT 'order_reviews' AS table_name,
       CAST(sum(1 + length(m) - length(replace(m, chr(10), ''))) AS BIGINT) AS data_lines,
       count(*) AS records_multiline,
       CAST(sum(1 + length(m) - length(replace(m, chr(10), ''))) AS BIGINT) AS records_naive
FROM (SELECT coalesce(review_comment_message, '') AS m FROM src_order_reviews)"""
    b["dq_deprecated"] = """
SELECT 'order_payments' AS table_name, 'payment_type' AS column_name, payment_type AS value, count(*) AS count
FROM src_order_payments WHERE payment_type IN ('not_defined') GROUP BY payment_type
UNION ALL
SELECT 'orders', 'order_status', order_status, count(*) FROM src_orders WHERE order_status IN ('invoiced')
GROUP BY order_status"""

    order_rules = {
        "approved_before_purchase": "order_approved_at < order_purchase_timestamp",
        "delivered_before_purchase": "order_delivered_customer_date < order_purchase_timestamp",
        "delivered_without_date": "order_status = 'delivered' AND order_delivered_customer_date IS NULL",
        "late_delivery": "order_delivered_customer_date > order_estimated_delivery_date",
    }
    item_rules = {"price_not_positive": "price <= 0", "freight_negative": "freight_value < 0",
                  "product_missing": "item_product_id IS NULL"}
    b["dq_failure_log"] = union(
        [f"SELECT 'orders' AS table_name, order_id AS record_id, '{n}' AS rule FROM clean_orders "
         f"WHERE coalesce({c}, false)" for n, c in order_rules.items()]
        + [f"SELECT 'order_items', concat_ws('-', item_order_id, item_order_item_id), '{n}' FROM clean_items "
           f"WHERE coalesce({c}, false)" for n, c in item_rules.items()])

    def summ(t, rel, n, c):
        f = f"count(*) FILTER (WHERE coalesce({c}, false))"
        return (f"SELECT '{t}' AS table_name, '{n}' AS rule, count(*) AS checked_rows, {f} AS failures, "
                f"CAST(round(CAST(1.0 - {f} / count(*) AS DECIMAL(38,10)), 6) AS DOUBLE) AS pass_rate, "
                f"{f} = 0 AS passed FROM {rel}")
    b["dq_summary"] = union([summ("orders", "clean_orders", n, c) for n, c in order_rules.items()]
                            + [summ("order_items", "clean_items", n, c) for n, c in item_rules.items()])
    return b


_DQ_CACHE: dict[str, str] = {}


def oracle_sql() -> dict[str, str]:
    if not _DQ_CACHE:
        _DQ_CACHE.update(_dq_bodies())
    out = {k: with_base(v) for k, v in BODIES.items()}
    for k, v in _DQ_CACHE.items():
        # bodies starting with ',' extend the WITH list before their SELECT
        out[k] = f"WITH {BASE}{v}" if v.lstrip().startswith(",") else with_base(v)
    return out


BODIES["sink_roundtrip"] = (f"SELECT order_year_month, count(*) AS rows, {total('price')} AS revenue "
                            "FROM wide GROUP BY order_year_month")
BODIES["managed_table"] = BODIES["sink_roundtrip"]
BODIES["bucketed_orders_items"] = BODIES["orders_items_inner"]
BODIES["bronze_roundtrip"] = """
SELECT 'orders' AS table_name, count(*) AS row_count FROM clean_orders
UNION ALL SELECT 'order_items', count(*) FROM clean_items
UNION ALL SELECT 'products', count(*) FROM clean_products
UNION ALL SELECT 'order_payments', count(*) FROM clean_payments
UNION ALL SELECT 'order_reviews', count(*) FROM clean_reviews"""
BODIES["sql_path_scan"] = (f"SELECT {ITEM_KEY}, order_year_month, price, aov_segment FROM wide "
                           "ORDER BY order_year_month DESC")
BODIES["sql_table_surface"] = ("SELECT order_year_month, count(*) AS rows, count(DISTINCT order_id) AS orders "
                               "FROM wide GROUP BY order_year_month")
BODIES["k23_dim_orders_table"] = f"SELECT DISTINCT {ORDER_COLS}, order_year_month FROM wide"
BODIES["delivery_sink"] = BODIES["feat_delivery"]
BODIES["stream_bronze_orders"] = "SELECT * FROM clean_orders"
BODIES["raw_csv_roundtrip"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_first_column "
    f"FROM src_{t}"
    for t, c in [("orders", "order_id"), ("order_items", "order_id"), ("order_payments", "order_id"),
                 ("order_reviews", "review_id"), ("products", "product_id"), ("sellers", "seller_id"),
                 ("customers", "customer_id"), ("geolocation", "geolocation_zip_code_prefix"),
                 ("category_translation", "product_category_name")])
