"""Declared source schemas (DDL strings) of the nine order-analytics tables.

Fixed values: the column names, their order and types below must equal the
reference data model, misspellings included (``product_name_lenght``,
``product_description_lenght``).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: source DDL, one per table -------------------------------
CUSTOMERS = ("customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING, "
             "customer_city STRING, customer_state STRING")
GEOLOCATION = ("geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE, geolocation_lng DOUBLE, "
               "geolocation_city STRING, geolocation_state STRING")
ORDER_ITEMS = ("order_id STRING, order_item_id STRING, product_id STRING, seller_id STRING, "
               "shipping_limit_date TIMESTAMP, price DOUBLE, freight_value DOUBLE")
ORDER_PAYMENTS = ("order_id STRING, payment_sequential INT, payment_type STRING, "
                  "payment_installments INT, payment_value DOUBLE")
ORDER_REVIEWS = ("review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
                 "review_comment_message STRING, review_creation_date DATE, "
                 "review_answer_timestamp TIMESTAMP")
ORDERS = ("order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP, "
          "order_approved_at TIMESTAMP, order_delivered_carrier_date TIMESTAMP, "
          "order_delivered_customer_date TIMESTAMP, order_estimated_delivery_date TIMESTAMP")
PRODUCTS = ("product_id STRING, product_category_name STRING, product_name_lenght INT, "
            "product_description_lenght INT, product_photos_qty INT, product_weight_g DOUBLE, "
            "product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE")
SELLERS = "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING"
CATEGORY_TRANSLATION = "product_category_name STRING, product_category_name_english STRING"
# ----------------------------------------------------------------------------

SOURCE_DDL: dict[str, str] = {
    "customers": CUSTOMERS,
    "geolocation": GEOLOCATION,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "orders": ORDERS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "category_translation": CATEGORY_TRANSLATION,
}


def struct(table: str) -> StructType:
    """The declared schema of ``table`` as a ``StructType``."""
    return StructType.fromDDL(SOURCE_DDL[table])


def column_names(table: str) -> list[str]:
    """Column names of ``table`` (parsed from the DDL text; needs no session)."""
    return [part.strip().split()[0] for part in SOURCE_DDL[table].split(",")]
