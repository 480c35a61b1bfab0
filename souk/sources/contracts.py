"""The nine raw tables: explicit schemas, required columns and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableContract:
    name: str
    ddl: str
    required: tuple[str, ...]
    key: tuple[str, ...] = ()
    free_text: bool = False

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    def missing_columns(self, columns: list[str]) -> list[str]:
        return [c for c in self.required if c not in columns]


# Table and column names, required columns and keys of the raw data set. The spelling "lenght" is
# the data set's own. Zip prefixes are text, so leading zeros survive.
CONTRACTS = {
    c.name: c
    for c in (
        TableContract(
            "orders",
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
            "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
            "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
            ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
            ("order_id",),
        ),
        TableContract(
            "order_items",
            "order_id string, order_item_id int, product_id string, seller_id string, "
            "shipping_limit_date timestamp, price decimal(12,2), freight_value decimal(12,2)",
            ("order_id", "product_id", "seller_id", "price", "freight_value"),
        ),
        TableContract(
            "payments",
            "order_id string, payment_sequential int, payment_type string, payment_installments int, "
            "payment_value decimal(12,2)",
            ("order_id", "payment_type", "payment_value"),
        ),
        TableContract(
            "reviews",
            "review_id string, order_id string, review_score int, review_comment_title string, "
            "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
            ("order_id", "review_score"),
            ("review_id",),
            free_text=True,
        ),
        TableContract(
            "customers",
            "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
            "customer_city string, customer_state string",
            ("customer_id", "customer_unique_id", "customer_city", "customer_state"),
            ("customer_id",),
        ),
        TableContract(
            "products",
            "product_id string, product_category_name string, product_name_lenght int, "
            "product_description_lenght int, product_photos_qty int, product_weight_g int, "
            "product_length_cm int, product_height_cm int, product_width_cm int",
            ("product_id", "product_category_name"),
            ("product_id",),
        ),
        TableContract(
            "sellers",
            "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
            ("seller_id", "seller_city", "seller_state"),
            ("seller_id",),
        ),
        TableContract(
            "geolocation",
            "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
            "geolocation_city string, geolocation_state string",
            ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        ),
        TableContract(
            "category_translation",
            "product_category_name string, product_category_name_english string",
            ("product_category_name", "product_category_name_english"),
            ("product_category_name",),
        ),
    )
}

# Default folder of each table below the raw and bronze roots.
FOLDERS = {name: name for name in CONTRACTS} | {"payments": "order_payments", "reviews": "order_reviews"}
