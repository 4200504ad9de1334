"""The nine source feeds: file, bronze table and text columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Feed:
    name: str
    columns: tuple[str, ...]

    @property
    def file(self) -> str:
        return f"{self.name}.csv"

    @property
    def table(self) -> str:
        return f"bronze_{self.name}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# Column names as the files have them, misspellings included.
FEEDS = {
    feed.name: feed
    for feed in (
        Feed(
            "customers",
            ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        ),
        Feed(
            "geolocation",
            (
                "geolocation_zip_code_prefix",
                "geolocation_lat",
                "geolocation_lng",
                "geolocation_city",
                "geolocation_state",
            ),
        ),
        Feed(
            "order_items",
            (
                "order_id",
                "order_item_id",
                "product_id",
                "seller_id",
                "shipping_limit_date",
                "price",
                "freight_value",
            ),
        ),
        Feed(
            "order_payments",
            ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        ),
        Feed(
            "order_reviews",
            (
                "review_id",
                "order_id",
                "review_score",
                "review_comment_title",
                "review_comment_message",
                "review_creation_date",
                "review_answer_timestamp",
            ),
        ),
        Feed(
            "orders",
            (
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        ),
        Feed(
            "products",
            (
                "product_id",
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        ),
        Feed("sellers", ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")),
        Feed("category_translation", ("product_category_name", "product_category_name_english")),
    )
}
