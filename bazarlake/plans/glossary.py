"""Declared columns of every table, their meaning and their sensitivity.

A column's meaning depends on its name only, so the dictionary of all tables follows from the
glossary and the declared columns.
"""

from __future__ import annotations

from bazarlake.functions.bands import DISTANCE_ORDER, RISK_ORDER
from bazarlake.functions.lineage import BRONZE_LINEAGE, GOLD_LINEAGE, SILVER_LINEAGE
from bazarlake.plans.gold import BAND_COLUMNS, CUSTOMER_METRICS, PRODUCT_ATTRIBUTES
from bazarlake.functions.text import NOT_AVAILABLE
from bazarlake.plans.silver import BASE_COLUMNS, DISTANCE_COLUMNS, ORDER_STATUSES, SALES_CHANNEL
from bazarlake.sources.feeds import FEEDS

_SPELLING = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def _cleaned(feed: str) -> tuple[str, ...]:
    return tuple(_SPELLING.get(name, name) for name in FEEDS[feed].columns)


_SELLER_MART = (
    "seller_id",
    "delivered_order_count",
    "gmv_total_value",
    "avg_delivery_days",
    "late_delivery_rate_pct",
    "avg_delay_days",
    "avg_freight_value",
    "avg_review_score",
    "low_review_rate_pct",
)

# Declared business columns per table, lineage columns left out.
TABLE_COLUMNS: dict[str, tuple[str, ...]] = {
    **{feed.table: feed.columns for feed in FEEDS.values()},
    "silver_customers": _cleaned("customers"),
    "silver_sellers": _cleaned("sellers"),
    "silver_category_translation": _cleaned("category_translation"),
    "silver_products": _cleaned("products"),
    "silver_orders": _cleaned("orders"),
    "silver_quarantine_orders": (*_cleaned("orders"), "quarantine_reason"),
    "silver_order_items": _cleaned("order_items"),
    "silver_quarantine_order_items": (*_cleaned("order_items"), "quarantine_reason"),
    "silver_payments_order_agg": (
        "order_id",
        "payment_total_value",
        "payment_record_count",
        "max_payment_installments",
        "payment_types",
    ),
    "silver_reviews_order_agg": (
        "order_id",
        "review_score_avg",
        "review_score_min",
        "review_score_max",
        "review_count",
        "latest_review_creation_date",
    ),
    "silver_geolocation_zip_agg": (
        "zip_code_prefix",
        "latitude",
        "longitude",
        "geolocation_city",
        "geolocation_state",
        "geolocation_record_count",
    ),
    "silver_order_service_base": BASE_COLUMNS,
    "silver_order_service": (*BASE_COLUMNS, *DISTANCE_COLUMNS),
    "dim_date": (
        "full_date",
        "date_key",
        "year",
        "month_number",
        "month_name",
        "year_month",
        "quarter",
        "day_of_month",
        "day_of_week_number",
        "day_of_week_name",
        "is_weekend",
    ),
    "dim_customer": (
        "customer_unique_id",
        *CUSTOMER_METRICS,
        "customer_city",
        "customer_state",
        "customer_zip_code_prefix",
        "is_repeat_customer",
        "customer_value_band",
    ),
    "dim_product": (
        "product_id",
        "product_category_name",
        "product_category_name_english",
        *PRODUCT_ATTRIBUTES,
    ),
    "dim_seller": (
        *_cleaned("sellers"),
        "lifetime_order_count",
        "lifetime_product_revenue",
        "lifetime_freight_value",
    ),
    "dim_location": ("location_role", "zip_code_prefix", "city", "state", "latitude", "longitude"),
    "dim_service_band": ("service_band_key", *BAND_COLUMNS),
    "fact_order_service": (
        "order_id",
        "purchase_date_key",
        "delivery_date_key",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "seller_id",
        "service_band_key",
        "order_status",
        "order_item_count",
        "distinct_product_count",
        "distinct_seller_count",
        "product_total_value",
        "freight_total_value",
        "gmv_total_value",
        "payment_total_value",
        "payment_record_count",
        "max_payment_installments",
        "payment_types",
        "review_score_avg",
        "review_count",
        "actual_delivery_days",
        "delivery_delay_days",
        "delivery_early_days",
        "is_delivered",
        "is_delivery_late",
        "is_delivery_on_time",
        "seller_count",
        "seller_customer_distance_km",
        *BAND_COLUMNS,
        "sales_channel",
    ),
    "fact_order_item_sales": (
        "order_id",
        "order_item_id",
        "purchase_date_key",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "product_price",
        "freight_value",
        "item_gmv",
        "freight_to_price_ratio",
        "order_status",
        "is_delivery_late",
        "is_delivery_on_time",
        "review_score_avg",
        "seller_customer_distance_km",
        "distance_band",
        "sales_channel",
    ),
    "mart_logistics_performance": _SELLER_MART,
    "mart_service_risk": (*_SELLER_MART, "service_risk_level", "priority_rank"),
    "mart_customer_experience": (
        "distance_band",
        "is_delivery_late",
        "delivered_order_count",
        "avg_delivery_days",
        "avg_freight_value",
        "avg_review_score",
        "low_review_rate_pct",
    ),
    "mart_monthly_operations": (
        "purchase_year_month",
        "order_count",
        "gmv_total_value",
        "avg_ticket_value",
        "avg_delivery_days",
        "late_delivery_rate_pct",
        "avg_review_score",
    ),
}

# Meaning by column name.
GLOSSARY = {
    "order_id": "Order identifier",
    "customer_id": "Customer identifier of one order",
    "customer_unique_id": "Identifier of the person behind one or more orders",
    "order_item_id": "Item number within the order",
    "product_id": "Product identifier",
    "seller_id": "Seller identifier",
    "primary_seller_id": "Seller of the order's lowest item number",
    "review_id": "Review identifier",
    "payment_sequential": "Payment number within the order",
    "order_status": "State of the order, one of eight values",
    "order_purchase_timestamp": "When the order was placed",
    "order_approved_at": "When the payment was approved",
    "order_delivered_carrier_date": "When the carrier took over",
    "order_delivered_customer_date": "When the customer received the order",
    "order_estimated_delivery_date": "Promised delivery date",
    "shipping_limit_date": "Date by which the seller must ship",
    "quarantine_reason": "Failed rules, joined by a semicolon",
    "customer_zip_code_prefix": "First five digits of the customer's postal code",
    "seller_zip_code_prefix": "First five digits of the seller's postal code",
    "geolocation_zip_code_prefix": "First five digits of a postal code",
    "zip_code_prefix": "First five digits of a postal code",
    "customer_city": "City of the customer",
    "customer_state": "State of the customer",
    "seller_city": "City of the seller",
    "seller_state": "State of the seller",
    "geolocation_city": "City of the postal code",
    "geolocation_state": "State of the postal code",
    "city": "City",
    "state": "State",
    "location_role": "Customer or seller",
    "geolocation_lat": "Latitude as text",
    "geolocation_lng": "Longitude as text",
    "latitude": "Mean latitude of the postal code in degrees",
    "longitude": "Mean longitude of the postal code in degrees",
    "seller_latitude_geo": "Latitude of the seller's postal code",
    "seller_longitude_geo": "Longitude of the seller's postal code",
    "customer_latitude_geo": "Latitude of the customer's postal code",
    "customer_longitude_geo": "Longitude of the customer's postal code",
    "geolocation_record_count": "Valid points of the postal code",
    "price": "Price of the item without freight",
    "product_price": "Price of the item without freight",
    "freight_value": "Freight of the item",
    "item_gmv": "Price plus freight of the item",
    "freight_to_price_ratio": "Freight by price of the item, for a price above zero",
    "payment_type": "Means of payment",
    "payment_types": "Means of payment of the order, sorted and joined by a bar",
    "payment_installments": "Number of instalments",
    "max_payment_installments": "Largest number of instalments",
    "payment_value": "Amount of the payment",
    "payment_total_value": "Amount of all payments of the order",
    "payment_record_count": "Payments of the order",
    "review_score": "Score from 1 to 5",
    "review_comment_title": "Title of the review",
    "review_comment_message": "Text of the review",
    "review_creation_date": "When the review was requested",
    "review_answer_timestamp": "When the review was answered",
    "review_score_avg": "Mean score of the order",
    "review_score_min": "Lowest score of the order",
    "review_score_max": "Highest score of the order",
    "review_count": "Reviews of the order",
    "latest_review_creation_date": "Latest review request of the order",
    "product_category_name": "Product category in the source language",
    "product_category_name_english": "Product category in English",
    "product_name_lenght": "Characters in the product name, misspelt as in the source",
    "product_description_lenght": "Characters in the description, misspelt as in the source",
    "product_name_length": "Characters in the product name",
    "product_description_length": "Characters in the product description",
    "product_photos_qty": "Photos of the product",
    "product_weight_g": "Weight in grams",
    "product_length_cm": "Length in centimetres",
    "product_height_cm": "Height in centimetres",
    "product_width_cm": "Width in centimetres",
    "product_total_value": "Prices of all items of the order",
    "freight_total_value": "Freight of all items of the order",
    "gmv_total_value": "Prices plus freight",
    "order_item_count": "Items of the order",
    "distinct_product_count": "Different products in the order",
    "distinct_seller_count": "Different sellers in the order",
    "seller_count": "Different sellers in the order",
    "avg_freight_to_price_ratio": "Mean of freight by price over the items",
    "actual_delivery_days": "Days from purchase to delivery",
    "delivery_delay_days": "Days after the promised date, zero if not late",
    "delivery_early_days": "Days before the promised date, zero if late",
    "is_delivered": "Order is in state delivered",
    "is_delivery_late": "Delivered after the promised date; NULL if not evaluable",
    "is_delivery_on_time": "Delivered by the promised date; NULL if not evaluable",
    "is_low_review": "Mean score of 2 or less; NULL without a review",
    "sales_channel": "Sales channel",
    "seller_customer_distance_km": "Great-circle distance from seller to customer",
    "distance_band": "Distance in five bands",
    "delivery_performance_band": "Early, on time, late or not evaluated",
    "review_band": "Low, neutral, high or not reviewed",
    "service_band_key": "Hash of the three bands",
    "full_date": "Calendar day",
    "date_key": "Day as yyyyMMdd",
    "purchase_date_key": "Day of purchase as yyyyMMdd",
    "delivery_date_key": "Day of delivery as yyyyMMdd",
    "purchase_year_month": "Month of purchase as yyyy-MM",
    "year": "Year",
    "month_number": "Month from 1 to 12",
    "month_name": "Name of the month",
    "year_month": "Month as yyyy-MM",
    "quarter": "Quarter from 1 to 4",
    "day_of_month": "Day of the month",
    "day_of_week_number": "Day of the week, 1 is Sunday",
    "day_of_week_name": "Name of the day",
    "is_weekend": "Saturday or Sunday",
    "lifetime_order_count": "Orders so far",
    "lifetime_gmv": "Prices plus freight so far",
    "lifetime_avg_ticket": "Mean order value so far",
    "first_order_timestamp": "First purchase",
    "last_order_timestamp": "Last purchase",
    "is_repeat_customer": "More than one order",
    "customer_value_band": "Lifetime value in four bands",
    "lifetime_product_revenue": "Prices of all items sold",
    "lifetime_freight_value": "Freight of all items sold",
    "delivered_order_count": "Delivered orders",
    "order_count": "Orders",
    "avg_delivery_days": "Mean days to delivery",
    "avg_delay_days": "Mean days of delay",
    "avg_freight_value": "Mean freight of an order",
    "avg_ticket_value": "Mean order value",
    "avg_review_score": "Mean score",
    "late_delivery_rate_pct": "Late orders in percent",
    "low_review_rate_pct": "Orders with a low score in percent",
    "service_risk_level": "Low, medium or high",
    "priority_rank": "Rank by urgency, 1 is the most urgent",
}

# Meaning of the lineage columns, shared by all tables that have them.
COMMON_GLOSSARY = dict(
    zip(
        (*BRONZE_LINEAGE, *SILVER_LINEAGE, *GOLD_LINEAGE),
        (
            "File the row was read from",
            "When the row was loaded, UTC",
            "Run that loaded the row",
            "SHA-256 of the source text of the row",
            "Run that made the silver row",
            "When the silver row was made, UTC",
            "Run that made the gold row",
            "When the gold row was made, UTC",
        ),
    )
)

# Sensitivity of each semantic type.
SENSITIVITY = {
    "anonymized_identifier": "confidential",
    "approximate_location": "restricted",
    "geospatial_coordinate": "restricted",
    "financial_metric": "internal",
}

# Classified columns per table and semantic type.
CLASSIFIED = {
    "bronze_customers": {
        "anonymized_identifier": ("customer_id", "customer_unique_id"),
        "approximate_location": ("customer_zip_code_prefix",),
    },
    "bronze_sellers": {
        "anonymized_identifier": ("seller_id",),
        "approximate_location": ("seller_zip_code_prefix",),
    },
    "bronze_geolocation": {
        "approximate_location": ("geolocation_zip_code_prefix",),
        "geospatial_coordinate": ("geolocation_lat", "geolocation_lng"),
    },
    "bronze_order_items": {"financial_metric": ("price", "freight_value")},
    "bronze_order_payments": {"financial_metric": ("payment_value",)},
    "silver_order_service": {
        "anonymized_identifier": ("customer_unique_id", "primary_seller_id"),
        "approximate_location": ("customer_zip_code_prefix", "seller_zip_code_prefix"),
        "geospatial_coordinate": (
            "seller_latitude_geo",
            "seller_longitude_geo",
            "customer_latitude_geo",
            "customer_longitude_geo",
        ),
        "financial_metric": (
            "product_total_value",
            "freight_total_value",
            "gmv_total_value",
            "payment_total_value",
        ),
    },
    "silver_order_items": {"financial_metric": ("price", "freight_value")},
    "silver_geolocation_zip_agg": {
        "approximate_location": ("zip_code_prefix",),
        "geospatial_coordinate": ("latitude", "longitude"),
    },
    "fact_order_service": {
        "anonymized_identifier": ("customer_unique_id", "seller_id"),
        "approximate_location": ("customer_zip_code_prefix",),
        "financial_metric": (
            "product_total_value",
            "freight_total_value",
            "gmv_total_value",
            "payment_total_value",
        ),
    },
    "fact_order_item_sales": {
        "anonymized_identifier": ("customer_unique_id", "seller_id"),
        "approximate_location": ("customer_zip_code_prefix",),
        "financial_metric": ("product_price", "freight_value", "item_gmv"),
    },
    "dim_location": {
        "approximate_location": ("zip_code_prefix",),
        "geospatial_coordinate": ("latitude", "longitude"),
    },
}

# Business domain, grain and classification of each table.
TABLE_TAGS = {
    "bronze_orders": ("sales_logistics", "order", "anonymized"),
    "bronze_order_items": ("sales_logistics", "order_item", "anonymized"),
    "bronze_order_payments": ("payments", "order_payment", "anonymized"),
    "bronze_order_reviews": ("customer_experience", "review", "anonymized"),
    "bronze_customers": ("customer", "customer_order_record", "anonymized"),
    "bronze_products": ("product_catalog", "product", "internal"),
    "bronze_sellers": ("seller", "seller", "anonymized"),
    "bronze_geolocation": ("geolocation", "zip_code_coordinate_record", "sensitive_approximate_location"),
    "bronze_category_translation": ("product_catalog", "product_category", "internal"),
    "silver_customers": ("customer", "customer_order_record", "anonymized"),
    "silver_sellers": ("seller", "seller", "anonymized"),
    "silver_category_translation": ("product_catalog", "product_category", "internal"),
    "silver_products": ("product_catalog", "product", "internal"),
    "silver_orders": ("sales_logistics", "order", "anonymized"),
    "silver_quarantine_orders": ("data_quality", "invalid_order_record", "anonymized"),
    "silver_order_items": ("sales_logistics", "order_item", "anonymized"),
    "silver_quarantine_order_items": ("data_quality", "invalid_order_item_record", "anonymized"),
    "silver_payments_order_agg": ("payments", "order", "anonymized"),
    "silver_reviews_order_agg": ("customer_experience", "order", "anonymized"),
    "silver_geolocation_zip_agg": ("geolocation", "zip_code_prefix", "sensitive_approximate_location"),
    "silver_order_service_base": ("logistics_customer_experience", "order", "anonymized"),
    "silver_order_service": ("logistics_customer_experience", "order", "anonymized"),
    "dim_date": ("shared_dimension", "calendar_date", "internal"),
    "dim_customer": ("customer", "unique_customer", "anonymized"),
    "dim_product": ("product_catalog", "product", "internal"),
    "dim_seller": ("seller", "seller", "anonymized"),
    "dim_location": ("geolocation", "location_role_zip_city_state", "sensitive_approximate_location"),
    "dim_service_band": ("logistics_customer_experience", "service_band_combination", "internal"),
    "fact_order_service": ("logistics_customer_experience", "order", "anonymized"),
    "fact_order_item_sales": ("sales_logistics", "order_item", "anonymized"),
    "mart_logistics_performance": ("logistics_performance", "seller", "anonymized"),
    "mart_service_risk": ("logistics_risk", "seller", "anonymized"),
    "mart_customer_experience": ("customer_experience", "distance_band_delivery_late", "anonymized"),
    "mart_monthly_operations": ("operations_analytics", "purchase_year_month", "anonymized"),
}

# Quality state and latency target by layer.
LAYER_QUALITY = {"bronze": "raw", "silver": "validated", "gold": "business_ready"}
QUARANTINE_QUALITY = "quarantine"
LAYER_LATENCY = {
    "bronze": "D+0_after_file_receipt",
    "silver": "D+0_after_bronze",
    "gold": "D+0_after_silver",
}


# The values that a column may have; NULL is allowed where nothing could be judged.
_FLAGS = ("true", "false")
_SCORES = ("1", "2", "3", "4", "5")
_DISTANCES = (NOT_AVAILABLE, *DISTANCE_ORDER)
_PERFORMANCE = ("not_evaluated", "late", "on_time", "early_3_days_or_more")
_REVIEWS = ("not_reviewed", "low_1_2", "neutral_3", "high_4_5")
DOMAINS: dict[tuple[str, str], tuple[str, ...]] = {
    ("silver_orders", "order_status"): ORDER_STATUSES,
    ("silver_quarantine_orders", "order_status"): ORDER_STATUSES,
    ("silver_order_service", "order_status"): ORDER_STATUSES,
    ("silver_order_service", "review_score_min"): _SCORES,
    ("silver_order_service", "review_score_max"): _SCORES,
    ("silver_order_service", "sales_channel"): (SALES_CHANNEL,),
    ("silver_order_service", "is_low_review"): _FLAGS,
    **{
        (table, column): values
        for table in ("silver_order_service", "fact_order_service")
        for column, values in {
            "is_delivered": _FLAGS,
            "is_delivery_late": _FLAGS,
            "is_delivery_on_time": _FLAGS,
            "distance_band": _DISTANCES,
            "delivery_performance_band": _PERFORMANCE,
            "review_band": _REVIEWS,
        }.items()
    },
    ("fact_order_service", "order_status"): ORDER_STATUSES,
    ("mart_service_risk", "service_risk_level"): RISK_ORDER,
}
