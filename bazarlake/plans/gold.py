"""Star schema and marts.

``order_service`` has one row per order, so order counts are plain counts there; at item grain
they stay exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazarlake.functions import bands
from bazarlake.functions.delivery import date_key
from bazarlake.functions.lineage import GOLD_LINEAGE, joined_hash
from bazarlake.functions.rates import freight_ratio, mean2, mean2_money, rate_pct
from bazarlake.functions.text import NOT_AVAILABLE, or_not_available
from bazarlake.functions.typed import MONEY
from bazarlake.operators.dedupe import keep_one_grouped
from bazarlake.operators.ranking import global_row_number

EVENT_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
BAND_COLUMNS = ("distance_band", "delivery_performance_band", "review_band")
PRODUCT_ATTRIBUTES = (
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)

# ---------------------------------------------------------------- dimensions


def dim_date(order_service: DataFrame) -> DataFrame:
    """Every day on which an order event falls; the five columns are read in one scan."""
    days = F.explode(F.array(*[F.to_date(name) for name in EVENT_COLUMNS])).alias("full_date")
    calendar = order_service.select(days).filter("full_date IS NOT NULL").distinct()
    weekday = F.dayofweek("full_date")
    return calendar.select(
        "full_date",
        date_key("full_date").alias("date_key"),
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month_number"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
        F.quarter("full_date").alias("quarter"),
        F.dayofmonth("full_date").alias("day_of_month"),
        weekday.alias("day_of_week_number"),
        F.date_format("full_date", "EEEE").alias("day_of_week_name"),
        weekday.isin(1, 7).alias("is_weekend"),
    )


def _customer_profile(order_service: DataFrame) -> DataFrame:
    """Metrics and latest address per person in one grouping."""
    address = F.struct("customer_city", "customer_state", "customer_zip_code_prefix")
    recency = F.struct("order_purchase_timestamp", "order_id")
    return (
        order_service.filter("customer_unique_id IS NOT NULL")
        .groupBy("customer_unique_id")
        .agg(
            F.count("order_id").alias("lifetime_order_count"),
            F.sum("gmv_total_value").alias("lifetime_gmv"),
            mean2_money("gmv_total_value").alias("lifetime_avg_ticket"),
            F.min("order_purchase_timestamp").alias("first_order_timestamp"),
            F.max("order_purchase_timestamp").alias("last_order_timestamp"),
            F.max_by(address, recency).alias("address"),
        )
    )


CUSTOMER_METRICS = (
    "lifetime_order_count",
    "lifetime_gmv",
    "lifetime_avg_ticket",
    "first_order_timestamp",
    "last_order_timestamp",
)


def customer_metrics(order_service: DataFrame) -> DataFrame:
    return _customer_profile(order_service).select("customer_unique_id", *CUSTOMER_METRICS)


def customer_reference(order_service: DataFrame) -> DataFrame:
    return _customer_profile(order_service).select("customer_unique_id", "address.*")


def dim_customer(order_service: DataFrame) -> DataFrame:
    return _customer_profile(order_service).select(
        "customer_unique_id",
        *CUSTOMER_METRICS,
        "address.*",
        (F.col("lifetime_order_count") > 1).alias("is_repeat_customer"),
        bands.customer_value_band().alias("customer_value_band"),
    )


def dim_product(products: DataFrame, translations: DataFrame) -> DataFrame:
    english = translations.select("product_category_name", "product_category_name_english")
    return products.join(english, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        or_not_available(F.col("product_category_name_english")).alias("product_category_name_english"),
        *PRODUCT_ATTRIBUTES,
    )


def seller_metrics(items: DataFrame) -> DataFrame:
    return items.groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("lifetime_order_count"),
        F.sum("price").alias("lifetime_product_revenue"),
        F.sum("freight_value").alias("lifetime_freight_value"),
    )


def dim_seller(sellers: DataFrame, items: DataFrame) -> DataFrame:
    no_sales = F.lit(0).cast(MONEY)  # a decimal zero; a double one would turn the sums into doubles
    metrics = seller_metrics(items)
    return sellers.join(metrics, "seller_id", "left").select(
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        F.coalesce("lifetime_order_count", F.lit(0)).alias("lifetime_order_count"),
        F.coalesce("lifetime_product_revenue", no_sales).alias("lifetime_product_revenue"),
        F.coalesce("lifetime_freight_value", no_sales).alias("lifetime_freight_value"),
    )


LOCATION_KEY = ("location_role", "zip_code_prefix", "city", "state")


def _location(role: str) -> Column:
    return F.struct(
        F.lit(role).alias("location_role"),
        F.col(f"{role}_zip_code_prefix").alias("zip_code_prefix"),
        F.col(f"{role}_city").alias("city"),
        F.col(f"{role}_state").alias("state"),
        F.col(f"{role}_latitude_geo").alias("latitude"),
        F.col(f"{role}_longitude_geo").alias("longitude"),
    )


def dim_location(order_service: DataFrame) -> DataFrame:
    """Places in both roles; each order gives two rows in one scan instead of a union of two."""
    both = F.explode(F.array(_location("customer"), _location("seller"))).alias("place")
    places = order_service.select(both).select("place.*").filter("zip_code_prefix IS NOT NULL")
    return keep_one_grouped(places, LOCATION_KEY)


def service_band_key() -> Column:
    return joined_hash([or_not_available(F.col(name)) for name in BAND_COLUMNS])


def dim_service_band(order_service: DataFrame) -> DataFrame:
    triples = order_service.select(*BAND_COLUMNS).fillna(NOT_AVAILABLE).distinct()
    return triples.select(service_band_key().alias("service_band_key"), *BAND_COLUMNS)


# ---------------------------------------------------------------- facts


def fact_order_service(order_service: DataFrame) -> DataFrame:
    """Order fact. The band key is a hash of the bands, so it needs no join with the dimension."""
    return order_service.select(
        "order_id",
        date_key("order_purchase_timestamp").alias("purchase_date_key"),
        date_key("order_delivered_customer_date").alias("delivery_date_key"),
        "customer_unique_id",
        "customer_zip_code_prefix",
        F.col("primary_seller_id").alias("seller_id"),
        service_band_key().alias("service_band_key"),
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
    )


def fact_order_item_sales(items: DataFrame, order_service: DataFrame) -> DataFrame:
    """Item fact; lateness, score and distance are those of the whole order."""
    return items.join(order_service, "order_id").select(
        "order_id",
        "order_item_id",
        date_key("order_purchase_timestamp").alias("purchase_date_key"),
        "customer_unique_id",
        "customer_zip_code_prefix",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        F.col("price").alias("product_price"),
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_gmv"),
        F.round(freight_ratio(), 4).cast("decimal(18,4)").alias("freight_to_price_ratio"),
        "order_status",
        "is_delivery_late",
        "is_delivery_on_time",
        "review_score_avg",
        "seller_customer_distance_km",
        "distance_band",
        "sales_channel",
    )


# ---------------------------------------------------------------- marts


def _late_pct() -> Column:
    """Share of late orders in all orders of the group; not evaluable counts as not late."""
    return rate_pct(F.col("is_delivery_late")).alias("late_delivery_rate_pct")


def _low_review_pct() -> Column:
    """Share of low scores in all orders of the group; no review counts as not low."""
    return rate_pct(F.col("review_score_avg") <= 2).alias("low_review_rate_pct")


def mart_logistics_performance(fact: DataFrame) -> DataFrame:
    judged = fact.filter("order_status = 'delivered' AND is_delivery_late IS NOT NULL")
    return judged.groupBy("seller_id").agg(
        F.count("order_id").alias("delivered_order_count"),
        F.sum("gmv_total_value").alias("gmv_total_value"),
        mean2("actual_delivery_days").alias("avg_delivery_days"),
        _late_pct(),
        mean2("delivery_delay_days").alias("avg_delay_days"),
        mean2_money("freight_total_value").alias("avg_freight_value"),
        mean2("review_score_avg").alias("avg_review_score"),
        _low_review_pct(),
    )


def mart_service_risk(logistics: DataFrame, order_by: str = "severity") -> DataFrame:
    """Sellers with risk level and rank.

    ``severity`` ranks high before medium before low; ``label`` sorts the level's name downwards
    (medium, low, high). Ties end at the seller id, a missing seller last.
    """
    graded = logistics.drop(*GOLD_LINEAGE).withColumn("service_risk_level", bands.service_risk_level())
    lead = {
        "severity": bands.position_in(bands.RISK_ORDER, "service_risk_level").asc(),
        "label": F.desc("service_risk_level"),
    }[order_by]
    order = [lead, F.desc("gmv_total_value"), F.desc("late_delivery_rate_pct"), F.asc_nulls_last("seller_id")]
    ranked = global_row_number(graded, order, "priority_rank")
    return ranked.withColumn("priority_rank", F.col("priority_rank").cast("int"))  # the mart's type


def mart_customer_experience(fact: DataFrame) -> DataFrame:
    delivered = fact.filter("order_status = 'delivered'")
    return delivered.groupBy("distance_band", "is_delivery_late").agg(
        F.count("order_id").alias("delivered_order_count"),
        mean2("actual_delivery_days").alias("avg_delivery_days"),
        mean2_money("freight_total_value").alias("avg_freight_value"),
        mean2("review_score_avg").alias("avg_review_score"),
        _low_review_pct(),
    )


def mart_monthly_operations(fact: DataFrame) -> DataFrame:
    day = F.to_date(F.col("purchase_date_key").cast("string"), "yyyyMMdd")
    dated = fact.filter("purchase_date_key IS NOT NULL")
    return (
        dated.withColumn("purchase_year_month", F.date_format(day, "yyyy-MM"))
        .groupBy("purchase_year_month")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("gmv_total_value").alias("gmv_total_value"),
            mean2_money("gmv_total_value").alias("avg_ticket_value"),
            mean2("actual_delivery_days").alias("avg_delivery_days"),
            _late_pct(),
            mean2("review_score_avg").alias("avg_review_score"),
        )
        .orderBy("purchase_year_month")
    )
