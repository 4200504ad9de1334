"""Every query by name: ``(spark, folder of the supplied tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazarlake.functions import bands, lineage, rates, text, typed
from bazarlake.lake import LAYERS, Lake, WrittenLake, build
from bazarlake.operators.dedupe import keep_one
from bazarlake.operators.distinct import distinct_counts
from bazarlake.operators.heavy_join import split_join
from bazarlake.operators.keys import only_in, orphan_count
from bazarlake.operators.ranking import global_row_number
from bazarlake.operators.workdir import fresh_folder, materialize
from bazarlake.plans import analyses, bronze, dictionary, gold, quality, silver
from bazarlake.sources import files
from bazarlake.sources.adapter import text_feed
from bazarlake.sources.feeds import FEEDS

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "20240101T000000Z"
RUN_TS = datetime(2024, 1, 1)

_QUERIES: dict[str, Query] = {}
# Per session, folder and state of its files: if a table changes, nothing old is given. A Lake holds
# plans only, so sharing it saves analysis, not execution.
_Key = tuple[str, str, int]
_PLANS: dict[_Key, Lake] = {}
_WRITTEN: dict[_Key, WrittenLake] = {}
_PROFILES: dict[_Key, DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str) -> _Key:
    """Session, folder, and a hash over names, sizes and times of the files below it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files_below = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    state = []
    while files_below.hasNext():
        status = files_below.next()
        state.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return spark.sparkContext.applicationId, sf_dir, hash(tuple(sorted(state)))


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    """All tables as lazy plans over the supplied tables."""
    key = _key(spark, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = Lake(lambda name: text_feed(spark, sf_dir, name))
    return _PLANS[key]


def bronze_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bronze.stamped(text_feed(spark, sf_dir, name), FEEDS[name], RUN_ID, RUN_TS)


def stamped_lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    """The same with lineage columns."""
    return Lake(lambda name: bronze_of(spark, sf_dir, name))


def written_lake_of(spark: SparkSession, sf_dir: str) -> WrittenLake:
    """All layers written once per session, for the reports that look at every table."""
    key = _key(spark, sf_dir)
    if key not in _WRITTEN:
        root = fresh_folder(spark, "lake")
        _WRITTEN[key] = build(spark, lambda name: text_feed(spark, sf_dir, name), root, RUN_ID, RUN_TS)
    return _WRITTEN[key]


def _written_copy(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    root = fresh_folder(spark, "table")
    files.write_table(df, root, name)
    return files.read_table(spark, root, name)


# ---------------------------------------------------------------- sources, sinks, lineage


def _csv_copy(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = f"{fresh_folder(spark, 'landing')}/{FEEDS[name].file}"
    files.write_csv_text(text_feed(spark, sf_dir, name), path)
    return path


@query
def src_csv_text(spark, sf_dir):
    return files.read_csv_text(spark, _csv_copy(spark, sf_dir, "orders"), FEEDS["orders"])


def _damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """The orders as CSV lines, some with a field too many, one too few, or a quote that never closes."""
    orders, name = text_feed(spark, sf_dir, "orders"), FEEDS["orders"].columns
    k = F.try_to_number(F.trim("order_id"), F.lit("999999999999"))
    whole = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in name])
    line = (
        F.when(k % 97 == 1, F.concat(whole, F.lit(",extra")))
        .when(k % 89 == 1, F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in name[:-1]]))
        .when(k % 83 == 1, F.concat(F.lit('"'), whole))
        .otherwise(whole)
    )
    path = f"{fresh_folder(spark, 'landing')}/{FEEDS['orders'].file}"
    orders.select(line.alias("value")).write.text(path)
    return path


@query
def src_csv_checked(spark, sf_dir):
    """Records per reject reason of a damaged CSV; those without a reason are the accepted ones."""
    records = files.read_csv_checked(spark, _damaged_csv(spark, sf_dir), FEEDS["orders"])
    reason = F.coalesce(files.REJECT_REASON, F.lit("accepted"))
    return records.groupBy(reason.alias("verdict")).agg(
        F.count("*").alias("record_count"), F.count("order_status").alias("status_count")
    )


@query
def src_table(spark, sf_dir):
    return _written_copy(spark, text_feed(spark, sf_dir, "products"), "bronze_products")


@query
def src_sql_table(spark, sf_dir):
    text_feed(spark, sf_dir, "order_items").createOrReplaceTempView("bazarlake_order_items")
    return spark.sql("SELECT order_id, order_item_id, seller_id, price FROM bazarlake_order_items")


@query
def src_local_rows(spark, sf_dir):
    local = spark.createDataFrame([(f.file, f.table) for f in FEEDS.values()], "source_file string, table_name string")
    counts = bronze.source_counts({name: bronze_of(spark, sf_dir, name) for name in FEEDS})
    return local.join(counts, "source_file", "left")


@query
def sink_overwrite(spark, sf_dir):
    root = fresh_folder(spark, "sink")
    orders = lake_of(spark, sf_dir).silver_orders
    files.write_table(orders.select("order_id"), root, "silver_orders")
    files.write_table(orders, root, "silver_orders")
    return files.written_row_count(spark, root, "silver_orders")


@query
def bronze_lineage(spark, sf_dir):
    raw = text_feed(spark, sf_dir, "order_items")
    marked = lineage.with_bronze_lineage(raw, FEEDS["order_items"].file, RUN_ID, RUN_TS)
    return marked.select("order_id", "order_item_id", *lineage.BRONZE_LINEAGE[:3])


@query
def record_hash(spark, sf_dir):
    return bronze_of(spark, sf_dir, "orders").select("order_id", "record_hash")


@query
def ingest_bronze(spark, sf_dir):
    root = fresh_folder(spark, "bronze")
    return quality.union_all(
        [
            bronze.ingest_bronze(spark, _csv_copy(spark, sf_dir, name), feed, root, RUN_ID, RUN_TS)
            for name, feed in FEEDS.items()
        ]
    )


@query
def silver_lineage(spark, sf_dir):
    sellers = lake_of(spark, sf_dir).silver_sellers
    return lineage.with_silver_lineage(sellers, RUN_ID, RUN_TS).select("seller_id", *lineage.SILVER_LINEAGE)


@query
def gold_lineage(spark, sf_dir):
    products = lake_of(spark, sf_dir).dim_product
    return lineage.with_gold_lineage(products, RUN_ID, RUN_TS).select("product_id", *lineage.GOLD_LINEAGE)


@query
def layer_manifest_gate(spark, sf_dir):
    found = bronze.source_counts({name: bronze_of(spark, sf_dir, name) for name in FEEDS})
    return bronze.manifest_gate(bronze.expected_files(spark), found)


@query
def layer_gates(spark, sf_dir):
    """Tables of all three layers with the rows that their writes counted."""
    lake = written_lake_of(spark, sf_dir)
    return quality.union_all([lake.gate(layer) for layer in LAYERS])


# ---------------------------------------------------------------- cleaning expressions


@query
def normalize_text(spark, sf_dir):
    return text_feed(spark, sf_dir, "products").select("product_id", text.normalize_text("product_category_name"))


@query
def normalize_city(spark, sf_dir):
    return text_feed(spark, sf_dir, "geolocation").select(
        "geolocation_zip_code_prefix", text.normalize_city("geolocation_city")
    )


@query
def clean_id(spark, sf_dir):
    return text_feed(spark, sf_dir, "order_reviews").select("review_id", text.clean_id("review_comment_message"))


@query
def clean_state(spark, sf_dir):
    return text_feed(spark, sf_dir, "customers").select("customer_id", text.clean_state("customer_state"))


@query
def zip5(spark, sf_dir):
    raw = text_feed(spark, sf_dir, "customers")
    return raw.select("customer_id", text.zip5("customer_zip_code_prefix"))


@query
def cast_numeric(spark, sf_dir):
    return text_feed(spark, sf_dir, "products").select(
        "product_id",
        typed.to_int("product_description_lenght").alias("as_int"),
        typed.to_double("product_weight_g").alias("as_double"),
        typed.to_money("product_length_cm").alias("as_money"),
    )


@query
def try_cast_score(spark, sf_dir):
    return text_feed(spark, sf_dir, "order_reviews").select("review_id", "order_id", typed.to_int("review_score"))


@query
def parse_timestamp(spark, sf_dir):
    return text_feed(spark, sf_dir, "orders").select(
        "order_id", typed.to_ts("order_purchase_timestamp"), typed.to_ts("order_approved_at")
    )


@query
def try_parse_timestamp(spark, sf_dir):
    return text_feed(spark, sf_dir, "orders").select("order_id", typed.to_ts_strict("order_purchase_timestamp"))


@query
def rename_columns(spark, sf_dir):
    raw = text_feed(spark, sf_dir, "products")
    return raw.select("product_id", "product_name_lenght").withColumnRenamed(
        "product_name_lenght", "product_name_length"
    )


@query
def project_qualified(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    items, orders = lake.silver_order_items.alias("i"), lake.silver_orders.alias("o")
    joined = items.join(orders, F.col("i.order_id") == F.col("o.order_id"))
    return joined.select("i.*", "o.customer_id", "o.order_status")


@query
def literal_column(spark, sf_dir):
    orders = lake_of(spark, sf_dir).silver_orders
    return orders.select("order_id", F.lit(silver.SALES_CHANNEL).alias("sales_channel"))


@query
def coalesce_default(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    translated = lake.silver_products.join(lake.silver_category_translation, "product_category_name", "left")
    return translated.select(
        "product_id",
        text.or_not_available(F.col("product_category_name_english")).alias("product_category_name_english"),
        F.coalesce("product_description_length", F.lit(0)).alias("product_description_length"),
    )


@query
def fill_null_strings(spark, sf_dir):
    raw = text_feed(spark, sf_dir, "products").select("product_id", "product_category_name")
    return raw.fillna(text.NOT_AVAILABLE)


@query
def drop_column(spark, sf_dir):
    return text_feed(spark, sf_dir, "sellers").drop("seller_city")


# ---------------------------------------------------------------- filters


@query
def filter_nonblank_key(spark, sf_dir):
    raw = text_feed(spark, sf_dir, "products").select("product_id", "product_category_name")
    return raw.filter(~text.is_blank("product_category_name"))


@query
def filter_range(spark, sf_dir):
    scored = text_feed(spark, sf_dir, "order_reviews").select("review_id", "order_id", typed.to_int("review_score"))
    return scored.filter(F.col("review_score").between(*silver.SCORE_RANGE))


@query
def filter_nonnegative(spark, sf_dir):
    paid = text_feed(spark, sf_dir, "order_payments").select(
        "order_id", "payment_sequential", typed.to_money("payment_value")
    )
    return paid.filter(F.col("payment_value") >= 0)


@query
def filter_domain(spark, sf_dir):
    orders = lake_of(spark, sf_dir).orders_typed.select("order_id", "order_status")
    return orders.filter(~F.col("order_status").isin(*silver.ORDER_STATUSES))


@query
def filter_bool_tri(spark, sf_dir):
    service = lake_of(spark, sf_dir).silver_order_service_base
    judged = service.filter("is_delivered = true AND is_delivery_late IS NOT NULL")
    return judged.select("order_id", "is_delivered", "is_delivery_late")


@query
def having_min_volume(spark, sf_dir):
    items = lake_of(spark, sf_dir).silver_order_items
    volume = items.groupBy("seller_id").agg(F.countDistinct("order_id").alias("order_count"))
    return volume.filter(F.col("order_count") >= analyses.MIN_ORDERS)


# ---------------------------------------------------------------- silver


def _lake_query(name: str, table: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(lake_of(spark, sf_dir), table or name)

    run.__name__ = name
    query(run)


for _name in (
    "silver_customers",
    "silver_sellers",
    "silver_category_translation",
    "silver_products",
    "orders_typed",
    "silver_orders",
    "items_typed",
    "silver_order_items",
    "payments_typed",
    "silver_payments_order_agg",
    "reviews_typed",
    "silver_reviews_order_agg",
    "geolocation_typed",
    "silver_geolocation_zip_agg",
):
    _lake_query(_name)
_lake_query("order_service_base", "silver_order_service_base")
_lake_query("order_service", "silver_order_service")


@query
def quarantine_orders(spark, sf_dir):
    return stamped_lake_of(spark, sf_dir).silver_quarantine_orders


@query
def quarantine_order_items(spark, sf_dir):
    return stamped_lake_of(spark, sf_dir).silver_quarantine_order_items


@query
def order_items_agg(spark, sf_dir):
    return silver.order_items_agg(lake_of(spark, sf_dir).silver_order_items)


@query
def order_primary_seller(spark, sf_dir):
    return silver.order_primary_seller(lake_of(spark, sf_dir).silver_order_items)


@query
def seller_origin(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return silver.seller_origin(lake.silver_sellers, lake.silver_geolocation_zip_agg)


@query
def customer_destination(spark, sf_dir):
    return silver.customer_destination(lake_of(spark, sf_dir).silver_geolocation_zip_agg)


def _order_column(name: str, *columns: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lake_of(spark, sf_dir).silver_order_service.select("order_id", *(columns or (name,)))

    run.__name__ = name
    query(run)


for _name in (
    "actual_delivery_days",
    "delivery_delay_days",
    "delivery_early_days",
    "is_delivered",
    "is_delivery_late",
    "is_delivery_on_time",
    "is_low_review",
    "seller_customer_distance_km",
):
    _order_column(_name)
_order_column("distance_band", "seller_customer_distance_km", "distance_band")
_order_column("delivery_performance_band", "delivery_early_days", "delivery_performance_band")
_order_column("review_band", "review_score_avg", "review_band")


# ---------------------------------------------------------------- gold

for _name in (
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_location",
    "dim_service_band",
    "fact_order_service",
    "fact_order_item_sales",
    "mart_logistics_performance",
    "mart_service_risk",
    "mart_customer_experience",
    "mart_monthly_operations",
):
    _lake_query(_name)


@query
def customer_metrics(spark, sf_dir):
    return gold.customer_metrics(lake_of(spark, sf_dir).silver_order_service)


@query
def customer_reference(spark, sf_dir):
    return gold.customer_reference(lake_of(spark, sf_dir).silver_order_service)


@query
def seller_metrics(spark, sf_dir):
    return gold.seller_metrics(lake_of(spark, sf_dir).silver_order_items)


@query
def mart_service_risk_by_label(spark, sf_dir):
    return gold.mart_service_risk(lake_of(spark, sf_dir).mart_logistics_performance, order_by="label")


# ---------------------------------------------------------------- business queries


@query
def kpi_overview(spark, sf_dir):
    return analyses.kpi_overview(lake_of(spark, sf_dir).fact_order_service)


@query
def q1_category(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return analyses.q1_category(lake.fact_order_item_sales, lake.dim_product)


@query
def q1_seller(spark, sf_dir):
    return analyses.q1_seller(lake_of(spark, sf_dir).fact_order_item_sales)


@query
def q1_state(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return analyses.q1_state(lake.fact_order_service, lake.dim_customer)


@query
def q2_seller(spark, sf_dir):
    return analyses.q2_seller(lake_of(spark, sf_dir).mart_logistics_performance)


@query
def q2_category(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return analyses.q2_category(lake.fact_order_item_sales, lake.dim_product)


@query
def q2_state(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return analyses.q2_state(lake.fact_order_service, lake.dim_customer)


@query
def q3_late_vs_review(spark, sf_dir):
    return analyses.q3_late_vs_review(lake_of(spark, sf_dir).fact_order_service)


@query
def q4_distance(spark, sf_dir):
    return analyses.q4_distance(lake_of(spark, sf_dir).fact_order_service)


@query
def q5_seller_priority(spark, sf_dir):
    return analyses.q5_seller_priority(lake_of(spark, sf_dir).mart_logistics_performance)


@query
def q5_category_priority(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return analyses.q5_category_priority(lake.fact_order_item_sales, lake.dim_product)


@query
def q6_cohorts(spark, sf_dir):
    return analyses.q6_cohorts(lake_of(spark, sf_dir).fact_order_service)


@query
def q7_freight_vs_review(spark, sf_dir):
    return analyses.q7_freight_vs_review(lake_of(spark, sf_dir).silver_order_service)


@query
def q8_growth_and_delay(spark, sf_dir):
    return analyses.q8_growth_and_delay(lake_of(spark, sf_dir).fact_order_service)


@query
def q9_payment_mix(spark, sf_dir):
    return analyses.q9_payment_mix(lake_of(spark, sf_dir).silver_order_service)


# ---------------------------------------------------------------- joins


@query
def join_left_single(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return lake.silver_orders.join(lake.silver_payments_order_agg, "order_id", "left").select(
        "order_id", "order_status", "payment_total_value", "payment_types"
    )


@query
def join_left_role(spark, sf_dir):
    service = lake_of(spark, sf_dir).silver_order_service
    return service.select("order_id", *[f"{r}_{c}_geo" for r in ("seller", "customer") for c in ("latitude", "longitude")])


@query
def join_left_chain(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    primary = silver.order_primary_seller(lake.silver_order_items)
    origin = silver.seller_origin(lake.silver_sellers, lake.silver_geolocation_zip_agg)
    chained = lake.silver_orders.join(primary, "order_id", "left").join(origin, "primary_seller_id", "left")
    return chained.select("order_id", "primary_seller_id", "seller_count", "seller_city", "seller_state")


@query
def join_left_using(spark, sf_dir):
    service = lake_of(spark, sf_dir).silver_order_service
    return gold.customer_metrics(service).join(gold.customer_reference(service), "customer_unique_id", "left")


@query
def join_left_dim(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return lake.silver_sellers.join(gold.seller_metrics(lake.silver_order_items), "seller_id", "left").select(
        "seller_id", "seller_state", "lifetime_order_count", "lifetime_product_revenue"
    )


@query
def join_left_multikey(spark, sf_dir):
    """Both sides come from the orders' bands, which are computed once; the dimension has at most
    one row per combination of the fixed labels."""
    keys = list(gold.BAND_COLUMNS)
    banded = materialize(lake_of(spark, sf_dir).silver_order_service.select("order_id", *keys))
    return banded.join(F.broadcast(gold.dim_service_band(banded)), keys, "left")


@query
def join_inner_fact(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return lake.silver_order_items.join(lake.silver_orders, "order_id").select(
        "order_id", "order_item_id", "order_status", "price"
    )


@query
def join_left_sql(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return spark.sql(
        """
        SELECT i.order_id, i.order_item_id, p.product_category_name, i.item_gmv
        FROM {items} i LEFT JOIN {products} p ON i.product_id = p.product_id
        """,
        items=lake.fact_order_item_sales,
        products=lake.dim_product,
    )


@query
def join_left_heavy(spark, sf_dir):
    """Items with their product's category; products with more than a hundredth of the items are split."""
    lake = lake_of(spark, sf_dir)
    items = lake.fact_order_item_sales.select("order_id", "order_item_id", "product_id", "item_gmv")
    categories = lake.dim_product.select("product_id", "product_category_name")
    return split_join(items, categories, ["product_id"], spread=["order_id", "order_item_id"])


@query
def join_left_anti_hash(spark, sf_dir):
    lake = stamped_lake_of(spark, sf_dir)
    rejected = lake.silver_quarantine_orders.select("record_hash").distinct()
    return lake.orders_typed.join(rejected, "record_hash", "left_anti").select("order_id", "record_hash")


@query
def join_left_anti_orphans(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    pairs = {
        "order_items -> orders": (lake.silver_order_items, lake.silver_orders, "order_id"),
        "orders -> payments": (lake.silver_orders, lake.silver_payments_order_agg, "order_id"),
        "orders -> reviews": (lake.silver_orders, lake.silver_reviews_order_agg, "order_id"),
    }
    return quality.union_all(
        [
            orphan_count(child, parent, key).select(F.lit(name).alias("relationship"), "orphan_record_count")
            for name, (child, parent, key) in pairs.items()
        ]
    )


@query
def join_cross_scalar(spark, sf_dir):
    return _seller_benchmarks(spark, sf_dir)


# ---------------------------------------------------------------- aggregations


@query
def agg_global(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_order_items.agg(
        F.count("*").alias("item_count"),
        F.sum("price").alias("price_sum"),
        rates.mean2_money("price").alias("price_mean"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
    )


@query
def agg_group(spark, sf_dir):
    return lake_of(spark, sf_dir).payments_typed.groupBy("payment_type", "payment_installments").agg(
        F.count("*").alias("payment_count"),
        F.sum("payment_value").alias("value_sum"),
        rates.mean2_money("payment_value").alias("value_mean"),
        F.min("payment_value").alias("value_min"),
        F.max("payment_value").alias("value_max"),
    )


@query
def agg_count_distinct(spark, sf_dir):
    counted = {"product_id": "distinct_product_count", "seller_id": "distinct_seller_count"}
    return distinct_counts(lake_of(spark, sf_dir).silver_order_items, ["order_id"], counted)


@query
def agg_conditional_rate(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_order_service.groupBy("customer_state").agg(
        rates.rate_pct(F.col("is_delivery_late")).alias("late_pct"),
        rates.rate_pct(F.col("is_low_review")).alias("low_review_pct"),
    )


@query
def agg_tristate_rate(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_order_service.groupBy("customer_state").agg(
        rates.tristate_rate_pct(F.col("is_delivery_late")).alias("late_pct"),
        rates.tristate_rate_pct(F.col("is_low_review")).alias("low_review_pct"),
    )


@query
def agg_count_if(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_order_service.groupBy("order_status").agg(
        F.count_if("is_delivery_late").alias("late_orders"),
        F.count_if("is_delivery_on_time").alias("on_time_orders"),
        F.count_if(F.col("review_score_avg").isNull()).alias("orders_without_review"),
    )


@query
def agg_avg_ratio(spark, sf_dir):
    return silver.order_items_agg(lake_of(spark, sf_dir).silver_order_items).select(
        "order_id", "avg_freight_to_price_ratio"
    )


@query
def agg_collect_set(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_payments_order_agg.select("order_id", "payment_types")


@query
def agg_first_nonnull(spark, sf_dir):
    return silver.order_primary_seller(lake_of(spark, sf_dir).silver_order_items).select(
        "order_id", "primary_seller_id"
    )


@query
def agg_percentile_vector(spark, sf_dir):
    mart = lake_of(spark, sf_dir).mart_logistics_performance
    vector = F.percentile_approx("gmv_total_value", list(quality.PERCENTILES), quality.ACCURACY)
    names = ("p01", "p25", "p50", "p75", "p99")
    return mart.agg(vector.alias("v")).select(*[F.get("v", F.lit(i)).alias(n) for i, n in enumerate(names)])


@query
def agg_percentile_scalar(spark, sf_dir):
    mart = lake_of(spark, sf_dir).mart_logistics_performance
    return mart.agg(F.percentile_approx("gmv_total_value", analyses.HIGH_REVENUE).alias("p75_gmv"))


@query
def agg_group_expr(spark, sf_dir):
    speed = F.when(F.col("actual_delivery_days") <= 10, "fast").when(F.col("actual_delivery_days") > 10, "slow")
    grouped = lake_of(spark, sf_dir).silver_order_service_base.groupBy(
        text.or_not_available(speed).alias("delivery_speed")
    )
    return grouped.agg(F.count("*").alias("order_count"))


@query
def agg_latest_timestamp(spark, sf_dir):
    orders = lake_of(spark, sf_dir).silver_orders
    return orders.groupBy("order_status").agg(F.max("order_purchase_timestamp").alias("latest_purchase"))


# ---------------------------------------------------------------- windows, sorts, sets


@query
def win_row_number_global(spark, sf_dir):
    sellers = lake_of(spark, sf_dir).dim_seller
    order = [F.desc("lifetime_product_revenue"), F.desc("lifetime_order_count"), F.asc("seller_id")]
    slim = sellers.select("seller_id", "lifetime_order_count", "lifetime_product_revenue")
    return global_row_number(slim, order, "revenue_rank")


def _seller_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each seller beside the percentile and the means over all of them."""
    kept = materialize(
        lake_of(spark, sf_dir).mart_logistics_performance.select(
            "seller_id", "gmv_total_value", "late_delivery_rate_pct", "avg_review_score"
        )
    )
    compared = kept.crossJoin(F.broadcast(analyses.benchmarks(kept)))
    return compared.select(
        "seller_id",
        "gmv_total_value",
        "p75_gmv",
        F.round("overall_late_rate", 6).alias("overall_late_rate"),
        F.round("overall_review_score", 6).alias("overall_review_score"),
    )


@query
def win_agg_global(spark, sf_dir):
    return _seller_benchmarks(spark, sf_dir)


@query
def sort_single(spark, sf_dir):
    return lake_of(spark, sf_dir).dim_date.select("full_date", "date_key").orderBy("full_date")


@query
def sort_multi(spark, sf_dir):
    mart = lake_of(spark, sf_dir).mart_logistics_performance
    return mart.select("seller_id", "gmv_total_value", "late_delivery_rate_pct").orderBy(
        F.desc("gmv_total_value"), F.asc("late_delivery_rate_pct"), "seller_id"
    )


@query
def sort_case(spark, sf_dir):
    mart = lake_of(spark, sf_dir).mart_customer_experience
    slim = mart.select("distance_band", "is_delivery_late", "delivered_order_count")
    return slim.orderBy(bands.position_in(bands.DISTANCE_ORDER, "distance_band"), "is_delivery_late")


@query
def topk(spark, sf_dir):
    mart = lake_of(spark, sf_dir).mart_logistics_performance
    best = mart.select("seller_id", "gmv_total_value").orderBy(F.desc("gmv_total_value"), "seller_id")
    return best.limit(analyses.TOP_SELLERS)


@query
def union_by_name(spark, sf_dir):
    lake = lake_of(spark, sf_dir)

    def places(df: DataFrame, role: str) -> DataFrame:
        return df.select(
            F.lit(role).alias("location_role"),
            F.col(f"{role}_state").alias("state"),
            F.col(f"{role}_zip_code_prefix").alias("zip_code_prefix"),
        )

    return places(lake.silver_customers, "customer").unionByName(places(lake.silver_sellers, "seller"))


@query
def distinct_rows(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_order_items.select("product_id", "seller_id").distinct()


@query
def dedupe_by_key(spark, sf_dir):
    return keep_one(lake_of(spark, sf_dir).items_typed, ["order_id", "order_item_id"])


@query
def set_difference(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    sold = lake.silver_order_items.select("product_id").distinct()
    return only_in(lake.silver_products.select("product_id"), sold, ["product_id"])


# ---------------------------------------------------------------- scalar function families


@query
def fn_string(spark, sf_dir):
    return text_feed(spark, sf_dir, "geolocation").select(
        F.trim("geolocation_state").alias("trimmed"),
        F.lower("geolocation_city").alias("lowered"),
        F.upper("geolocation_city").alias("uppered"),
        F.initcap(F.lower("geolocation_city")).alias("capitalised"),
        F.lpad("geolocation_zip_code_prefix", 8, "0").alias("padded"),
        F.regexp_replace("geolocation_city", r"\s+", " ").alias("squeezed"),
        F.concat_ws("|", "geolocation_lat", "geolocation_lng").alias("joined"),
    )


@query
def fn_hash(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_sellers.select(
        "seller_id", lineage.joined_hash([F.col("seller_id"), F.col("seller_state")]).alias("key_hash")
    )


@query
def fn_datetime(spark, sf_dir):
    bought = "order_purchase_timestamp"
    return lake_of(spark, sf_dir).silver_orders.select(
        "order_id",
        F.to_date(bought).alias("as_date"),
        F.date_format(bought, "yyyyMMdd").alias("as_digits"),
        F.date_format(bought, "yyyy-MM").alias("as_month"),
        F.date_format(bought, "MMMM").alias("month_name"),
        F.date_format(bought, "EEEE").alias("day_name"),
        F.year(bought).alias("year"),
        F.month(bought).alias("month"),
        F.quarter(bought).alias("quarter"),
        F.dayofmonth(bought).alias("day"),
        F.dayofweek(bought).alias("weekday"),
        F.unix_timestamp(bought).alias("seconds"),
    )


@query
def fn_math(spark, sf_dir):
    return lake_of(spark, sf_dir).silver_geolocation_zip_agg.select(
        "zip_code_prefix",
        F.round(F.radians("latitude"), 6).alias("radians"),
        F.round(F.sin(F.radians("latitude")), 6).alias("sine"),
        F.round(F.cos(F.radians("latitude")), 6).alias("cosine"),
        F.round(F.asin(F.sin(F.radians("latitude"))), 6).alias("arcsine"),
        F.round(F.sqrt(F.pow("latitude", F.lit(2.0))), 6).alias("root"),
        F.greatest("latitude", F.lit(0.0)).alias("positive_latitude"),
    )


@query
def fn_array(spark, sf_dir):
    kinds = F.array_sort(F.collect_set("payment_type"))
    return lake_of(spark, sf_dir).payments_typed.groupBy("payment_installments").agg(
        F.array_join(kinds, "|").alias("payment_types"), F.size(kinds).alias("payment_type_count")
    )


@query
def fn_conditional(spark, sf_dir):
    price = F.col("price")
    return lake_of(spark, sf_dir).silver_order_items.select(
        "order_id",
        "order_item_id",
        F.when(price == 0, "free").when(price.between(1, 50), "low").otherwise("high").alias("price_class"),
        F.coalesce(F.nullif(price, F.lit(0)), F.lit(0)).cast("decimal(18,2)").alias("price_or_zero"),
        F.col("freight_value").isin(1, 2, 3).alias("cheap_freight"),
    )


@query
def fn_unpivot(spark, sf_dir):
    service = lake_of(spark, sf_dir).silver_order_service_base
    wide = service.select("order_id", "actual_delivery_days", "delivery_delay_days", "delivery_early_days")
    return wide.unpivot("order_id", wide.columns[1:], "measure", "days")


@query
def fn_cast(spark, sf_dir):
    return text_feed(spark, sf_dir, "order_items").select(
        "order_id",
        F.col("order_item_id").try_cast("int").alias("item_number"),
        F.col("price").try_cast("double").alias("price_double"),
        F.col("price").try_cast("decimal(18,2)").alias("price_decimal"),
        F.col("freight_value").try_cast("int").alias("freight_int"),
        (F.col("freight_value").try_cast("int") > 0).cast("string").alias("has_freight"),
    )


# ---------------------------------------------------------------- quality


@query
def dq_table_profile(spark, sf_dir):
    return quality.table_profile(quality.column_profiles(written_lake_of(spark, sf_dir).tables()))


@query
def dq_traceability(spark, sf_dir):
    return quality.traceability(written_lake_of(spark, sf_dir).tables())


@query
def dq_volume(spark, sf_dir):
    lake = written_lake_of(spark, sf_dir)
    return quality.volume([(layer, name, lake.table(name)) for layer, name in quality.VOLUME_TABLES])


@query
def dq_completeness(spark, sf_dir):
    return quality.completeness(lake_of(spark, sf_dir).fact_order_service)


@query
def dq_validity(spark, sf_dir):
    return quality.validity(lake_of(spark, sf_dir).fact_order_service)


def _gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lake = written_lake_of(spark, sf_dir)
    names = {name for name, _ in quality.UNIQUE_KEYS} | {name for name, _, _ in quality.FRESHNESS_TABLES}
    return {name: lake.table(name) for name in names}


@query
def dq_uniqueness(spark, sf_dir):
    return quality.uniqueness(_gold_tables(spark, sf_dir))


@query
def dq_referential_integrity(spark, sf_dir):
    return quality.referential_integrity(_gold_tables(spark, sf_dir))


@query
def dq_quarantine_rate(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    return quality.quarantine_rate(lake.orders_typed, lake.items_typed)


@query
def dq_outlier_percentiles(spark, sf_dir):
    return quality.outlier_percentiles(lake_of(spark, sf_dir).fact_order_service)


@query
def dq_outlier_percentiles_exact(spark, sf_dir):
    return quality.outlier_percentiles_exact(lake_of(spark, sf_dir).fact_order_service)


@query
def dq_outlier_sketches(spark, sf_dir):
    """Percentiles from merged monthly sketches, and whether their true rank is within the stated error."""
    fact = lake_of(spark, sf_dir).fact_order_service
    sketched = materialize(quality.sketched_percentiles(materialize(quality.monthly_sketches(fact))))
    errors = quality.rank_errors(fact, sketched)
    return errors.select("metric", "fraction", "row_count", (F.col("rank_error") <= quality.RANK_ERROR).alias("within_error"))


@query
def dq_freshness(spark, sf_dir):
    return quality.freshness(_gold_tables(spark, sf_dir))


def _checks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return quality.checks_in_one_scan(written_lake_of(spark, sf_dir).tables())


@query
def dq_summary(spark, sf_dir):
    return quality.summary(**_checks(spark, sf_dir))


@query
def dq_failed_rules(spark, sf_dir):
    return quality.failed_rules(quality.summary(**_checks(spark, sf_dir)))


@query
def dq_drilldown(spark, sf_dir):
    checks = {name: materialize(lines) for name, lines in _checks(spark, sf_dir).items()}  # few lines, read twice each
    return quality.drilldown(quality.summary(**checks), **checks, only_on_failure=False)


# ---------------------------------------------------------------- dictionary


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column profile of the written layers, computed once per session: one row per column."""
    key = _key(spark, sf_dir)
    if key not in _PROFILES:
        _PROFILES[key] = materialize(quality.column_profiles(written_lake_of(spark, sf_dir).tables()))
    return _PROFILES[key]


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.column_inventory(
        _profile(spark, sf_dir), dictionary.column_dictionary(spark), dictionary.common_dictionary(spark)
    )


@query
def dict_column_inventory(spark, sf_dir):
    return _inventory(spark, sf_dir)


@query
def dict_reconcile(spark, sf_dir):
    return dictionary.reconcile(
        _profile(spark, sf_dir), dictionary.column_dictionary(spark), dictionary.common_dictionary(spark)
    )


@query
def dict_coverage(spark, sf_dir):
    return dictionary.coverage(_inventory(spark, sf_dir))


@query
def dict_undocumented(spark, sf_dir):
    return dictionary.undocumented(_inventory(spark, sf_dir))


@query
def dict_classified_profile(spark, sf_dir):
    return dictionary.classified_profile(_profile(spark, sf_dir), dictionary.column_dictionary(spark))


@query
def dict_domains(spark, sf_dir):
    """Observed against declared values; orders under quarantine are where undeclared ones stay."""
    return dictionary.observed_domains(written_lake_of(spark, sf_dir).tables())


@query
def dict_cardinality(spark, sf_dir):
    """Distinct keys by sketch, and whether the estimate is within the stated error of the exact count."""
    tables = [t for t in written_lake_of(spark, sf_dir).tables() if t[1] in _SKETCHED]
    slim = [(layer, name, df.select(_SKETCHED[name])) for layer, name, df in tables]
    estimated = dictionary.cardinalities(slim).drop("sketch")
    exact = quality.union_all(
        [distinct_counts(df, [], {_SKETCHED[name]: "exact"}).select(F.lit(name).alias("table_name"), "exact") for _, name, df in slim]
    )
    error = F.abs(F.col("estimate") - F.col("exact")) <= dictionary.CARDINALITY_ERROR * F.col("exact")
    return estimated.join(exact, "table_name").select(
        "table_name", "column_name", "row_count", F.col("exact").alias("distinct_count"), error.alias("within_error")
    )


_SKETCHED = {name: keys[0] for name, keys in quality.UNIQUE_KEYS if len(keys) == 1} | {"silver_order_items": "order_id"}
