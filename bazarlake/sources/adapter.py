"""Turns the supplied order, line, customer, part, supplier and nation tables into the nine feeds.

Every column comes out as text, as it would from the CSV files, with dirty values mixed in by
fixed rules on the keys: bad dates and statuses, blanks, negative values, repeated rows, shared
review ids and coordinates outside the country. All arithmetic is on integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazarlake.sources.feeds import FEEDS


# The supplied columns that the feeds use; declaring them saves a job that reads file footers.
_SUPPLIED = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SUPPLIED[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _later(days: int | Column, hours: int = 0) -> Column:
    """Order date plus days and hours, as text."""
    span = F.make_dt_interval(days if isinstance(days, Column) else F.lit(days), F.lit(hours))
    return _text(F.col("o_orderdate") + span)


def _cents(column: Column) -> Column:
    """Whole cents as decimal text."""
    size = F.abs(column)
    units, rest = _text(F.floor(size / 100)), _text(size % 100)
    return F.concat(F.when(column < 0, "-").otherwise(""), units, F.lit("."), F.lpad(rest, 2, "0"))


def _orders_with_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with status text and delivery days, which depend on the lowest seller number."""
    k = F.col("o_orderkey")
    first_seller = (
        _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("first_supplier"))
    )
    return (
        _table(spark, sf_dir, "orders")
        .join(first_seller, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn("days", (2 + k % 20 + 3 * (F.col("first_supplier") % 4)).cast("int"))
        .withColumn("status", _status())
    )


def _status() -> Column:
    k = F.col("o_orderkey")
    return (
        F.when(k % 40 == 0, "canceled")
        .when(k % 41 == 1, "lost")
        .when((F.col("o_orderstatus") == "O") & (k % 3 == 0), " Shipped ")
        .otherwise("Delivered")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    repeats = F.when(k % 500 == 3, 2).otherwise(1)
    rows = _orders_with_days(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), repeats)))
    return rows.select(
        _text(k).alias("order_id"),
        F.concat(F.lit("C"), _text(k)).alias("customer_id"),
        F.col("status").alias("order_status"),
        F.when(k % 97 == 0, "not-a-date").otherwise(_later(0)).alias("order_purchase_timestamp"),
        _later(0, 1).alias("order_approved_at"),
        _later(2).alias("order_delivered_carrier_date"),
        F.when(F.col("status") == "Delivered", _later(F.col("days"))).alias("order_delivered_customer_date"),
        _later(24).alias("order_estimated_delivery_date"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    zip_text = _text(F.col("c_nationkey") * 37)
    return (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("C"), _text(k)).alias("customer_id"),
            F.concat(F.lit("U"), _text(F.col("o_custkey") * 10 + k % 10)).alias("customer_unique_id"),
            F.when(k % 10 == 0, F.concat(zip_text, F.lit(".0"))).otherwise(zip_text).alias(
                "customer_zip_code_prefix"
            ),
            F.concat(F.lit("cidade  "), "n_name").alias("customer_city"),
            F.concat(F.lit(" n"), _text(F.col("c_nationkey"))).alias("customer_state"),
        )
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    price = F.floor(F.col("l_extendedprice") / 10)
    return _table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey")).alias("order_id"),
        _text(F.col("l_linenumber")).alias("order_item_id"),
        _text(F.col("l_partkey")).alias("product_id"),
        _text(F.col("l_suppkey")).alias("seller_id"),
        _text(F.col("l_shipdate")).alias("shipping_limit_date"),
        _cents(F.when(quantity == 17, F.lit(0)).otherwise(price)).alias("price"),
        _text(F.when(quantity == 13, F.lit(-1)).otherwise(quantity)).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    total = F.rint(F.col("o_totalprice") * 100).cast("bigint")
    half = F.floor(F.col("total") / 2)
    first = F.when(k % 5 == 0, half).otherwise(F.col("total"))
    sign = F.when(k % 67 == 0, -1).otherwise(1)

    def payment(sequence: int, installments: Column, value: Column) -> Column:
        return F.struct(
            F.lit(sequence).alias("sequence"),
            installments.cast("bigint").alias("installments"),
            (value * sign).cast("bigint").alias("value"),
        )

    none = F.lit(None).cast("struct<sequence:int,installments:bigint,value:bigint>")
    entries = F.array(
        payment(1, 1 + k % 10, first),
        F.when(k % 5 == 0, payment(2, 1 + k % 10, F.col("total") - half)).otherwise(none),
        F.when(k % 53 == 0, payment(1, 2 + k % 10, first)).otherwise(none),
    )
    kinds = F.array(*[F.lit(kind) for kind in ("CREDIT_CARD", "boleto", "voucher", "debit_card")])
    return (
        _table(spark, sf_dir, "orders")
        .withColumn("total", total)
        .select(k, F.explode(F.array_compact(entries)).alias("p"))
        .select(
            _text(k).alias("order_id"),
            _text(F.col("p.sequence")).alias("payment_sequential"),
            F.get(kinds, ((k + F.col("p.sequence")) % 4).cast("int")).alias("payment_type"),
            _text(F.col("p.installments")).alias("payment_installments"),
            _cents(F.col("p.value")).alias("payment_value"),
        )
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    poor = (F.col("status") == "Delivered") & (F.col("days") > 24)
    score = F.when(poor, 1 + k % 3).otherwise(3 + F.floor(k / 7) % 3)
    none = F.lit(None).cast("struct<id:string,score:string>")

    def review(review_id: Column, score_text: Column) -> Column:
        return F.struct(review_id.alias("id"), score_text.alias("score"))

    entries = F.array(
        F.when(
            k % 11 != 0,
            review(
                F.concat(F.lit("R"), _text(F.when(k % 60 == 7, k - 1).otherwise(k))),
                F.when(k % 101 == 0, "x").otherwise(_text(score)),
            ),
        ).otherwise(none),
        F.when(k % 50 <= 3, review(F.concat(F.lit("S"), _text(k)), _text(5 - k % 4))).otherwise(none),
    )
    return (
        _orders_with_days(spark, sf_dir)
        .withColumn("r", F.explode(F.array_compact(entries)))
        .select(
            F.col("r.id").alias("review_id"),
            _text(k).alias("order_id"),
            F.col("r.score").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("review_comment_message"),
            _later(40).alias("review_creation_date"),
            _later(41).alias("review_answer_timestamp"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size, name_length = F.col("p_partkey"), F.col("p_size"), F.length("p_name")
    return _table(spark, sf_dir, "part").select(
        _text(k).alias("product_id"),
        F.when(k % 50 != 0, F.concat(F.lit(" "), "p_type")).alias("product_category_name"),
        _text(name_length).alias("product_name_lenght"),
        F.when(k % 40 == 0, "n/a").otherwise(_text(name_length * 10)).alias("product_description_lenght"),
        _text(size).alias("product_photos_qty"),
        _text(size * 100).alias("product_weight_g"),
        _text(size + 10).alias("product_length_cm"),
        _text(size + 5).alias("product_height_cm"),
        _text(size + 8).alias("product_width_cm"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "supplier")
        .join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _text(F.col("s_suppkey")).alias("seller_id"),
            _text(F.col("s_nationkey") * 37).alias("seller_zip_code_prefix"),
            F.concat(F.lit("cidade  "), "n_name").alias("seller_city"),
            F.concat(F.lit(" n"), _text(F.col("s_nationkey"))).alias("seller_state"),
        )
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _table(spark, sf_dir, "part").select("p_type").distinct().filter("p_type <> 'PROMO'")
    return kinds.select(
        F.col("p_type").alias("product_category_name"),
        F.concat(F.lower("p_type"), F.lit("_en")).alias("product_category_name_english"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, j = F.col("n_nationkey"), F.col("j")
    outside = (j == 3) | (n == 24)  # beyond the bounding box, so that its filter has work
    latitude = F.when(outside, F.lit(5000)).otherwise(-3000 + n * 140 + j)
    return (
        _table(spark, sf_dir, "nation")
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .select(
            _text(n * 37).alias("geolocation_zip_code_prefix"),
            _cents(latitude).alias("geolocation_lat"),
            _cents(-7000 + n * 150 + j).alias("geolocation_lng"),
            F.concat(F.when(j == 1, "vila ").otherwise("cidade  "), "n_name").alias("geolocation_city"),
            F.concat(F.lit(" n"), _text(n)).alias("geolocation_state"),
        )
    )


_BUILDERS = {
    "customers": customers,
    "geolocation": geolocation,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}


def text_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the nine feeds, in the column order of its file."""
    return _BUILDERS[name](spark, sf_dir).select(*FEEDS[name].columns)
