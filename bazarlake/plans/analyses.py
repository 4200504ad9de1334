"""Business queries over the star schema.

Limits are those of the reports themselves (top sellers, worst sellers); every sort ends in the
group key, so that a report is the same on each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazarlake.functions.bands import DISTANCE_ORDER, position_in
from bazarlake.functions.rates import mean2, mean2_money, mean_of_parts, mean_parts, percent_of, tristate_rate_pct
from bazarlake.functions.text import NOT_AVAILABLE, or_not_available
from bazarlake.operators.distinct import distinct_counts
from bazarlake.operators.heavy_join import split_join
from bazarlake.operators.ranking import global_row_number
from bazarlake.operators.workdir import materialize

# Report sizes, least volume of a group and the revenue percentile.
TOP_CATEGORIES = 5
TOP_SELLERS = 20
WORST_SELLERS = 30
PRIORITY_SELLERS = 10
MIN_ORDERS = 20
HIGH_REVENUE = 0.75


def _on_time_pct() -> Column:
    return tristate_rate_pct(F.col("is_delivery_on_time")).alias("on_time_delivery_rate_pct")


def _late_pct() -> Column:
    return tristate_rate_pct(F.col("is_delivery_late")).alias("late_delivery_rate_pct")


def _low_review_pct() -> Column:
    return tristate_rate_pct(F.col("review_score_avg") <= 2).alias("low_review_rate_pct")


def _level(name: str) -> Column:
    return F.lit(name).alias("analysis_level")


def kpi_overview(fact: DataFrame) -> DataFrame:
    """Twelve figures over all orders, one row. Persons and sellers are counted over their own column."""
    people = distinct_counts(fact, [], {"customer_unique_id": "total_customers", "seller_id": "total_reference_sellers"})
    figures = fact.agg(
        F.count("order_id").alias("total_orders"),
        F.sum("gmv_total_value").alias("gmv_total_value"),
        mean2_money("gmv_total_value").alias("avg_ticket_value"),
        F.sum("product_total_value").alias("product_revenue_value"),
        F.sum("freight_total_value").alias("freight_total_value"),
        mean2_money("freight_total_value").alias("avg_freight_value"),
        mean2("actual_delivery_days").alias("avg_delivery_days"),
        _on_time_pct(),
        mean2("delivery_delay_days").alias("avg_delay_days"),
        mean2("review_score_avg").alias("avg_review_score"),
    )
    return figures.crossJoin(F.broadcast(people)).select(  # one row each
        "total_orders", "total_customers", "total_reference_sellers", *figures.columns[1:]
    )


# ---------------------------------------------------------------- 1: concentration


def _item_sales(grouped) -> DataFrame:
    return grouped.agg(
        F.countDistinct("order_id").alias("order_count"),
        F.count("*").alias("item_count"),
        F.sum("product_price").alias("product_revenue_value"),
        F.sum("freight_value").alias("freight_total_value"),
        F.sum("item_gmv").alias("gmv_total_value"),
        mean2_money("item_gmv").alias("avg_ticket_value"),
    )


ITEM_SALES = (
    "order_count",
    "item_count",
    "product_revenue_value",
    "freight_total_value",
    "gmv_total_value",
    "avg_ticket_value",
)


def with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the category of their product. An item of an unknown product is not_available;
    a product whose category is blank keeps the blank. Items of a frequent product are spread."""
    categories = products.select("product_id", F.col("product_category_name").alias("__category"))
    joined = split_join(items, categories, ["product_id"], spread=["order_id"])
    return joined.withColumn("category", or_not_available(F.col("__category"))).drop("__category")


def _top_sales(items: DataFrame, key: str, level: str, size: int) -> DataFrame:
    sales = _item_sales(items.groupBy(F.col(key).alias("analysis_group")))
    report = sales.select("analysis_group", _level(level), *ITEM_SALES)
    return report.orderBy(F.desc("product_revenue_value"), "analysis_group").limit(size)


def q1_category(items: DataFrame, products: DataFrame, size: int = TOP_CATEGORIES) -> DataFrame:
    return _top_sales(with_category(items, products), "category", "category", size)


def q1_seller(items: DataFrame, size: int = TOP_SELLERS) -> DataFrame:
    return _top_sales(items, "seller_id", "seller", size)


def by_state(fact: DataFrame, customers: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Additive measures per state of the person's address in the customer dimension.

    They are summed per person before the join, so a frequent (or missing) person reaches it as
    one row, and once more per state.
    """
    per_person = fact.groupBy("customer_unique_id").agg(*[measure.alias(name) for name, measure in measures.items()])
    placed = per_person.join(customers.select("customer_unique_id", "customer_state"), "customer_unique_id", "left")
    per_state = placed.groupBy(F.col("customer_state").alias("analysis_group"))
    kinds = dict(per_person.dtypes)
    return per_state.agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in measures])


def q1_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    totals = ("product_total_value", "freight_total_value", "gmv_total_value")
    sales = by_state(
        fact,
        customers,
        {"order_count": F.count("order_id")} | {name: F.sum(name) for name in totals} | mean_parts("gmv_total_value", money=True),
    )
    return sales.select(
        "analysis_group",
        _level("customer_state"),
        "order_count",
        F.col("product_total_value").alias("product_revenue_value"),
        "freight_total_value",
        "gmv_total_value",
        mean_of_parts("gmv_total_value", money=True).alias("avg_ticket_value"),
    ).orderBy(F.desc("product_revenue_value"), "analysis_group")


# ---------------------------------------------------------------- 2: punctuality

_WORST_FIRST = (F.asc, "on_time_delivery_rate_pct"), (F.desc, "delivered_order_count"), (F.asc, "analysis_group")


def _worst_first(df: DataFrame) -> DataFrame:
    return df.orderBy(*[direction(name) for direction, name in _WORST_FIRST])


def q2_seller(logistics: DataFrame, size: int = WORST_SELLERS) -> DataFrame:
    report = logistics.filter(F.col("delivered_order_count") >= MIN_ORDERS).select(
        F.col("seller_id").alias("analysis_group"),
        _level("seller"),
        "delivered_order_count",
        F.round(100.0 - F.col("late_delivery_rate_pct"), 2).alias("on_time_delivery_rate_pct"),
        "avg_delay_days",
        "avg_delivery_days",
        "avg_review_score",
    )
    return _worst_first(report).limit(size)


def q2_category(items: DataFrame, products: DataFrame) -> DataFrame:
    delivered = with_category(items.filter("order_status = 'delivered'"), products)
    metrics = delivered.groupBy(F.col("category").alias("analysis_group")).agg(
        F.countDistinct("order_id").alias("delivered_order_count"),
        _on_time_pct(),
        mean2("seller_customer_distance_km").alias("avg_distance_km"),
        mean2("review_score_avg").alias("avg_review_score"),
    )
    enough = metrics.filter(F.col("delivered_order_count") >= MIN_ORDERS)
    return _worst_first(
        enough.select(
            "analysis_group",
            _level("category"),
            "delivered_order_count",
            "on_time_delivery_rate_pct",
            "avg_distance_km",
            "avg_review_score",
        )
    )


def q2_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    means = {
        "delivery_delay_days": "avg_delay_days",
        "actual_delivery_days": "avg_delivery_days",
        "review_score_avg": "avg_review_score",
    }
    on_time = F.col("is_delivery_on_time")
    measures = {"delivered_order_count": F.count("order_id"), "hits": F.count_if(on_time), "judged": F.count(on_time)}
    for name in means:
        measures |= mean_parts(name)
    metrics = by_state(fact.filter("is_delivered"), customers, measures)
    enough = metrics.filter(F.col("delivered_order_count") >= MIN_ORDERS)
    return _worst_first(
        enough.select(
            "analysis_group",
            _level("customer_state"),
            "delivered_order_count",
            percent_of(F.col("hits"), F.col("judged")).alias("on_time_delivery_rate_pct"),
            *[mean_of_parts(name).alias(alias) for name, alias in means.items()],
        )
    )


# ---------------------------------------------------------------- 3 and 4: lateness, distance


def q3_late_vs_review(fact: DataFrame) -> DataFrame:
    """Late against on-time orders, among delivered orders with a review."""
    judged = fact.filter("is_delivered AND review_score_avg IS NOT NULL AND is_delivery_late IS NOT NULL")
    status = (
        F.when(F.col("is_delivery_late"), "late").when(F.col("is_delivery_on_time"), "on_time").otherwise("not_evaluated")
    )
    return (
        judged.groupBy(status.alias("delivery_status"))
        .agg(
            F.count("order_id").alias("delivered_order_count"),
            mean2("actual_delivery_days").alias("avg_delivery_days"),
            mean2("delivery_delay_days").alias("avg_delay_days"),
            mean2("review_score_avg").alias("avg_review_score"),
            _low_review_pct(),
        )
        .orderBy("delivery_status")
    )


def q4_distance(fact: DataFrame) -> DataFrame:
    """Delivered orders of a single seller by distance, nearest band first."""
    single = fact.filter("is_delivered AND seller_count = 1").filter(F.col("distance_band") != NOT_AVAILABLE)
    return (
        single.groupBy("distance_band")
        .agg(
            F.count("order_id").alias("delivered_order_count"),
            mean2("seller_customer_distance_km").alias("avg_distance_km"),
            mean2_money("freight_total_value").alias("avg_freight_value"),
            mean2("actual_delivery_days").alias("avg_delivery_days"),
            mean2("delivery_delay_days").alias("avg_delay_days"),
            _late_pct(),
            mean2("review_score_avg").alias("avg_review_score"),
        )
        .orderBy(position_in(DISTANCE_ORDER, "distance_band"))
    )


# ---------------------------------------------------------------- 5: priorities


def benchmarks(metrics: DataFrame) -> DataFrame:
    """One row: revenue percentile and plain means over the groups."""
    return metrics.agg(
        F.percentile_approx("gmv_total_value", HIGH_REVENUE).alias("p75_gmv"),
        F.avg("late_delivery_rate_pct").alias("overall_late_rate"),
        F.avg("avg_review_score").alias("overall_review_score"),
    )


def above_benchmarks(metrics: DataFrame) -> DataFrame:
    """Groups with high revenue, more lateness and lower scores than the benchmark.

    The metrics are read twice, so they are computed once and kept; the benchmark is one row.
    """
    kept = materialize(metrics)
    compared = kept.crossJoin(F.broadcast(benchmarks(kept)))
    return compared.filter(
        "gmv_total_value >= p75_gmv"
        " AND late_delivery_rate_pct > overall_late_rate"
        " AND avg_review_score < overall_review_score"
    ).select(*metrics.columns)


def _by_urgency(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.desc("gmv_total_value"), F.desc("late_delivery_rate_pct"), F.asc("avg_review_score"), key)


def q5_seller_priority(logistics: DataFrame, size: int = PRIORITY_SELLERS) -> DataFrame:
    metrics = logistics.filter(F.col("delivered_order_count") >= MIN_ORDERS).select(
        "seller_id",
        "delivered_order_count",
        "gmv_total_value",
        "late_delivery_rate_pct",
        "avg_delivery_days",
        "avg_delay_days",
        "avg_review_score",
        "low_review_rate_pct",
    )
    return _by_urgency(above_benchmarks(metrics), "seller_id").limit(size)


def category_metrics(items: DataFrame, products: DataFrame) -> DataFrame:
    """Volume, revenue and unrounded rates per category with enough orders."""

    def share(condition: Column) -> Column:
        return 100.0 * F.try_divide(F.count_if(condition), F.count(condition))

    grouped = with_category(items, products).groupBy(F.col("category").alias("product_category_name"))
    metrics = grouped.agg(
        F.countDistinct("order_id").alias("order_count"),
        F.sum("item_gmv").alias("gmv_total_value"),
        share(F.col("is_delivery_late")).alias("late_delivery_rate_pct"),
        F.avg(F.col("review_score_avg").cast("decimal(18,2)")).cast("double").alias("avg_review_score"),
        share(F.col("review_score_avg") <= 2).alias("low_review_rate_pct"),
    )
    return metrics.filter(F.col("order_count") >= MIN_ORDERS)


def q5_category_priority(items: DataFrame, products: DataFrame) -> DataFrame:
    chosen = _by_urgency(above_benchmarks(category_metrics(items, products)), "product_category_name")
    return chosen.select(
        "product_category_name",
        "order_count",
        "gmv_total_value",
        *[
            F.round(name, 2).alias(name)
            for name in ("late_delivery_rate_pct", "avg_review_score", "low_review_rate_pct")
        ],
    )


# ---------------------------------------------------------------- 6 to 10: cohorts, freight, growth, payments


def _month(date_key: str) -> Column:
    """First day of the month of a yyyymmdd key."""
    return F.trunc(F.to_date(F.col(date_key).cast("string"), "yyyyMMdd"), "month")


def q6_cohorts(fact: DataFrame) -> DataFrame:
    """Persons of each first-order month that order again, by months since then.

    The first month is a grouping by person, and a person's months are made distinct before they
    are counted, so a frequent buyer is one row per month.
    """
    months = fact.filter("customer_unique_id IS NOT NULL AND purchase_date_key IS NOT NULL").select(
        "customer_unique_id", _month("purchase_date_key").alias("month")
    )
    active = months.distinct()
    first = active.groupBy("customer_unique_id").agg(F.min("month").alias("cohort_month"))
    later = active.join(first, "customer_unique_id")
    offset = F.months_between("month", "cohort_month").cast("int").alias("months_since")
    counted = later.groupBy("cohort_month", offset).agg(F.count("*").alias("customer_count"))
    size = first.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    return counted.join(size, "cohort_month").select(
        "cohort_month",
        "months_since",
        "customer_count",
        "cohort_size",
        percent_of(F.col("customer_count"), F.col("cohort_size")).alias("retention_pct"),
    ).orderBy("cohort_month", "months_since")


DECILES = 10


def q7_freight_vs_review(service: DataFrame) -> DataFrame:
    """Low reviews by decile of the freight's share of the price, and the correlation over all orders.

    Deciles come from a global rank by (ratio, order), which is computed over range partitions, so
    no task sorts all rows.
    """
    judged = service.filter("avg_freight_to_price_ratio IS NOT NULL AND review_score_avg IS NOT NULL").select(
        "order_id", "avg_freight_to_price_ratio", "review_score_avg"
    )
    ranked = global_row_number(judged, [F.col("avg_freight_to_price_ratio"), F.col("order_id")], "place")
    total = judged.agg(
        F.count("*").alias("n"),
        F.round(F.corr(F.col("avg_freight_to_price_ratio").cast("double"), "review_score_avg"), 4).alias("freight_review_correlation"),
    )
    decile = F.floor((F.col("place") - 1) * DECILES / F.col("n")).cast("int") + 1
    binned = ranked.crossJoin(F.broadcast(total)).withColumn("freight_decile", decile)  # one row
    return binned.groupBy("freight_decile", "freight_review_correlation").agg(
        F.count("*").alias("order_count"),
        F.min("avg_freight_to_price_ratio").alias("least_ratio"),
        F.max("avg_freight_to_price_ratio").alias("largest_ratio"),
        mean2("review_score_avg").alias("avg_review_score"),
        _low_review_pct(),
    ).orderBy("freight_decile")


def q8_growth_and_delay(fact: DataFrame) -> DataFrame:
    """Month over month, per distance band: months with more orders and longer delays than the one before.

    Each band has every month from its first to its last one, those without orders too, so "the
    month before" is the calendar's.
    """
    dated = fact.filter("purchase_date_key IS NOT NULL").withColumn("month", _month("purchase_date_key"))
    metrics = dated.groupBy("distance_band", "month").agg(
        F.count("order_id").alias("order_count"), mean2("delivery_delay_days").alias("avg_delay_days")
    )
    metrics = materialize(metrics)  # a row per band and month
    spans = metrics.groupBy("distance_band").agg(F.min("month").alias("first"), F.max("month").alias("last"))
    calendar = spans.select("distance_band", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    filled = calendar.join(metrics, ["distance_band", "month"], "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)))
    before = Window.partitionBy("distance_band").orderBy("month")
    compared = filled.withColumns(
        {
            "previous_order_count": F.lag("order_count").over(before),
            "previous_avg_delay_days": F.lag("avg_delay_days").over(before),
        }
    )
    worse = (F.col("order_count") > F.col("previous_order_count")) & (F.col("avg_delay_days") > F.col("previous_avg_delay_days"))
    return compared.withColumn("grows_with_worse_delay", F.coalesce(worse, F.lit(False))).orderBy("distance_band", "month")


# Upper edges of the instalment bands.
INSTALMENT_BANDS = ((1, "1"), (3, "2_to_3"), (6, "4_to_6"))
INSTALMENT_TOP = "7_or_more"


def q9_payment_mix(service: DataFrame) -> DataFrame:
    """Orders by type of payment and instalment band.

    An order paid in several ways counts once under each of its types; ``order_share`` splits it
    evenly among them, so the shares add up to the number of orders.
    """
    paid = service.filter("payment_types IS NOT NULL AND payment_types <> ''")
    types = F.array_distinct(F.split("payment_types", r"\|"))
    band = F
    for edge, label in INSTALMENT_BANDS:
        band = band.when(F.col("max_payment_installments") <= edge, label)
    kinds = paid.select(
        "order_id",
        "payment_total_value",
        "review_score_avg",
        F.when(F.col("max_payment_installments").isNull(), NOT_AVAILABLE).otherwise(band.otherwise(INSTALMENT_TOP)).alias("instalment_band"),
        F.size(types).alias("n_types"),
        F.explode(types).alias("payment_type"),
    )
    return kinds.groupBy("payment_type", "instalment_band").agg(
        F.count("*").alias("order_count"),
        F.count_if(F.col("n_types") > 1).alias("mixed_order_count"),
        F.round(F.sum((F.lit(1).cast("decimal(20,10)") / F.col("n_types").cast("decimal(5,0)")).cast("decimal(20,6)")), 4)
        .cast("double").alias("order_share"),
        mean2_money("payment_total_value").alias("avg_payment_value"),
        mean2("review_score_avg").alias("avg_review_score"),
    ).orderBy("payment_type", "instalment_band")
