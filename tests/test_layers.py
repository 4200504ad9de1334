"""Silver, gold, quality and dictionary on hand-made feeds, and invariants on the supplied tables."""

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bazarlake.lake import LAYERS, Lake, build
from bazarlake.plans import analyses, bronze, dictionary, gold, quality, silver
from bazarlake.sources.adapter import text_feed
from bazarlake.sources.feeds import FEEDS

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="supplied tables not present")

D = "2018-01-{:02d} 00:00:00"


def order(order_id, status="delivered", bought=D.format(1), got=D.format(5), due=D.format(9), customer="c1"):
    return (order_id, customer, status, bought, None, None, got, due)


def item(order_id, number="1", product="p1", seller="s1", price="10.00", freight="2.00"):
    return (order_id, number, product, seller, D.format(3), price, freight)


FEED_ROWS = {
    "orders": [
        order("o1"),
        order("o1"),
        order("o2", status=" DELIVERED ", got=D.format(12)),
        order("o3", status="lost"),
        order(None),
        order("", customer="", bought="not-a-date", status="lost"),
        order("o4", status="shipped", got=None, customer="c2"),
        order("o5", bought="2018-13-45", customer=None),
    ],
    "order_items": [
        item("o1"),
        item("o1", number="2", seller="s2", price="0"),
        item("o1", number="2", seller="s3", price="5.00"),
        item("o2", price="x"),
        item("o2", freight="-0.01", number="2"),
        item(" ", number="y", product="", seller=None, price="-1", freight=None),
        item("o2", number="3", price="12.345", freight="1"),
    ],
    "customers": [("c1", "u1", "1234.0", "são  paulo", " sp "), ("c2", "u1", "99999", "rio", "rj"), ("", "u", "1", "a", "b")],
    "order_payments": [
        ("o1", "1", "Boleto", "1", "10.00"),
        ("o1", "2", " voucher", "3", "2.50"),
        ("o1", "2", "zcard", "3", "2.50"),
        ("o2", "1", "boleto", "1", "-5"),
        ("o2", "2", "boleto", "x", "bad"),
    ],
    "order_reviews": [
        ("r1", "o1", "5", None, None, D.format(10), D.format(11)),
        ("r1", "o2", "1", None, None, D.format(10), D.format(12)),
        ("r2", "o1", "2", None, None, D.format(11), None),
        ("r3", "o1", "6", None, None, D.format(10), D.format(11)),
        ("r4", "o1", "x", None, None, D.format(10), D.format(11)),
        ("r5", "o1", "3", None, None, "10/01/2018", D.format(11)),
    ],
    "products": [("p1", " Casa  e Banho", "10", "n/a", "1", "100.5", "1", "2", "3"), ("p2", None, "5", "5", "1", "1", "1", "1", "1")],
    "sellers": [("s1", "1234", "rio", "rj"), ("s2", "5", "rio", "rj"), ("s3", "5", "rio", "rj"), ("s4", "5", "rio", "rj")],
    "category_translation": [("Casa e banho", "Home"), ("", "none")],
    "geolocation": [
        ("1234", "-23.5", "-46.5", "Sao Paulo", "sp"),
        ("1234", "-23.7", "-46.7", "Osasco", "sp"),
        ("1234", "50", "-46", "Far", "xx"),
        (None, "-23", "-46", "None", "sp"),
        ("5", "bad", "-46", "None", "sp"),
    ],
}


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(lambda name: spark.createDataFrame(FEED_ROWS[name], FEEDS[name].schema))


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_order_quarantine_reasons_in_order(lake):
    got = sorted((str(r.order_id), r.quarantine_reason) for r in lake.silver_quarantine_orders.collect())
    missing_date = "data de compra inválida ou ausente"
    assert got == [
        ("", f"order_id ausente; customer_id ausente; {missing_date}; status de pedido inválido"),
        ("None", "order_id ausente"),
        ("o3", "status de pedido inválido"),
        ("o5", f"customer_id ausente; {missing_date}"),
    ]
    assert sorted(r.order_id for r in lake.silver_orders.collect()) == ["o1", "o2", "o4"]


def test_item_quarantine_and_dedupe(lake):
    got = sorted((r.order_id, str(r.order_item_id), r.quarantine_reason) for r in lake.silver_quarantine_order_items.collect())
    assert got == [
        ("", "None", "order_id ausente; order_item_id inválido; product_id ausente; seller_id ausente; preço inválido; frete inválido"),
        ("o2", "1", "preço inválido"),
        ("o2", "2", "frete inválido"),
    ]
    kept = {(r.order_id, r.order_item_id): (r.seller_id, r.price) for r in lake.silver_order_items.collect()}
    assert kept == {
        ("o1", 1): ("s1", Decimal("10.00")),
        ("o1", 2): ("s2", Decimal("0.00")),
        ("o2", 3): ("s1", Decimal("12.35")),
    }


def test_aggregates(lake):
    paid = by_key(lake.silver_payments_order_agg, "order_id")
    assert set(paid) == {"o1"}
    assert (paid["o1"].payment_total_value, paid["o1"].payment_types) == (Decimal("12.50"), "boleto|voucher")
    reviews = by_key(lake.silver_reviews_order_agg, "order_id")
    assert (reviews["o1"].review_score_avg, reviews["o1"].review_count) == (2.5, 2)  # r2 and r5
    assert reviews["o2"].review_score_avg == 1.0  # the later answer of the shared review id
    zips = by_key(lake.silver_geolocation_zip_agg, "zip_code_prefix")
    assert set(zips) == {"01234"}
    point = zips["01234"]
    assert (point.latitude, point.longitude, point.geolocation_city, point.geolocation_record_count) == (-23.6, -46.6, "Osasco", 2)


def test_order_service(lake):
    rows = by_key(lake.silver_order_service, "order_id")
    o1, o2, o4 = rows["o1"], rows["o2"], rows["o4"]
    assert (o1.gmv_total_value, o1.seller_count, o1.primary_seller_id) == (Decimal("14.00"), 2, "s1")
    assert o1.avg_freight_to_price_ratio == Decimal("0.2000")  # the item of price zero is left out
    assert (o1.seller_customer_distance_km, o1.distance_band, o1.review_band) == (0.0, "under_100_km", "high_4_5")
    assert (o2.is_delivery_late, o2.delivery_delay_days, o2.delivery_performance_band) == (True, 3.0, "late")
    assert (o4.gmv_total_value, o4.is_delivery_late, o4.distance_band) == (None, None, "not_available")


def test_gold(lake):
    people = by_key(lake.dim_customer, "customer_unique_id")
    assert people["u1"].lifetime_order_count == 3 and people["u1"].customer_state == "RJ"
    assert people["u1"].customer_value_band == "under_100" and people["u1"].is_repeat_customer
    products = by_key(lake.dim_product, "product_id")
    assert products["p1"].product_category_name_english == "home"
    assert (products["p2"].product_category_name, products["p2"].product_category_name_english) == ("", "not_available")
    assert products["p1"].product_description_length is None
    sellers = by_key(lake.dim_seller, "seller_id")
    assert (sellers["s4"].lifetime_order_count, sellers["s4"].lifetime_freight_value) == (0, Decimal("0.00"))
    roles = {(r.location_role, r.zip_code_prefix) for r in lake.dim_location.collect()}
    assert roles == {("customer", "01234"), ("customer", "99999"), ("seller", "01234")}
    keys = {r.service_band_key for r in lake.dim_service_band.collect()}
    assert keys == {r.service_band_key for r in lake.fact_order_service.collect()}


def test_rates_count_missing_differently(lake):
    month = lake.mart_monthly_operations.first()
    assert (month.order_count, month.late_delivery_rate_pct) == (3, 33.33)
    kpi = analyses.kpi_overview(lake.fact_order_service).first()
    assert kpi.on_time_delivery_rate_pct == 50.0  # the order without delivery is left out


def test_manifest_gate(spark):
    found = spark.createDataFrame([("orders.csv", 3), ("other.csv", 1)], "source_file string, row_count bigint")
    gate = bronze.manifest_gate(bronze.expected_files(spark), found)
    status = {r.source_file: r.status for r in gate.collect()}
    assert status["orders.csv"] == "present" and status["other.csv"] == "extra" and status["sellers.csv"] == "missing"
    with pytest.raises(ValueError, match="customers.csv"):
        bronze.require_complete(gate)


# ---------------------------------------------------------------- quality


def fact_row(order_id="o", **values):
    base = dict(
        order_id=order_id,
        customer_unique_id="u",
        purchase_date_key=20180101,
        gmv_total_value=Decimal("1.00"),
        freight_total_value=Decimal("1.00"),
        order_status="delivered",
        delivery_date_key=20180105,
        review_score_avg=4.0,
        actual_delivery_days=4.0,
        seller_customer_distance_km=1.0,
        is_delivery_late=False,
        is_delivery_on_time=True,
    )
    return {**base, **values}


FACT = (
    "order_id string, customer_unique_id string, purchase_date_key int, gmv_total_value decimal(29,2),"
    " freight_total_value decimal(28,2), order_status string, delivery_date_key int, review_score_avg double,"
    " actual_delivery_days double, seller_customer_distance_km double, is_delivery_late boolean, is_delivery_on_time boolean"
)


def fact(spark, *rows):
    names = [part.split()[0] for part in FACT.split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], FACT)


def test_validity_and_completeness(spark):
    df = fact(
        spark,
        fact_row(),
        fact_row(" ", gmv_total_value=Decimal(-1), is_delivery_late=True),
        fact_row(None, order_status="lost", review_score_avg=6.0, is_delivery_late=None, is_delivery_on_time=None),
    )
    broken = quality.validity(df).first().asDict()
    assert broken == {
        "total_orders": 3,
        "invalid_order_status": 1,
        "negative_gmv": 1,
        "negative_freight": 0,
        "invalid_review_score": 1,
        "negative_delivery_days": 0,
        "negative_distance_km": 0,
        "inconsistent_delivery_flags": 1,
    }
    missing = by_key(quality.completeness(df), "column_name")
    assert (missing["order_id"].null_count, missing["order_id"].null_pct) == (2, 66.67)
    empty = quality.completeness(df.filter("false")).collect()
    assert {(r.null_count, r.null_pct) for r in empty} == {(0, None)}


def test_keys_summary_and_drilldown(spark):
    one = spark.createDataFrame([("a",), ("a",), (None,)], "order_id string")
    good = spark.createDataFrame([("a", 1)], "order_id string, order_item_id int")
    ids = spark.createDataFrame([("x", "x", "x")], "customer_unique_id string, product_id string, seller_id string")
    sales = spark.createDataFrame([("a", 1, "x", "gone")], "order_id string, order_item_id int, product_id string, seller_id string")
    orders = spark.createDataFrame([("a", "x", None)], "order_id string, customer_unique_id string, seller_id string")
    tables = {
        "silver_orders": one,
        "silver_order_items": good,
        "fact_order_service": orders,
        "fact_order_item_sales": sales,
        "dim_customer": ids,
        "dim_product": ids,
        "dim_seller": ids,
    }
    unique = quality.uniqueness(tables)
    line = by_key(unique, "table_name")["silver_orders"]
    assert (line.total_rows, line.distinct_key_rows, line.duplicate_rows, line.uniqueness_pct) == (3, 2, 1, 66.67)
    integrity = quality.referential_integrity(tables)
    assert [r.orphan_record_count for r in integrity.collect()] == [0, 1, 0, 0]
    traced = quality.traceability([("gold", "t", good), ("gold", "e", ids.filter("false"))])
    assert [(r.table_name, r.traceability_coverage_pct) for r in traced.collect()] == [("e", 100.0), ("t", 0.0)]
    clean = fact(spark, fact_row())
    checks = dict(
        completeness=quality.completeness(clean),
        validity=quality.validity(clean),
        uniqueness=unique,
        integrity=integrity,
        traceability=traced,
    )
    summary = quality.summary(**checks)
    assert sorted((r.issue_count, r.status) for r in summary.collect()) == [
        (0, "APROVADO"),
        (0, "APROVADO"),
        (1, "ATENCAO"),
        (1, "ATENCAO"),
        (2, "ATENCAO"),
    ]
    assert tuple(quality.failed_rules(summary).first()) == (3, "ATENCAO")
    sections = {r.section for r in quality.drilldown(summary, **checks).collect()}
    assert sections == {"summary", "uniqueness", "integrity", "traceability"}
    passing = summary.withColumn("status", F.lit("APROVADO"))
    assert quality.drilldown(passing, **checks).count() == 0


def test_percentile_sketch_stays_near_the_rank(spark):
    df = spark.range(20000).select(
        F.lit("delivered").alias("order_status"),
        *[(F.col("id") / 100).alias(m) for m in quality.OUTLIER_METRICS],
    )
    vector = quality.outlier_percentiles(df).first().gmv_percentiles
    for p, value in zip(quality.PERCENTILES, vector):
        assert abs(value * 100 - p * 20000) <= 20000 / quality.ACCURACY + 2


def test_dictionary(spark):
    profile = spark.createDataFrame(
        [
            ("silver", "silver_sellers", "seller_id", "string", "YES", 1, 4, 0),
            ("silver", "silver_sellers", "mystery", "int", "YES", 2, 4, 1),
            ("silver", "silver_sellers", "record_hash", "string", "YES", 3, 4, 0),
            ("gold", "dim_location", "latitude", "double", "YES", 1, 3, 1),
            ("gold", "dim_location", "longitude", "double", "YES", 2, 3, 1),
        ],
        "layer string, table_name string, column_name string, data_type string, nullable string,"
        " ordinal_position int, row_count bigint, null_count bigint",
    )
    words, common = dictionary.column_dictionary(spark), dictionary.common_dictionary(spark)
    inventory = dictionary.column_inventory(profile, words, common)
    assert [r.column_name for r in dictionary.undocumented(inventory).collect()] == ["mystery"]
    with pytest.raises(ValueError, match="silver_sellers.mystery"):
        dictionary.require_documented(inventory)
    rate = by_key(dictionary.coverage(inventory), "table_name")["silver_sellers"]
    assert (rate.total_columns, rate.documented_columns, rate.documentation_coverage_pct) == (3, 2, 66.67)
    states = {(r.table_name, r.column_name): r.status for r in dictionary.reconcile(profile, words, common).collect()}
    assert states["silver_sellers", "seller_id"] == "APPLIED"
    assert states["silver_sellers", "seller_city"] == "NOT_FOUND"
    assert states["silver_sellers", "record_hash"] == "APPLIED_COMMON"
    classes = dictionary.classified_profile(profile, words).collect()
    assert [tuple(r)[2:4] + (r.cell_count, r.null_cell_rate_pct) for r in classes] == [
        ("geospatial_coordinate", "restricted", 6, 33.3333)
    ]


# ---------------------------------------------------------------- supplied tables


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return build(spark, lambda name: text_feed(spark, SMALL, name), root, "run", datetime(2024, 1, 1))


@needs_data
def test_written_layers(written):
    assert len(written.tables()) == sum(len(names) for names in LAYERS.values()) == 34
    rows = {name: df.count() for _, name, df in written.tables()}
    dropped = written.orders_typed.count() - rows["silver_orders"] - rows["silver_quarantine_orders"]
    assert dropped == 3  # repeated orders 3, 503, 1003
    assert rows["silver_order_items"] == 4529 and rows["silver_quarantine_order_items"] == 114
    assert rows["silver_order_service"] == rows["fact_order_service"] == rows["silver_orders"] == 1448
    assert rows["mart_service_risk"] == rows["mart_logistics_performance"]
    assert quality.untraced(quality.traceability(written.tables())).count() == 0


@needs_data
def test_invariants(written):
    fact_orders, items = written.table("fact_order_service"), written.table("fact_order_item_sales")
    order_sum = fact_orders.agg(F.sum("gmv_total_value")).first()[0]
    assert order_sum == items.agg(F.sum("item_gmv")).first()[0]
    assert fact_orders.filter("is_delivery_late = is_delivery_on_time").count() == 0
    ranks = sorted(r.priority_rank for r in written.table("mart_service_risk").collect())
    assert ranks == list(range(1, len(ranks) + 1))


@needs_data
def test_written_and_lazy_tables_agree(spark, written):
    lazy = Lake(lambda name: text_feed(spark, SMALL, name))
    for name in ("fact_order_service", "mart_customer_experience", "dim_customer"):
        left = getattr(lazy, name)
        right = written.table(name).select(*left.columns)
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
