"""Column expressions on hand-made rows."""

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazarlake.functions import bands, delivery, lineage, rates, text, typed
from bazarlake.functions.geo import haversine_km


def values(df, name):
    return [row[name] for row in df.orderBy("n").select(name).collect()]


def numbered(spark, items, kind):
    return spark.createDataFrame(list(enumerate(items)), f"n int, x {kind}")


def test_normalize_text_and_city(spark):
    df = numbered(spark, [None, "", "  SÃO \t  Paulo ", "rio"], "string")
    assert values(df.select("n", text.normalize_text("x")), "x") == ["", "", "são paulo", "rio"]
    assert values(df.select("n", text.normalize_city("x")), "x") == ["", "", "São Paulo", "Rio"]


def test_zip5(spark):
    df = numbered(spark, ["1234", "1234.0", "123456", "", None, " 77 "], "string")
    assert values(df.select("n", text.zip5("x")), "x") == ["01234", "01234", "12345", "00000", None, "00077"]


def test_casts_give_null_on_bad_text(spark):
    df = numbered(spark, ["12", "12.5", "abc", None, ""], "string")
    assert values(df.select("n", typed.to_int("x")), "x") == [12, None, None, None, None]
    assert values(df.select("n", typed.to_double("x")), "x") == [12.0, 12.5, None, None, None]
    money = numbered(spark, ["12.345", "-1", "x"], "string").select("n", typed.to_money("x"))
    assert values(money, "x") == [Decimal("12.35"), Decimal("-1.00"), None]


def test_timestamps(spark):
    df = numbered(spark, ["2018-01-02 03:04:05", "2018-01-02", "not-a-date", None], "string")
    loose = values(df.select("n", typed.to_ts("x").cast("string").alias("x")), "x")
    strict = values(df.select("n", typed.to_ts_strict("x").cast("string").alias("x")), "x")
    assert loose == ["2018-01-02 03:04:05", "2018-01-02 00:00:00", None, None]
    assert strict == ["2018-01-02 03:04:05", None, None, None]


def test_record_hash_text(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "∅")], "n int, x string, y string")
    got = values(df.withColumn("h", lineage.record_hash(["x", "y"])), "h")
    expected = hashlib.sha256("a||∅".encode()).hexdigest()
    assert got == [expected, expected]  # NULL and the mark share a hash, so the hash is no key


def order_times(spark, delivered, estimated="2018-01-10 00:00:00"):
    row = ("2018-01-01 00:00:00", delivered, estimated, "delivered")
    names = ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in (*names, "order_status")))
    typed_df = df.select(*[typed.to_ts(n) for n in names], "order_status")
    return typed_df.select(
        delivery.actual_delivery_days().alias("days"),
        delivery.delivery_delay_days().alias("delay"),
        delivery.delivery_early_days().alias("delivery_early_days"),
        delivery.is_delivery_late().alias("is_delivery_late"),
        delivery.is_delivery_on_time().alias("on_time"),
    ).withColumn("band", bands.delivery_performance_band()).first()


@pytest.mark.parametrize(
    "delivered, expected",
    [
        ("2018-01-10 00:00:01", (9.0, 0.0, 0.0, True, False, "late")),  # one second late
        ("2018-01-10 00:00:00", (9.0, 0.0, 0.0, False, True, "on_time")),
        ("2018-01-07 00:15:00", (6.01, 0.0, 2.99, False, True, "on_time")),
        ("2018-01-07 00:00:00", (6.0, 0.0, 3.0, False, True, "early_3_days_or_more")),
        ("2018-01-12 12:00:00", (11.5, 2.5, 0.0, True, False, "late")),
        (None, (None, None, None, None, None, "not_evaluated")),
    ],
)
def test_delivery(spark, delivered, expected):
    assert tuple(order_times(spark, delivered)) == expected


def test_delivery_without_estimate(spark):
    assert tuple(order_times(spark, "2018-01-05 00:00:00", None)) == (4.0, None, None, None, None, "not_evaluated")


def test_haversine(spark):
    rows = [
        (0.0, 0.0, 0.0, 180.0),
        (10.0, 20.0, 10.0, 20.0),
        (None, 0.0, 1.0, 1.0),
        (-23.55, -46.63, -22.91, -43.17),
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r.km for r in df.select(haversine_km("a", "b", "c", "d").alias("km")).collect()]
    assert got[0] == 20015.09 and got[1] == 0.0 and got[2] is None and 355 < got[3] < 362


def test_distance_band_edges(spark):
    df = numbered(spark, [None, 99.99, 100.0, 499.99, 500.0, 1000.0, 1999.99, 2000.0], "double")
    assert values(df.withColumn("b", bands.distance_band("x")), "b") == [
        "not_available",
        "under_100_km",
        "100_to_499_km",
        "100_to_499_km",
        "500_to_999_km",
        "1000_to_1999_km",
        "1000_to_1999_km",
        "2000_km_or_more",
    ]


def test_review_and_value_bands(spark):
    df = numbered(spark, [None, 2.0, 2.5, 3.0, 3.5, 5.0], "double")
    assert values(df.withColumn("b", bands.review_band("x")), "b") == [
        "not_reviewed",
        "low_1_2",
        "high_4_5",
        "neutral_3",
        "high_4_5",
        "high_4_5",
    ]
    gmv = numbered(spark, [Decimal("99.99"), Decimal(100), Decimal(300), Decimal(600), None], "decimal(28,2)")
    assert values(gmv.withColumn("b", bands.customer_value_band("x")), "b") == [
        "under_100",
        "100_to_299",
        "300_to_599",
        "600_or_more",
        "600_or_more",
    ]


def test_risk_level(spark):
    rows = [(0, 20.0, 4.5), (1, 19.99, 3.49), (2, 10.0, 4.5), (3, 9.99, 3.99), (4, 9.99, 4.0), (5, 5.0, None), (6, 12.0, None)]
    df = spark.createDataFrame(rows, "n int, late double, score double")
    assert values(df.withColumn("b", bands.service_risk_level("late", "score")), "b") == [
        "high",
        "high",
        "medium",
        "medium",
        "low",
        "low",
        "medium",
    ]


def test_means_round_half_up_once(spark):
    df = spark.createDataFrame([(Decimal("1.00"), 1.0, True), (Decimal("1.01"), 1.01, None)], "m decimal(18,2), d double, f boolean")
    row = df.agg(
        rates.mean2_money("m").alias("m"),
        rates.mean2("d").alias("d"),
        rates.rate_pct(F.col("f")).alias("all"),
        rates.tristate_rate_pct(F.col("f")).alias("known"),
    ).first()
    assert tuple(row) == (Decimal("1.01"), 1.01, 50.0, 100.0)
    negative = spark.createDataFrame([(-1.0,), (-1.01,)], "d double").agg(rates.mean2("d").alias("d")).first()
    assert negative.d == -1.01
    empty = df.filter("m < 0").agg(rates.mean2("d").alias("d"), rates.rate_pct(F.col("f")).alias("r")).first()
    assert tuple(empty) == (None, None)
