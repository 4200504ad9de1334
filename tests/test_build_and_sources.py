"""Heavy keys, one-pass quarantine, gates, stores and malformed records."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazarlake import lake as lakes
from bazarlake.lake import LAYERS, WrittenLake, build, require_declared, require_tables
from bazarlake.operators.distinct import distinct_counts
from bazarlake.operators.heavy_join import heavy_keys, split_join
from bazarlake.plans import analyses, silver
from bazarlake.sources import files
from bazarlake.sources.adapter import text_feed
from bazarlake.sources.feeds import FEEDS
from bazarlake.sources.store import CatalogStore, FolderStore
from compare import spark_rows

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """Three quarters of the rows under one key, a tenth under NULL."""
    n = F.col("id")
    key = F.when(n % 20 < 15, F.lit(7)).when(n % 20 < 17, F.lit(None)).otherwise(n % 500)
    left = spark.range(40_000).select(n.alias("id"), key.cast("int").alias("k"), (n % 9).alias("v"))
    right = spark.range(500).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("name"), "id").alias("name"))
    return left, right.unionAll(right.filter("k = 7"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_the_plain_one(hot, how):
    left, right = hot
    got = split_join(left, right, ["k"], how, spread=["id"], share=0.02)
    assert got.columns == ["k", "id", "v", "name"]
    assert spark_rows(got) == spark_rows(left.join(right, ["k"], how))
    assert split_join(left.limit(0), right, ["k"], how).count() == 0


def test_heavy_keys_are_few_and_cut_below_the_share(spark, hot):
    left, right = hot
    heavy = {r.k: r["__parts"] for r in heavy_keys(left, ["k"], 0.02).collect()}
    assert heavy == {7: 38, None: 5}
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in zip(names, ("200", "false", "-1"), strict=True):
            spark.conf.set(name, value)

        def largest(df):
            # The names are read, or the join would be left out.
                return df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("name").alias("name")).agg(F.max("n"), F.max("name")).first()[0]

        once = right.dropDuplicates(["k"])
        assert largest(left.join(once, "k", "left")) > 0.7 * 40_000
        # A task gets a part of at most 2 %, or a few such parts whose hashes fall together.
        assert largest(split_join(left, once, ["k"], spread=["id"], share=0.02)) <= 4 * 0.02 * 40_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_category_join_is_split(spark):
    items = spark.createDataFrame([("p1", "o1"), ("p2", "o2"), (None, "o3")], "product_id string, order_id string")
    products = spark.createDataFrame([("p1", "toys"), ("p2", "")], "product_id string, product_category_name string")
    rows = {(r.order_id, r.category) for r in analyses.with_category(items, products).collect()}
    assert rows == {("o1", "toys"), ("o2", ""), ("o3", "not_available")}
    assert "__part" in plan_of(analyses.with_category(items, products))


def test_distinct_counts_without_expand(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, None, "y"), (None, "b", None), (2, None, None), (2, "c", "x")]
    df = spark.createDataFrame(rows, "k int, p string, s string")
    got = distinct_counts(df, ["k"], {"p": "np", "s": "ns"})
    plain = df.groupBy("k").agg(F.countDistinct("p").alias("np"), F.countDistinct("s").alias("ns"))
    assert spark_rows(got) == spark_rows(plain)
    assert "Expand" not in plan_of(got) and "Expand" in plan_of(plain)
    assert distinct_counts(df, [], {"p": "np", "s": "ns"}).collect() == [(3, 2)]
    assert distinct_counts(df.limit(0), [], {"p": "np", "s": "ns"}).collect() == [(0, 0)]


def test_items_of_an_order_are_grouped_once(spark):
    lake = lakes.Lake(lambda name: text_feed(spark, SMALL, name))
    facts = plan_of(silver.order_items_facts(lake.silver_order_items))
    assert "Expand" not in facts and facts.count("FileScan") == 1
    assert "Expand" not in plan_of(analyses.kpi_overview(lake.fact_order_service))

    def scans(df):
        return plan_of(df).count("FileScan")

    # The whole table scans what its inputs scan, items once.
    parts = (lake.silver_orders, lake.silver_order_items, lake.silver_payments_order_agg, lake.silver_reviews_order_agg, lake.silver_customers)
    origin = silver.seller_origin(lake.silver_sellers, lake.silver_geolocation_zip_agg)
    assert scans(lake.silver_order_service) == sum(map(scans, parts)) + scans(origin) + scans(lake.silver_geolocation_zip_agg)


# ---------------------------------------------------------------- build


def feed_with(spark, changed=None, rows=None):
    def feed(name):
        df = text_feed(spark, SMALL, name)
        return rows(df) if name == changed else df

    return feed


def small_feed(spark, changed=None, rows=None):
    """A few orders with all that belongs to them."""
    base = feed_with(spark)
    orders = {f"{k}" for k in range(0, 400)}

    def feed(name):
        df = base(name)
        if "order_id" in df.columns:
            df = df.filter(F.trim("order_id").isin(*orders))
        return rows(df) if name == changed else df

    return feed


def read_rows(spark, since):
    """Input records of all stages with an id above ``since``, and the last id."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    found = [(s.stageId(), s.inputRecords()) for s in (stages.apply(i) for i in range(stages.size()))]
    return sum(n for i, n in found if i > since), max(i for i, _ in found)


def test_typed_rows_are_read_once_for_both_sides(spark, tmp_path):
    feed = feed_with(spark)
    store = FolderStore(str(tmp_path))
    from bazarlake.plans import bronze

    for name in ("orders", "order_items"):
        store.write(bronze.stamped(feed(name), FEEDS[name], "run", datetime(2024, 1, 1)), "bronze", FEEDS[name].table)
    lake = WrittenLake(spark, store)
    typed = lakes.Lake(lambda name: store.read(spark, "bronze", FEEDS[name].table))
    for entity, table in (("orders", "bronze_orders"), ("order_items", "bronze_order_items")):
        total = lake.table(table).count()
        _, since = read_rows(spark, -1)
        lake.judge(entity)
        assert read_rows(spark, since)[0] == total
        for side in (f"silver_{entity}", f"silver_quarantine_{entity}"):
            scans = plan_of(getattr(lake, side))
            assert all(f"/judged_{entity}/verdict=" in name for name in getattr(lake, side).inputFiles())
            assert "PartitionFilters: [isnotnull(verdict" in scans
            assert spark_rows(getattr(lake, side)) == spark_rows(getattr(typed, side))
    assert lake.silver_quarantine_orders.count() > 0


@pytest.mark.parametrize("source", ["orders", "sellers", "order_reviews"])
def test_an_empty_source_stops_the_first_layer(spark, tmp_path, source):
    with pytest.raises(ValueError, match=f"bronze: 1 missing or empty tables: bronze_{source}"):
        build(spark, feed_with(spark, source, lambda df: df.limit(0)), str(tmp_path), "run")
    assert not (tmp_path / "silver_customers").exists()


def test_rows_that_all_fail_stop_the_second_layer(spark, tmp_path):
    blank = feed_with(spark, "customers", lambda df: df.withColumn("customer_id", F.lit(" ")))
    with pytest.raises(ValueError, match="silver: 1 missing or empty tables: silver_customers"):
        build(spark, blank, str(tmp_path), "run")
    assert not (tmp_path / "dim_date").exists()


def test_third_layer_and_names_of_all_missing_tables():
    counts = dict.fromkeys(LAYERS["gold"], 5) | {"dim_seller": 0}
    del counts["dim_date"]
    with pytest.raises(ValueError, match="gold: 2 missing or empty tables: dim_date, dim_seller"):
        require_tables("gold", LAYERS["gold"], counts)
    require_tables("silver", LAYERS["silver"], dict.fromkeys(LAYERS["silver"], 1) | {"silver_quarantine_orders": 0})
    with pytest.raises(ValueError, match="dim_seller.oddity"):
        require_declared([("gold", "dim_seller", ["seller_id", "oddity"])])


def test_build_into_the_catalog_equals_the_folders(spark, tmp_path):
    feed = small_feed(spark)
    store = CatalogStore(schemas={"bronze": "t_bronze", "silver": "t_silver", "gold": "t_gold"})
    try:
        by_name = build(spark, feed, store, "run", datetime(2024, 1, 1))
        in_folders = build(spark, feed, str(tmp_path), "run", datetime(2024, 1, 1))
        assert by_name.counts == in_folders.counts
        tables = {r.tableName for r in spark.sql("SHOW TABLES IN t_gold").collect()}
        assert tables == set(LAYERS["gold"])
        for name in ("silver_orders", "silver_quarantine_orders", "fact_order_service", "mart_service_risk"):
            assert spark_rows(by_name.table(name)) == spark_rows(in_folders.table(name))
            assert by_name.table(name).count() == by_name.counts[name]
        gates = [r for layer in LAYERS for r in by_name.gate(layer).collect()]
        assert len(gates) == 34 and all(r.status == "present" for r in gates)
    finally:
        for schema in store.schemas.values():
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


# ---------------------------------------------------------------- malformed records

LINES = [
    "seller_id,seller_zip_code_prefix,seller_city,seller_state",
    "1,01000,são paulo,SP",
    '2,02000,"santos, centro",SP',
    "3,03000,short",
    "4,04000,too,long,row",
    '5,"05000,never closed,SP',
    '6,06000,odd at the end,"SP',
    '7,07000,"line',
    'break",SP',
    '8,08000,"a \\"quoted\\" word",SP',
    "",
    ",,,",
    '9,09000,in"ner,SP',
]


@pytest.mark.parametrize("multiline", [False, True])
def test_malformed_records_are_kept_with_a_reason(spark, tmp_path, multiline):
    path = tmp_path / "sellers.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    rows = files.read_csv_checked(spark, str(path), FEEDS["sellers"], multiline).collect()
    good = {r.seller_id for r in rows if r.reject_reason is None}
    bad = {(r.source_text.split(",")[0], r.reject_reason) for r in rows if r.reject_reason is not None}
    if multiline:  # a quote that never closes takes what follows with it, and says so
        assert {"1", "2", None} <= good and ("3", "too few fields") in bad and ("4", "too many fields") in bad
        assert any(i == "5" and why for i, why in bad)
    else:
        assert len(rows) == 11  # every line but the header and the empty one
        assert good == {"1", "2", "8", "9", None}
        assert bad == {
            ("3", "too few fields"), ("4", "too many fields"), ("5", "unbalanced quotes"), ("6", "unbalanced quotes"),
            ("7", "unbalanced quotes"), ('break"', "too few fields"),
        }
        assert {r.seller_city for r in rows if r.seller_id == "2"} == {"santos, centro"}


def test_whole_multiline_records_are_accepted(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("\n".join([*LINES[:3], *LINES[7:9]]) + "\n", encoding="utf-8")
    rows = files.read_csv_checked(spark, str(path), FEEDS["sellers"], multiline=True).collect()
    assert {(r.seller_id, r.seller_city) for r in rows} == {("1", "são paulo"), ("2", "santos, centro"), ("7", "line\nbreak")}
    assert all(r.reject_reason is None for r in rows)


# ---------------------------------------------------------------- counters and sketches


def test_counters_against_plain_counts(spark):
    from bazarlake.operators.counters import row_counters, rule_counts, values_of

    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "b", None), (2, None, -7)], "k int, s string, v int")
    counters = row_counters(df, {"negative": F.col("v") < 0, "never": F.lit(False), "unknown": F.lit(None).cast("boolean")}, [("k",), ("k", "s")])
    assert rule_counts(counters, ["negative", "never", "unknown"]).collect() == [(4, 2, 0, 0)]
    assert {(r.k, r.n) for r in values_of(counters, ["k"], "k").collect()} == {("1", 2), (None, 1), ("2", 1)}
    assert values_of(counters, ["k", "s"]).count() == 4
    assert rule_counts(row_counters(df.limit(0), {"negative": F.col("v") < 0}, [("k",)]), ["negative"]).collect() == [(0, 0)]


def test_suite_reads_the_fact_once(spark, tmp_path):
    from bazarlake.plans import quality

    lake = build(spark, small_feed(spark), str(tmp_path), "run", datetime(2024, 1, 1))
    seen = []
    original = quality.row_counters
    quality.row_counters = lambda df, *a: seen.append(df) or original(df, *a)
    try:
        checks = quality.checks_in_one_scan(lake.tables())
    finally:
        quality.row_counters = original
    fact = lake.table("fact_order_service")
    assert sum(sorted(df.inputFiles()) == sorted(fact.inputFiles()) for df in seen) == 1
    for name, check in checks.items():  # nothing else touches its files
        assert not any("/fact_order_service/" in f for f in check.inputFiles()), name
    tables = {name: df for _, name, df in lake.tables()}
    plain = {
        "completeness": quality.completeness(fact), "validity": quality.validity(fact), "uniqueness": quality.uniqueness(tables),
        "integrity": quality.referential_integrity(tables), "traceability": quality.traceability(lake.tables()),
    }
    for name, check in plain.items():
        assert checks[name].columns == check.columns and spark_rows(checks[name]) == spark_rows(check)


def test_sketches_of_months_merge(spark):
    from bazarlake.plans import quality

    n = F.col("id")
    wide = spark.range(60_000).select(
        F.lit("delivered").alias("order_status"),
        (F.lit(20240001) + 100 * (n % 12 + 1)).alias("purchase_date_key"),
        *[F.pmod(F.xxhash64("id", F.lit(i)), 10_000 * (i + 1)).cast("double").alias(m) for i, m in enumerate(quality.OUTLIER_METRICS)],
    )
    sketches = quality.monthly_sketches(wide)
    assert sketches.count() == 12
    found = quality.rank_errors(wide, quality.sketched_percentiles(sketches).persist()).collect()
    assert len(found) == 25 and all(r.row_count == 60_000 and r.rank_error <= quality.RANK_ERROR for r in found)
    # Far from it if the value is another percentile's.
    wrong = quality.sketched_percentiles(sketches).withColumn("value", F.col("value") * 0.5).persist()
    assert max(r.rank_error for r in quality.rank_errors(wide, wrong).collect()) > 0.2
    assert quality.sketched_percentiles(quality.monthly_sketches(wide.limit(0))).count() == 0


# ---------------------------------------------------------------- dictionary


def test_domains_follow_the_rows(spark):
    from bazarlake.plans import dictionary, glossary

    columns = [c for t, c in glossary.DOMAINS if t == "silver_orders"]
    assert columns == ["order_status"]
    orders = spark.createDataFrame([("delivered",), ("delivered",), ("lost",), (None,)], "order_status string")
    rows = {(r.value, r.row_count, r.status) for r in dictionary.observed_domains([("silver", "silver_orders", orders)]).collect() if r.table_name == "silver_orders"}
    assert {("delivered", 2, "DECLARED"), ("lost", 1, "UNDECLARED"), ("created", 0, "NOT_OBSERVED")} <= rows
    assert len(rows) == len(glossary.DOMAINS["silver_orders", "order_status"]) + 1


def test_empty_columns_need_attention(spark):
    from bazarlake.operators.profiling import column_profile
    from bazarlake.plans import dictionary

    df = spark.createDataFrame([("s1", None, "x"), ("s2", None, None)], "seller_id string, seller_city string, oddity string")
    inventory = dictionary.column_inventory(column_profile(df, "silver", "silver_sellers"), dictionary.column_dictionary(spark), dictionary.common_dictionary(spark))
    assert {(r.column_name, r.reason) for r in dictionary.undocumented(inventory).collect()} == {("seller_city", "always empty"), ("oddity", "undocumented")}
    with pytest.raises(ValueError, match="1 undocumented: silver_sellers.oddity"):
        dictionary.require_documented(inventory)
    row = dictionary.coverage(inventory).first()
    assert (row.total_columns, row.documented_columns, row.always_empty_columns) == (3, 2, 1)


def test_cardinalities_by_sketch(spark):
    from bazarlake.plans import dictionary

    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 50).alias("a.b"))
    rows = {r.column_name: r for r in dictionary.cardinalities([("gold", "t", df)]).collect()}
    assert rows["k"].row_count == 20_000 and abs(rows["k"].estimate - 20_000) <= dictionary.CARDINALITY_ERROR * 20_000
    assert rows["a.b"].estimate == 50
    halves = [dictionary.cardinalities([("gold", "t", df.filter(c))]) for c in ("id < 12000", "id >= 8000")]
    merged = halves[0].unionAll(halves[1]).groupBy("column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))
    assert abs({r.column_name: r.n for r in merged.collect()}["k"] - 20_000) <= 1000
