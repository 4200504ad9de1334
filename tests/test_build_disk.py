"""What the build of all layers writes, shuffles and leaves on disk."""

import random
import re
from datetime import datetime

import pytest
from test_layers import FEED_ROWS, item, order
from test_operators import skewed_rows

from bazarlake import lake as lakes
from bazarlake.lake import LAYERS, Lake, WrittenLake, build
from bazarlake.operators import dedupe
from bazarlake.operators.dedupe import keep_one, keep_one_of_repeated, keep_one_packed
from bazarlake.operators.workdir import shuffles_removed
from bazarlake.plans import bronze, silver
from bazarlake.sources.feeds import FEEDS

SHA = "0123456789abcdef" * 4
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def rows_of(df):
    return sorted((str(sorted(r.asDict().items())) for r in df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


@pytest.fixture
def feeds():
    return {
        **FEED_ROWS,
        "orders": [*FEED_ROWS["orders"], *[order("again", customer=f"c{i}") for i in (2, 1, 2)]],
        "order_items": [*FEED_ROWS["order_items"], item("o1", price="9.00"), item("o1", price="3.00"), item("o1", price="3.00")],
    }


def feed_of(spark, feeds):
    return lambda name: spark.createDataFrame(feeds[name], FEEDS[name].schema)


@pytest.mark.parametrize("most", [dedupe.MOST_REPEATED, 0])
def test_the_same_rows_are_kept_when_only_repeated_keys_are_ranked(spark, monkeypatch, most):
    monkeypatch.setattr(dedupe, "MOST_REPEATED", most)  # with 0, all rows are ranked
    rows = [*skewed_rows(), (None, 3, "x"), (None, 2, None), ("own", None, None)]
    for seed, parts in ((1, 1), (2, 8)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, a int, b string").repartition(parts)
        assert rows_of(keep_one_of_repeated(df, ["k"])) == rows_of(keep_one(df, ["k"]))
        assert rows_of(keep_one_of_repeated(df, ["k", "a"], ["b"])) == rows_of(keep_one(df, ["k", "a"], ["b"]))
    assert keep_one_of_repeated(df, ["k"]).columns == df.columns


def test_rows_with_a_key_of_their_own_are_not_shuffled(spark):
    df = spark.range(300).selectExpr("cast(id as string) AS k", "sha2(cast(id AS string), 256) AS record_hash")
    once = keep_one_of_repeated(df, ["k"])
    assert "Window" not in plan_of(once) and once.count() == 300
    some = keep_one_of_repeated(df.unionAll(df.limit(2)), ["k"])
    assert some.count() == 300
    alone = some._jdf.queryExecution().executedPlan().toString().split("LeftAnti")[1]
    assert not re.search(r"Exchange hashpartitioning\(k#", alone.split("LeftSemi")[0])


def test_packed_hashes_keep_the_same_rows(spark):
    rows = [("a", 1, SHA), ("a", 1, SHA[::-1]), ("a", 1, None), ("b", 2, SHA[::-1]), ("b", 2, SHA), (None, 1, SHA)]
    df = spark.createDataFrame(rows, "k string, a int, record_hash string").repartition(3)
    packed = keep_one_packed(df, ["k"])
    assert packed.columns == df.columns and rows_of(packed) == rows_of(keep_one(df, ["k"]))
    assert packed.filter("k = 'b'").first().record_hash == SHA
    assert "unhex" in plan_of(packed)


def test_the_build_makes_no_second_copy_of_the_typed_rows(spark, tmp_path, feeds):
    lake = build(spark, feed_of(spark, feeds), str(tmp_path), "run", datetime(2024, 1, 1))
    assert {p.name for p in tmp_path.iterdir()} == {name for names in LAYERS.values() for name in names}
    lazy = Lake(feed_of(spark, feeds))
    for name in [*LAYERS["silver"], *LAYERS["gold"]]:
        plain = getattr(lazy, name)
        assert rows_of(lake.table(name).select(plain.columns)) == rows_of(plain), name
    for side in ("silver_orders", "silver_quarantine_orders", "silver_order_items", "silver_customers"):
        hashes = [r.record_hash for r in lake.table(side).collect()]
        assert all(re.fullmatch("[0-9a-f]{64}", h) for h in hashes)
    assert lake.table("silver_orders").count() == len({r.order_id for r in lake.table("silver_orders").collect()})


def test_the_build_leaves_no_shuffle_files(spark, tmp_path, feeds):
    spark.sparkContext._jvm.System.gc()
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    build(spark, feed_of(spark, feeds), str(tmp_path), "run", datetime(2024, 1, 1))
    assert shuffle_files(spark) <= before
    assert spark.conf.get(CLEANUP) == setting
    with pytest.raises(RuntimeError), shuffles_removed(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise RuntimeError
    assert spark.conf.get(CLEANUP) == setting


@pytest.mark.parametrize("most", [lakes.MOST_ITEMS, 3])
def test_items_move_to_their_orders_if_none_can_have_many(spark, tmp_path, monkeypatch, feeds, most):
    monkeypatch.setattr(lakes, "MOST_ITEMS", most)
    numbered = {**feeds, "order_items": [*feeds["order_items"], *[item("o1", number=str(n)) for n in range(2, 9)]]}
    lake = WrittenLake(spark, str(tmp_path))
    feed = feed_of(spark, numbered)
    lake._feed = lambda name: bronze.stamped(feed(name), FEEDS[name], "run", datetime(2024, 1, 1))
    items = lake._items_of_orders()
    assert ("Repartition" in plan_of(items)) == (most > 3)
    assert rows_of(lake.silver_order_service) == rows_of(Lake(lake._feed).silver_order_service)
    grouped = silver.order_items_facts(items)._jdf.queryExecution().executedPlan().toString()
    assert ("REPARTITION_BY_COL" in grouped) == (most > 3)


def test_customers_are_joined_while_rows_are_narrow_and_sellers_by_their_size(spark, tmp_path, feeds):
    lake = build(spark, feed_of(spark, feeds), str(tmp_path), "run", datetime(2024, 1, 1))
    for name in ("silver_order_service", "_items_of_orders"):
        lake.__dict__.pop(name, None)
    plan = plan_of(lake.silver_order_service)
    joins = re.findall(r"Join LeftOuter, \((\w+)#\d+ = (\w+)#", plan)
    assert [left for left, _ in joins] == [
        "seller_zip_code_prefix", "primary_seller_id", "order_id", "order_id", "order_id", "customer_zip_code_prefix", "customer_id",
    ]  # fmt: skip  # the last joined comes first
