"""Hot keys, input order, broadcast limits and the shared work folder."""

import re
from decimal import Decimal

import pytest
from test_layers import FEED_ROWS, item, order

from bazarlake.lake import Lake
from bazarlake.operators.workdir import ensure_checkpoint_dir
from bazarlake.plans import analyses
from bazarlake.sources.feeds import FEEDS


@pytest.fixture(scope="module")
def hot_feeds():
    """A third of all items share one order, and a third of all orders share one person."""
    orders = [order(f"o{i}", customer="c1" if i % 3 else f"c{i}") for i in range(300)]
    orders += [order("o1")] * 150  # repeated rows of one order
    items = [item("o1", number=str(n), seller=f"s{n % 2 + 1}", price="1.50", freight="0.25") for n in range(500)]
    items += [item(f"o{n % 300}", number=str(1000 + n), seller="s1", price="2.00", freight="1") for n in range(1000)]
    people = [(f"c{i}", "u1" if i % 3 else f"u{i}", "1234", "rio", "rj") for i in range(300)]
    return {**FEED_ROWS, "orders": orders, "order_items": items, "customers": people}


def lake_of(spark, feeds, parts):
    return Lake(lambda name: spark.createDataFrame(feeds[name], FEEDS[name].schema).repartition(parts))


def test_hot_keys_lose_nothing_in_any_partitioning(spark, hot_feeds):
    results = []
    for parts in (1, 6):
        lake = lake_of(spark, hot_feeds, parts)
        rows = {r.order_id: r for r in lake.silver_order_service.collect()}
        assert len(rows) == 300
        assert rows["o1"].order_item_count == 500 + 4 and rows["o1"].distinct_seller_count == 2
        top = analyses.q1_seller(lake.fact_order_item_sales).collect()
        assert sum(r.item_count for r in top) == 1500
        assert sum(r.gmv_total_value for r in top) == Decimal(500 * 175 + 1000 * 300) / 100
        assert {r.analysis_group: r.order_count for r in top} == {"s1": 300, "s2": 1}
        results.append(sorted(map(str, rows.values())))
    assert results[0] == results[1]


def test_no_cross_join_and_no_global_window_in_the_facts(spark, hot_feeds):
    lake = lake_of(spark, hot_feeds, 2)
    for df in (lake.fact_order_service, lake.fact_order_item_sales, lake.mart_logistics_performance):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert not re.search(r"Exchange SinglePartition", plan)


def test_a_query_reads_only_what_it_needs(spark, hot_feeds):
    lake = lake_of(spark, hot_feeds, 2)
    plan = analyses.q3_late_vs_review(lake.fact_order_service)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "price" not in plan and "latitude" not in plan


class FakeSession:
    """A session on a cluster without a shared folder."""

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(name, default):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(FakeSession)
