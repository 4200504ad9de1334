"""What is written and shuffled once: codec of the tables, hashes, bands, lines of the checks."""

from datetime import datetime

import pytest
from test_layers import FEED_ROWS, item

from bazarlake import registry
from bazarlake.lake import Lake, build
from bazarlake.plans import bronze, gold
from bazarlake.sources.feeds import FEEDS
from bazarlake.sources.files import read_table, write_table
from bazarlake.sources.store import FolderStore


def feed_of(spark):
    return lambda name: spark.createDataFrame(FEED_ROWS[name], FEEDS[name].schema)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_are_written_with_the_codec_for_hashes(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    write_table(rows, str(tmp_path), "plain")
    FolderStore(str(tmp_path)).write(rows, "silver", "stored", by=["n"])
    for table in ("plain", "stored"):
        files = [f.name for f in (tmp_path / table).rglob("part-*")]
        assert files and all(name.endswith(".zstd.parquet") for name in files)
        assert sorted(r.n for r in read_table(spark, str(tmp_path), table).collect()) == [1, 2]


def test_totals_of_an_order_do_not_shuffle_the_hash(spark):
    feed = feed_of(spark)
    stamped = Lake(lambda name: bronze.stamped(feed(name), FEEDS[name], "r", datetime(2024, 1, 1)))
    bare = Lake(feed)
    for name in ("silver_payments_order_agg", "silver_reviews_order_agg"):
        with_hash, without = getattr(stamped, name), getattr(bare, name)
        assert "sha2" not in plan_of(with_hash) and "record_hash" not in plan_of(with_hash)
        assert sorted(map(str, with_hash.collect())) == sorted(map(str, without.collect())) != []
    assert "record_hash" in stamped.payments_typed.columns and "record_hash" in stamped.reviews_typed.columns


def test_bands_are_computed_once_for_both_sides_of_their_join(spark, monkeypatch):
    lake = Lake(feed_of(spark))
    monkeypatch.setattr(registry, "lake_of", lambda *_: lake)
    joined = registry.all_queries()["join_left_multikey"](spark, "")
    assert plan_of(joined).count("Join") == 1
    dims = {tuple(r[c] for c in gold.BAND_COLUMNS): r.service_band_key for r in lake.dim_service_band.collect()}
    expected = [(r.order_id, dims[tuple(r[c] for c in gold.BAND_COLUMNS)]) for r in lake.silver_order_service.collect()]
    assert sorted((r.order_id, r.service_band_key) for r in joined.collect()) == sorted(expected) != []


@pytest.fixture
def written(spark, tmp_path):
    rows = {**FEED_ROWS, "order_items": [*FEED_ROWS["order_items"], item("o1", number="9", product="nowhere")]}
    return build(spark, lambda name: spark.createDataFrame(rows[name], FEEDS[name].schema), str(tmp_path), "r")


def test_drilldown_reads_the_tables_once(spark, written, monkeypatch):
    monkeypatch.setattr(registry, "written_lake_of", lambda *_: written)
    listed = registry.all_queries()["dq_drilldown"](spark, "")
    assert "parquet" not in plan_of(listed)
    found = {(r.section, r.item): r.issue_count for r in listed.collect()}
    assert found["integrity", "fact_order_item_sales -> dim_product"] == 1
