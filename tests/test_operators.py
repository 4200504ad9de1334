"""Reusable operators against brute force."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from bazarlake.operators.dedupe import keep_one, keep_one_grouped
from bazarlake.operators.keys import only_in, orphan_count
from bazarlake.operators.profiling import column_profile
from bazarlake.operators.quarantine import accepted, rejected
from bazarlake.operators.ranking import exact_percentiles, global_row_number, running_total
from bazarlake.sources.feeds import FEEDS
from bazarlake.sources.files import read_csv_text, read_table, save_managed, write_csv_text, write_table, written_row_count


def skewed_rows():
    """A third of all rows share one key."""
    rng = random.Random(7)
    hot = [("hot", rng.randrange(50), rng.choice([None, "x", "y"])) for _ in range(400)]
    return hot + [(f"k{rng.randrange(300)}", rng.randrange(50), rng.choice([None, "x", "y"])) for _ in range(800)]


def test_keep_one_is_first_by_all_columns_in_any_order(spark):
    rows = skewed_rows()

    def order(row):
        return (row[1], row[2] is not None, row[2] or "")

    expected = {}
    for row in rows:
        if row[0] not in expected or order(row) < order(expected[row[0]]):
            expected[row[0]] = row
    for seed, parts in ((1, 1), (2, 8)):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, a int, b string").repartition(parts)
        for keep in (keep_one, keep_one_grouped):
            assert sorted(map(tuple, keep(df, ["k"]).collect()), key=str) == sorted(expected.values(), key=str)


def test_keep_one_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed_rows(), "k string, a int, b string")
    plan = keep_one(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_unused_join_drops_out(spark):
    left = spark.range(5).withColumn("k", F.col("id").cast("string"))
    right = keep_one_grouped(spark.createDataFrame(skewed_rows(), "k string, a int, b string"), ["k"])
    plan = left.join(right, "k", "left").select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_quarantine_splits_without_loss(spark):
    rows = [(1, None, 5), (2, "a", -1), (3, None, -1), (4, "b", 0)]
    df = spark.createDataFrame(rows, "id int, name string, amount int")
    rules = [("no name", F.col("name").isNull()), ("below zero", F.coalesce("amount", F.lit(-1)) < 0)]
    assert [r.id for r in accepted(df, rules).collect()] == [4]
    reasons = {r.id: r.quarantine_reason for r in rejected(df, rules).collect()}
    assert reasons == {1: "no name", 2: "below zero", 3: "no name; below zero"}


def test_global_row_number(spark):
    rows = [(i, i % 7 if i % 3 else 1) for i in range(1000)]  # a third shares one value
    df = spark.createDataFrame(rows, "id int, v int").repartition(6)
    ranked = {r.id: r.rank for r in global_row_number(df, [F.desc("v"), F.asc("id")], "rank").collect()}
    expected = {row[0]: n for n, row in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert ranked == expected


def test_running_total(spark):
    rows = [(i, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, w int").repartition(5)
    got = {r.id: r.upto for r in running_total(df, [F.col("id")], "w", "upto").collect()}
    total = 0
    for i, w in rows:
        total += w
        assert got[i] == total


def test_exact_percentiles(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1.5, rng.randrange(1000) / 100]), None if i % 4 else i * 1.0) for i in range(501)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(7)
    fractions = (0.01, 0.25, 0.5, 0.75, 0.99)
    got = {(r.metric, r.fraction): r.value for r in exact_percentiles(df, ["a", "b"], fractions).collect()}
    for place, metric in enumerate("ab"):
        known = sorted(row[place] for row in rows if row[place] is not None)
        for p in fractions:
            assert got[metric, p] == known[max(1, math.ceil(p * len(known))) - 1]


def test_orphans_and_set_difference(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), ("c",)], "k string")
    assert orphan_count(child, parent, "k").first().orphan_record_count == 2
    assert orphan_count(child.filter("k = 'b'"), parent, "k").first().orphan_record_count == 0
    assert [r.k for r in only_in(parent, child, ["k"]).collect()] == ["c"]


def test_column_profile(spark):
    rows = [("", 1, None), (" ", None, None), ("x", 2, None)]
    df = spark.createDataFrame(rows, "s string, i int, d decimal(18,2)")
    got = {r.column_name: (r.data_type, r.ordinal_position, r.row_count, r.null_count) for r in column_profile(df, "l", "t").collect()}
    assert got == {"s": ("string", 1, 3, 2), "i": ("int", 2, 3, 1), "d": ("decimal(18,2)", 3, 3, 3)}
    empty = column_profile(df.filter("false"), "l", "t").collect()
    assert Counter((r.row_count, r.null_count) for r in empty) == {(0, 0): 3}


def test_csv_and_tables(spark, tmp_path):
    feed = FEEDS["sellers"]
    rows = [(" 1 ", "01.0", "são, paulo", None), ("2", "", 'a "b"', "SP")]
    df = spark.createDataFrame(rows, feed.schema)
    write_csv_text(df, f"{tmp_path}/s.csv")
    back = sorted(map(tuple, read_csv_text(spark, f"{tmp_path}/s.csv", feed).collect()))
    assert back[0][0] == " 1 " and back[0][2] == "são, paulo" and back[0][3] is None
    assert [f.dataType.simpleString() for f in read_csv_text(spark, f"{tmp_path}/s.csv", feed).schema] == ["string"] * 4
    write_table(df.select("seller_id"), str(tmp_path), "t")
    write_table(df, str(tmp_path), "t")  # the second write replaces rows and schema
    assert read_table(spark, str(tmp_path), "t").columns == list(feed.columns)
    assert tuple(written_row_count(spark, str(tmp_path), "t").first()) == ("t", 2)


def test_managed_table(spark):
    df = spark.range(3).withColumn("x", F.lit("a"))
    save_managed(df.select("id"), "bazarlake_managed")
    save_managed(df, "bazarlake_managed")
    assert spark.table("bazarlake_managed").columns == ["id", "x"]
    assert spark.table("bazarlake_managed").count() == 3


def test_csv_line_breaks(spark, tmp_path):
    feed = FEEDS["category_translation"]
    path = tmp_path / "c.csv"
    path.write_text('product_category_name,product_category_name_english\n"a\nb",c\n', encoding="utf-8")
    whole = read_csv_text(spark, str(path), feed, multiline=True).collect()
    assert [tuple(r) for r in whole] == [("a\nb", "c")]
    assert read_csv_text(spark, str(path), feed).count() == 2


def test_profile_of_awkward_column_names(spark):
    from bazarlake.operators.profiling import column_profile

    frame = spark.createDataFrame([(1, " "), (None, "x")], "`it's` int, `back``tick\\n` string")
    rows = {r.column_name: (r.row_count, r.null_count) for r in column_profile(frame, "l", "t").collect()}
    assert rows == {"it's": (2, 1), "back`tick\\n": (2, 1)}
