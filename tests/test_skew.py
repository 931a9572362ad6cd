"""Joins and distinct counts stay right, and stay small, when one key holds much of the data."""

import re

from conftest import RUN_AT, by, one
from pyspark.sql import functions as F

from sitewright.operators import gold, locate, rules
from sitewright.operators.parts import distinct_counts, few_left_join, first_by, key_plan, merge_parts, planned_left_join


def skewed(spark):
    """A third of the rows under one key, some without a key, the rest spread; copies included."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
        (F.col("id") % 50).cast("string")
    )
    df = spark.range(3000).select((F.col("id") % 900).alias("n"), k.alias("k"))
    return df.unionAll(df.limit(100))


def dictionary(spark):
    numbers = spark.range(0, 60, 2).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    return numbers.unionAll(spark.sql("SELECT 'hot' AS k, -1L AS v"))


def rows(df):
    return sorted((r["k"] or "", r["n"], r["v"] if r["v"] is not None else 10**6) for r in df.collect())


def test_all_joins_agree_with_the_plain_one(spark):
    left, right = skewed(spark), dictionary(spark)
    want = rows(left.join(right, "k", "left"))
    for slot_rows in (1, 20, 500, 10**6):
        assert rows(planned_left_join(left, right, "k", slot_rows)) == want
    assert rows(planned_left_join(left, right, "k", 20, keys_from=left.distinct())) == want
    assert rows(few_left_join(left, right, "k")) == want


def test_slots_follow_the_counts(spark):
    plan = by(key_plan(skewed(spark), "k", 20), "_hot")
    counts = {r["k"]: r["count"] for r in skewed(spark).where("k IS NOT NULL").groupBy("k").count().collect()}
    assert {k: r["_slots"] for k, r in plan.items()} == {k: -(-n // 20) for k, n in counts.items() if n > 20}
    assert key_plan(skewed(spark), "k", 10**6) is None
    # A plan over its size gets wider slots, down to none at all.
    assert key_plan(skewed(spark), "k", 1, most_bytes=0) is None


def test_five_thousand_hot_keys_and_half_the_rows_without_one(spark):
    key = F.when(F.col("id") % 2 == 0, None).otherwise((F.col("id") % 10_000).cast("string"))
    left = spark.range(80_000).select(key.alias("k"), F.lit(1).alias("n"))
    right = spark.range(0, 10_000, 3).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    assert key_plan(left, "k", 2).count() == 5_000
    joined = planned_left_join(left, right, "k", 2)
    want = left.join(right, "k", "left")
    assert joined.groupBy("k", "v").count().exceptAll(want.groupBy("k", "v").count()).isEmpty()
    assert joined.count() == 80_000
    # Rows without a key are beside the join: the sides of the union differ in that filter.
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(k" in plan and "isnotnull(k" in plan


def test_equal_rows_of_a_hot_key_are_dealt_evenly(spark):
    left = spark.range(10_000).select(F.lit("hot").alias("k"), F.lit(1).alias("n"))
    slots = planned_left_join(left, dictionary(spark), "k", 100)
    assert slots.where("v = -1").count() == 10_000
    dealt = left.select(F.pmod(F.monotonically_increasing_id(), F.lit(100)).alias("s")).groupBy("s").count()
    sizes = [r["count"] for r in dealt.collect()]
    assert len(sizes) == 100 and max(sizes) <= 2 * min(sizes)


def test_a_repeated_gazetteer_key_adds_no_rows(spark, listings):
    from sitewright.operators.clean import clean_sites

    row = {"id": "1", "street": "1 Road", "city": "Town", "state": "S", "country": "France"}
    df = clean_sites(listings(row, row, {**row, "id": "2", "street": "2 Road"}))
    schema = "key string, latitude double, longitude double"
    address = spark.createDataFrame([("1 Road, Town, S, France", 5.0, 1.0), ("1 Road, Town, S, France", 4.0, 9.0)], schema)
    city = spark.createDataFrame([("Town, France", 7.0, 1.0)] * 3, schema)
    for few_bytes in (0, 1 << 20):
        found = locate.lookup_coordinates(df, address, city, slot_rows=1, few_bytes=few_bytes)
        got = {i: (r["found_latitude"], r["copies"]) for i, r in by(found, "id").items()}
        assert got == {"1": (4.0, 2), "2": (7.0, 1)}


def test_first_by_combines_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), "id")
    best = first_by(df, ["k"], -F.col("id"))
    assert {k: r["id"] for k, r in by(best, "k").items()} == {0: 2997, 1: 2998, 2: 2999}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_merge_is_null_safe(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    got = by(merge_parts(["k"], a, b), "k")
    assert {k: (r["a"], r["b"]) for k, r in got.items()} == {None: (1, 3), "x": (2, None), "y": (None, 4)}


def test_distinct_counts(spark):
    df = spark.createDataFrame(
        [("a", 1, "p"), ("a", 1, "q"), ("a", None, "q"), ("b", None, None)], "k string, x int, y string"
    )
    got = by(distinct_counts(df, ["k"], {"xs": "x", "ys": "y"}), "k")
    assert (got["a"]["xs"], got["a"]["ys"], got["b"]["xs"], got["b"]["ys"]) == (1, 2, 0, 0)


def test_no_copies_of_rows_and_no_cross_join(spark):
    """No table expands its rows; what is grouped by id carries the keys and nothing else."""
    from test_gold import ten

    for name in gold.ROLLUPS:
        plan = gold.gold_table(name, ten(spark), RUN_AT)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
        by_id = [line for line in plan.splitlines() if re.search(r"keys=\[id#", line)]
        assert by_id and all("functions=[]" in line for line in by_id), name


def test_shared_parts_leave_few_ids_to_count(spark, monkeypatch):
    from test_gold import TEN, ten

    # One id moves between states, one repeats in place, one is missing.
    rows = [*TEN, TEN[0][:3] + ("Texas", "Austin") + TEN[0][5:], TEN[1], (None,) + TEN[1][1:]]
    want = {name: gold.gold_table(name, ten(spark, rows), RUN_AT).collect() for name in gold.ROLLUPS}
    for few in (0, 100):
        monkeypatch.setattr(gold, "FEW_IDS", few)
        parts = gold.shared_parts(ten(spark, rows))
        assert {r["id"] for r in parts.ids.collect()} == {"a1"}
        tables = gold.gold_tables(ten(spark, rows), parts, RUN_AT)
        assert {name: tables[name].collect() for name in gold.ROLLUPS} == want
    assert by(gold.gold_table("breweries_by_country", ten(spark, rows), RUN_AT), "country_normalized")[
        "chile"
    ]["unique_breweries"] == 3


def test_unique_rule_uses_no_window(spark):
    df = spark.range(1000).select((F.col("id") % 900).alias("id"))
    results = rules.run_suite(df, "s", [rules.Unique("id")])
    assert "Window" not in results._jdf.queryExecution().executedPlan().toString()
    assert one(results)["unexpected"] == 200


def test_boxes_join_without_a_shuffle(spark, listings):
    from sitewright.operators.clean import clean_sites

    plan = locate.coordinates_valid(clean_sites(listings({"id": "1"})))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
