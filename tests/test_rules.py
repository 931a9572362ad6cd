import datetime

import pytest
from conftest import by, one

from sitewright.operators import metrics, rules
from sitewright.schema import LISTING_COLUMNS


def run(df, *rule_list):
    return rules.run_suite(df, "s", list(rule_list)).collect()


def verdict(df, rule):
    rows = run(df, rule)
    assert len(rows) == 1
    return rows[0]


@pytest.fixture
def values(spark):
    def make(*cells, schema="v string"):
        return spark.createDataFrame([(c,) for c in cells], schema)

    return make


def test_unique_counts_every_member_of_a_group(values):
    row = verdict(values("a", "a", "b", None, None), rules.Unique("v"))
    assert (row["considered"], row["unexpected"], row["success"]) == (3, 2, False)
    assert verdict(values("a", "b", None), rules.Unique("v"))["success"]


def test_not_null_looks_at_all_rows(values):
    row = verdict(values("a", None, "b", "c"), rules.NotNull("v", 0.75))
    assert (row["considered"], row["unexpected"], row["observed"], row["success"]) == (4, 1, 0.75, True)
    assert not verdict(values("a", None, "b", "c"), rules.NotNull("v", 0.76))["success"]
    assert not verdict(values(None), rules.NotNull("v"))["success"]


def test_in_set_and_between_skip_nulls(values):
    in_set = rules.InSet("v", 0.5, ("a",))
    assert verdict(values("a", "z", None), in_set)["success"]
    assert verdict(values(None, None), in_set).asDict()["observed"] is None
    assert verdict(values(None, None), in_set)["success"]
    between = rules.Between("v", 1.0, -90.0, 90.0)
    assert verdict(values(-90.0, 90.0, None, schema="v double"), between)["success"]
    row = verdict(values(90.1, 0.0, schema="v double"), between)
    assert (row["unexpected"], row["success"]) == (1, False)


def test_empty_table_passes_all_but_the_row_count(values):
    df = values()
    good = run(df, rules.Unique("v"), rules.NotNull("v"), rules.InSet("v", 1.0, ("a",)))
    assert all(r["success"] for r in good) and {r["considered"] for r in good} == {0}
    row = verdict(df, rules.RowCount(low=1, high=10_000))
    assert (row["observed"], row["success"]) == (0.0, False)


def test_row_count_limits_are_inclusive(values):
    df = values("a", "b")
    for low, high, good in ((2, 2, True), (3, 9, False), (0, 1, False)):
        assert verdict(df, rules.RowCount(low=low, high=high))["success"] is good


def test_missing_column_is_left_out(values, caplog):
    rows = run(values("a"), rules.NotNull("other"), rules.NotNull("v"))
    assert [r["column"] for r in rows] == ["v"]
    assert "other" in caplog.text
    assert run(values("a"), rules.NotNull("other")) == []


def test_pair_and_null_island(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.01, 0.01), (None, 1.0)], "latitude double, longitude double")
    row = verdict(df, rules.PairPresent("latitude", 0.85, "longitude"))
    assert (row["considered"], row["unexpected"], row["success"]) == (3, 1, False)
    row = verdict(df, rules.NoNullIsland("latitude"))
    assert (row["unexpected"], row["success"]) == (1, False)


def test_columns(spark, listings):
    expected = rules.bronze_documented_rules()[0]
    df = listings({"id": "1"})
    assert verdict(df, expected)["success"]
    swapped = df.select("name", "id", *LISTING_COLUMNS[2:])
    assert verdict(swapped, expected)["unexpected"] == 2
    assert verdict(df.drop("street"), expected)["unexpected"] == 1
    assert verdict(df, rules.ColumnCount(low=16, high=16))["success"]
    assert not verdict(df, rules.ColumnCount(low=20, high=30))["success"]


def test_rules_on_rolled_up_tables(spark):
    df = spark.createDataFrame(
        [("micro", 5), ("nano", 3), ("bar", 3), (None, 9)], "brewery_type_normalized string, brewery_count long"
    )
    kind = "brewery_type_normalized"
    assert verdict(df, rules.Contains(kind, "micro"))["success"]
    assert not verdict(df, rules.Contains(kind, "large"))["success"]
    assert not verdict(df, rules.TopEntity(kind, "micro", k=1))["success"]
    assert verdict(df, rules.TopEntity(kind, "micro", k=2))["success"]
    # The name decides between equals.
    assert verdict(df, rules.TopEntity(kind, "bar", k=3))["success"]
    assert not verdict(df, rules.TopEntity(kind, "nano", k=3))["success"]
    assert verdict(df, rules.SumMatches("brewery_count", 20))["success"]
    row = verdict(df, rules.SumMatches("brewery_count", spark.sql("SELECT 21L AS n")))
    assert (row["observed"], row["threshold"], row["success"]) == (20.0, "21", False)


def test_a_suite_keeps_rule_order_and_names(values):
    rows = run(values("a"), rules.RowCount(low=1, high=1), rules.Unique("v"), rules.NotNull("v", 0.99))
    assert [(r["rule"], r["threshold"]) for r in rows] == [
        ("row_count", "1..1"), ("unique", "1"), ("not_null", "0.99"),
    ]


def test_silver_limits_follow_the_landed_count():
    assert rules.silver_rules(1001)[0] == rules.RowCount(low=950, high=1001)
    assert rules.silver_rules(0)[0] == rules.RowCount(low=5_000, high=50_000)
    assert rules.silver_rules()[0] == rules.RowCount(low=5_000, high=50_000)


def test_summaries(values):
    good, bad = rules.NotNull("v"), rules.RowCount(low=9, high=9)
    df = values("a")
    both = rules.run_suite(df, "x", [good, bad]).unionByName(rules.run_suite(df, "y", [good]))
    rows = by(rules.suite_summary(both), "suite")
    assert (rows["x"]["passed_expectations"], rows["x"]["success_rate"], rows["x"]["success"]) == (1, 50.0, False)
    assert rows["y"]["success"]
    row = one(rules.combined_summary(rules.suite_summary(both)))
    assert (row["total_aggregations"], row["passed_aggregations"], row["success"]) == (2, 1, False)
    layers = by(
        rules.validation_summary(
            {"bronze": rules.run_suite(df, "b", [good]), "silver": rules.run_suite(df, "s", [bad, good])}
        ),
        "layer",
    )
    assert layers["bronze"]["success"] and not layers["silver"]["success"]
    assert (layers["overall"]["total_expectations"], layers["overall"]["failed"]) == (3, 1)


def test_a_suite_that_cannot_run_has_failed(values, caplog):
    df = values("a").selectExpr("raise_error('broken') AS v")
    spark = df.sparkSession

    def of(build):
        return one(rules.summary_or_failure(spark, "x", build))

    # When it runs, when it is built, and for want of rules or tables.
    for build in (
        lambda: rules.run_suite(df, "x", [rules.Unique("v")]),
        lambda: rules.run_suite(values("a").select("v").where("nothing = 1"), "x", [rules.Unique("v")]),
        lambda: rules.validate_gold({}),
    ):
        row = of(build)
        assert (row["suite"], row["total_expectations"], row["success"]) == ("x", 0, False)
    assert "broken" in caplog.text and "nothing" in caplog.text
    assert of(lambda: rules.run_suite(values("a"), "x", [rules.Unique("v")]))["success"]


def test_no_tables_are_no_success(spark):
    none = rules.validate_gold({})
    assert none.columns == rules.COLUMNS and none.collect() == []
    row = one(rules.combined_summary(rules.suite_summary(none)))
    assert (row["total_aggregations"], row["success"]) == (0, False)


def test_limits_can_be_given(spark, listings):
    rows = listings(*[{"id": str(i), "name": "n", "brewery_type": "micro"} for i in range(30)])
    volume = lambda df: one(df.where("rule = 'row_count'"))
    assert not volume(rules.validate_bronze(rows))["success"]
    fits = rules.Limits(bronze_rows=(10, 60_000_000), silver_rows=(1, 29), silver_kept=0.5, gold_rows=(1, 2), gold_count=9)
    assert volume(rules.validate_bronze(rows, fits))["threshold"] == "10..60000000"
    assert volume(rules.validate_bronze(rows, fits))["success"]
    assert not volume(rules.validate_silver(rows, None, fits))["success"]
    assert volume(rules.validate_silver(rows, 60, fits))["success"]
    groups = spark.createDataFrame([("a", 5), ("b", 10), ("c", 1)], "brewery_type_normalized string, brewery_count long")
    got = by(rules.validate_gold({"breweries_by_type_and_state": groups}, limits=fits), "rule")
    assert not got["row_count"]["success"] and got["between"]["unexpected"] == 1


def test_observed_measures_judge_like_a_suite(spark, listings):
    rows = listings({"id": "1", "latitude": 1.0, "longitude": 2.0}, {"id": "2"})
    suite = [rules.NotNull("id"), rules.PairPresent("latitude", 0.85, "longitude"), rules.RowCount(low=1, high=9), rules.NotNull("gone")]
    measured = rows.agg(*rules.row_measures(rows, "s", suite))
    assert rules.judge_measured(rows, measured, "s", suite).collect() == rules.run_suite(rows, "s", suite).collect()
    with pytest.raises(ValueError, match="groups"):
        rules.row_measures(rows, "s", [rules.Unique("id")])


def test_volume_anomaly(spark):
    counts = [
        ("2026-01-30", 100), ("2026-01-31", 120), ("2026-02-01", 96), ("2026-02-02", 0),
        ("2026-05-01", 50), ("2026-05-02", 80),
    ]
    df = spark.createDataFrame(
        [(datetime.date.fromisoformat(d), n) for d, n in counts], "run_date date, records long"
    )
    rows = by(rules.volume_anomaly(df, "run_date", "records"), "run_date")
    got = [
        (rows[datetime.date.fromisoformat(d)]["previous_count"], rows[datetime.date.fromisoformat(d)]["anomaly"])
        for d, _ in counts
    ]
    # 20 % exactly is no anomaly; nothing is compared with nothing or with zero.
    assert got == [(None, False), (100, False), (120, False), (96, True), (0, False), (50, True)]


def test_volume_is_not_compared_with_the_unknown(spark):
    days = [("2026-01-30", 100), ("2026-02-01", 200), ("2026-02-02", None), ("2026-02-03", 205), (None, 7)]
    df = spark.createDataFrame(
        [(d and datetime.date.fromisoformat(d), n) for d, n in days], "run_date date, records long"
    )
    rows = by(rules.volume_anomaly(df, "run_date", "records"), "run_date")
    got = [rows[d and datetime.date.fromisoformat(d)]["previous_count"] for d, _ in days]
    assert got == [None, 100, 200, None, None]
    assert [rows[d and datetime.date.fromisoformat(d)]["anomaly"] for d, _ in days] == [False, True, False, False, False]


def test_listings_may_be_many(spark):
    many = spark.range(10_001).withColumnRenamed("id", "n")
    assert all(r["success"] for r in rules.validate_gold({"breweries": many}).collect())


# ---- metrics ----------------------------------------------------------------


def test_profile(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, None), (None, 2, "x")], "id string, n int, s string")
    rows = by(metrics.profile_table(df), "column_name")
    assert {c: r["null_count"] for c, r in rows.items()} == {"id": 1, "n": 1, "s": 2}
    assert (rows["n"]["row_count"], rows["n"]["column_count"], rows["n"]["duplicate_count"]) == (3, 3, 1)
    row = one(metrics.profile_table(spark.range(3)))
    assert (row["column_name"], row["row_count"], row["duplicate_count"]) == (None, 3, 0)


def test_quality_metrics_of_nothing(spark, listings):
    from sitewright.operators.clean import clean_sites
    from sitewright.operators.locate import coordinates_valid

    nothing = coordinates_valid(clean_sites(listings()))
    row = one(metrics.silver_quality_metrics(nothing))
    assert (row["total_records"], row["unique_ids"], row["completeness_rate"]) == (0, 0, None)
    assert set(one(metrics.enrichment_rates(nothing))) == {0.0}


def test_count_maps(listings):
    from sitewright.operators.clean import clean_sites

    df = clean_sites(
        listings({"id": "1", "brewery_type": "nano", "country": "US"}, {"id": "2", "brewery_type": "nano"})
    )
    row = one(metrics.count_maps(df))
    assert row["by_type"] == {"nano": 2}
    assert row["by_country"] == {"United States": 1, "null": 1}
