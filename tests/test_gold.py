import pytest
from conftest import RUN_AT, by, one
from pyspark.sql import functions as F

from sitewright.operators import explore, gold
from sitewright.plans.report import build_gold, read_all_gold
from sitewright.schema import GOLD_SCHEMAS
from sitewright.sources import tables

# id, type, country, state, city, latitude, longitude, phone, website, flags: valid, placed, contact, complete
TEN = [
    ("a1", "nano", "chile", "Biobio", "Talca", -36.8, -73.0, "5", None, 1, 1, 1, 1),
    ("a2", "nano", "chile", "Biobio", "Lota", -37.1, -73.2, None, "w", 1, 1, 1, 1),
    ("a3", "large", "chile", "Maule", "Talca", -35.4, -71.7, None, None, 1, 1, 0, 0),
    ("b1", "nano", "norway", "Troms", "Alta", 69.9, 23.3, "1", "w", 1, 1, 1, 1),
    ("b2", "taproom", "norway", "Troms", "Senja", None, None, "2", None, None, 0, 1, 0),
    ("b3", "taproom", "norway", "Viken", "Moss", 59.4, 10.7, None, "w", 0, 1, 1, 1),
    ("b4", "taproom", "norway", "Viken", "Moss", 59.5, 10.6, None, None, 1, 1, 0, 0),
    ("c1", "bar", "kenya", None, "Lamu", None, None, None, None, None, 0, 0, 0),
    ("c2", "bar", "kenya", "Coast", "Kilifi", -3.6, 39.8, "8", "w", 1, 1, 1, 1),
    ("d1", None, None, None, None, None, None, None, None, None, 0, 0, 0),
]
SCHEMA = (
    "id string, brewery_type_normalized string, country_normalized string, state string, city string,"
    " latitude double, longitude double, phone string, website_url string, coordinates_valid int,"
    " has_coordinates int, has_contact int, is_complete int"
)


def ten(spark, rows=TEN):
    """The ten listings, with whole-number flags as some sources have them."""
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("name", "street", "address_1", "address_2", "address_3", "postal_code", "full_address"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn("silver_processed_at", F.lit(RUN_AT.isoformat()))


def table(spark, name, rows=TEN):
    return gold.gold_table(name, ten(spark, rows), RUN_AT)


def test_by_type(spark):
    rows = by(table(spark, "breweries_by_type"), "brewery_type_normalized")
    assert rows["nano"]["brewery_count"] == 3 and rows["nano"]["completeness_rate"] == 100.0
    assert rows[None]["brewery_count"] == 1 and rows[None]["completeness_rate"] == 0.0
    assert rows["large"]["with_coordinates"] == 1 and rows["large"]["with_contact"] == 0
    counts = [r["brewery_count"] for r in table(spark, "breweries_by_type").collect()]
    assert counts == sorted(counts, reverse=True)


def test_by_country(spark):
    rows = by(table(spark, "breweries_by_country"), "country_normalized")
    assert rows["chile"]["brewery_count"] == 3 and rows["chile"]["distinct_types"] == 2
    assert rows[None]["distinct_types"] == 0 and rows[None]["unique_breweries"] == 1


def test_by_state(spark):
    rows = by(table(spark, "breweries_by_state"), "state")
    assert rows["Biobio"]["brewery_count"] == 2 and rows["Biobio"]["distinct_cities"] == 2
    assert None not in rows


def test_by_type_and_place(spark):
    pairs = by(table(spark, "breweries_by_type_and_country"), "brewery_type_normalized", "country_normalized")
    assert pairs[("nano", "chile")]["brewery_count"] == 2
    triples = by(table(spark, "breweries_by_type_and_state"), "brewery_type_normalized", "state")
    assert triples[("nano", "Biobio")]["brewery_count"] == 2


def test_summary(spark):
    row = one(table(spark, "brewery_summary_statistics"))
    assert row["total_breweries"] == 10 and row["distinct_types"] == 4 and row["distinct_countries"] == 3
    assert (row["with_coordinates"], row["with_contact"], row["complete_records"]) == (7, 6, 5)


def test_summary_of_nothing(spark):
    row = one(table(spark, "brewery_summary_statistics", []))
    assert (row["total_breweries"], row["unique_breweries"], row["distinct_cities"]) == (0, 0, 0)
    assert row["with_coordinates"] is None
    assert table(spark, "breweries_by_type", []).collect() == []


def test_ids_repeat_and_are_missing(spark):
    rows = [("a", "t", "c", "s", "x", *[None] * 4, 0, 0, 0, 0)] * 3
    rows += [(None, "u", "c", "s", "x", *[None] * 4, 0, 0, 0, 0)]
    got = by(table(spark, "breweries_by_type", rows), "brewery_type_normalized")
    assert (got["t"]["brewery_count"], got["t"]["unique_breweries"]) == (3, 1)
    assert (got["u"]["brewery_count"], got["u"]["unique_breweries"]) == (1, 0)


def test_columns_are_as_declared(spark):
    for name, schema in GOLD_SCHEMAS.items():
        made = table(spark, name)
        assert made.columns == schema.names
        if name != "breweries":
            assert [f.dataType for f in made.schema] == [f.dataType for f in schema], name


def test_build_gives_what_single_tables_give(spark, tmp_path):
    base = str(tmp_path / "gold")
    assert tables.list_gold(spark, base) == []
    report = by(build_gold(ten(spark), base, RUN_AT), "table_name")
    assert sorted(report) == sorted(GOLD_SCHEMAS) == tables.list_gold(spark, base)
    for name, written in read_all_gold(spark, base).items():
        want = sorted(table(spark, name).collect(), key=str)
        assert sorted(written.collect(), key=str) == want, name
        assert report[name]["record_count"] == len(want)
    # A second build replaces the first.
    build_gold(ten(spark, TEN[:3]), base, RUN_AT)
    assert tables.read_gold(spark, base, "breweries").count() == 3


def test_read_gold(spark, tmp_path):
    base = str(tmp_path / "gold")
    tables.write_gold(table(spark, "breweries_by_type"), base, "breweries_by_type")
    filtered = tables.read_gold(spark, base, "breweries_by_type", {"brewery_type_normalized": "nano"})
    assert one(filtered)["brewery_count"] == 3
    with pytest.raises(ValueError, match="no_such_table"):
        tables.read_gold(spark, base, "no_such_table")
    loaded = tables.load_gold_or_empty(spark, base)
    assert loaded["by_type"].count() == 5
    assert loaded["summary"].count() == 0
    assert loaded["summary"].columns == GOLD_SCHEMAS["brewery_summary_statistics"].names


def test_a_damaged_table_is_empty(spark, tmp_path):
    folder = tmp_path / "breweries_by_type"
    folder.mkdir()
    (folder / "part-0.parquet").write_bytes(b"PAR1 nothing of the kind")
    assert tables.load_gold_or_empty(spark, str(tmp_path))["by_type"].collect() == []


def test_end_to_end_three_rows(spark):
    rows = [TEN[0], TEN[1], TEN[3][:1] + ("bar",) + TEN[3][2:]]
    types = by(table(spark, "breweries_by_type", rows), "brewery_type_normalized")
    assert len(types) == 2 and types["nano"]["brewery_count"] == 2
    countries = by(table(spark, "breweries_by_country", rows), "country_normalized")
    assert len(countries) == 2 and countries["chile"]["brewery_count"] == 2


# ---- report queries on the same rows ----------------------------------------


def test_top_lists(spark):
    countries = table(spark, "breweries_by_country")
    assert [r["country_normalized"] for r in explore.top_countries(countries, 2).collect()] == [
        "norway", "chile",
    ]
    others = explore.top_countries_excluding(countries, "norway").collect()
    # Rows without a country are not the excluded country.
    assert {r["country_normalized"] for r in others} == {"chile", "kenya", None}
    states = explore.top_states(table(spark, "breweries_by_state"), 3).collect()
    assert [r["state"] for r in states] == ["Biobio", "Troms", "Viken"]


def test_top_cities_need_all_three_keys(spark):
    rows = [*TEN, ("x", "t", None, "S", "Nowhere", *[None] * 4, 0, 0, 0, 0)]
    cities = explore.top_cities(ten(spark, rows)).collect()
    assert len(cities) == 7 and "Nowhere" not in {r["city"] for r in cities}


def test_shares(spark):
    by_type = table(spark, "breweries_by_type")
    rows = by(explore.type_share(by_type), "brewery_type_normalized")
    assert rows["nano"]["share_percent"] == 30.0
    # nano and taproom are equal; the name decides.
    assert [t for t, r in rows.items() if r["most_common"]] == ["nano"]
    summary = table(spark, "brewery_summary_statistics")
    countries = table(spark, "breweries_by_country")
    share = one(explore.country_share(countries, summary, "chile"))
    assert (share["brewery_count"], share["share_percent"]) == (3, 30.0)
    absent = one(explore.country_share(countries, summary, "Peru"))
    assert (absent["brewery_count"], absent["share_percent"]) == (0, 0.0)


def test_headline_numbers_without_a_summary(spark):
    countries, types = table(spark, "breweries_by_country"), table(spark, "breweries_by_type")
    summary = table(spark, "brewery_summary_statistics")
    full = one(explore.header_metrics(summary, countries, types))
    assert full.asDict() == {
        "total_breweries": 10, "total_countries": 3, "total_types": 4, "coordinate_coverage": 70.0,
    }
    bare = one(explore.header_metrics(summary.limit(0), countries, types))
    assert (bare["total_breweries"], bare["total_countries"], bare["total_types"]) == (0, 4, 5)
    assert bare["coordinate_coverage"] == 0.0


def test_scorecard(spark):
    row = one(explore.quality_scorecard(table(spark, "brewery_summary_statistics")))
    assert (row["coordinate_percent"], row["overall_quality"]) == (70.0, 65.0)
    assert row["without_coordinates"] == 3


def test_rollup_levels(spark):
    rows = by(explore.country_state_rollup(table(spark, "breweries_by_state")), "level", "country_normalized", "state")
    assert rows[(2, None, None)]["brewery_count"] == 8
    assert rows[(1, "chile", None)]["brewery_count"] == 3
    assert rows[(0, "norway", "Troms")]["brewery_count"] == 2


def test_type_mix(spark):
    rows = by(
        explore.type_mix_by_state(table(spark, "breweries_by_type_and_state")), "state", "brewery_type_normalized"
    )
    assert rows[("Troms", "nano")]["type_share"] == 0.5
    rows = by(
        explore.type_mix_by_country(table(spark, "breweries_by_type_and_country")),
        "country_normalized", "brewery_type_normalized",
    )
    assert rows[("norway", "nano")]["type_share"] == 0.25
