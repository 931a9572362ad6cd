from conftest import RUN_AT, by, one
from pyspark.sql import functions as F

from sitewright.operators import clean
from sitewright.schema import LISTING_COLUMNS

# Nothing missing; a contact by telephone alone; text around which there are spaces, and text of nothing
# but spaces; a country under its short name; no state, a contact by address of a site alone.
COMPLETE = {
    "id": "n-17", "name": "Kettle and Fjord", "brewery_type": "brewpub", "street": "Pier 4", "address_1": "Pier 4",
    "city": "Duluth", "state": "Minnesota", "postal_code": "55802", "country": "US", "phone": "218 555 0100",
    "latitude": 46.78, "longitude": -92.1,
}
PADDED = {
    "id": "n-18", "name": " Hollow Oak   ", "brewery_type": "Tap Room", "street": "  ", "address_1": " ",
    "city": "Boise", "state": "Idaho", "postal_code": "83702", "country": "USA",
}
ENGLISH = {
    "id": "n-19", "name": "Tidewater Cellars", "brewery_type": "nano", "city": "Whitby", "country": "England",
    "postal_code": "YO21", "latitude": 54.48, "longitude": -0.61, "website_url": "http://tide.example",
}


def cleaned(listings, *rows):
    return by(clean.clean_sites(listings(*rows)), "id")


def test_three_row_fixture(listings):
    rows = cleaned(listings, COMPLETE, PADDED, ENGLISH)
    assert rows["n-18"]["name"] == "Hollow Oak"
    assert rows["n-18"]["address_1"] is None and rows["n-18"]["street"] is None
    assert rows["n-18"]["country_normalized"] == "United States"
    assert rows["n-19"]["country_normalized"] == "United Kingdom"
    flags = ("has_coordinates", "has_contact", "is_complete")
    assert [rows["n-17"][f] for f in flags] == [True, True, True]
    assert [rows["n-18"][f] for f in flags] == [False, False, False]
    # Without a state a row is not complete.
    assert [rows["n-19"][f] for f in flags] == [True, True, False]


def test_trim_takes_spaces_only(listings):
    rows = cleaned(listings, {"id": "1", "name": " \tTab\t "}, {"id": "2", "name": "   "})
    assert rows["1"]["name"] == "\tTab\t"
    assert rows["2"]["name"] is None


def test_country_spellings_are_case_sensitive(listings):
    spelled = ["US", "USA", "United States", "England", "usa", "Scotland", None]
    rows = cleaned(listings, *[{"id": str(i), "country": c} for i, c in enumerate(spelled)])
    assert [rows[str(i)]["country_normalized"] for i in range(7)] == [
        "United States", "United States", "United States", "United Kingdom", "usa", "Scotland", None,
    ]


def test_type_slug_keeps_every_character(listings):
    rows = cleaned(
        listings,
        {"id": "1", "brewery_type": "Brew Pub"},
        {"id": "2", "brewery_type": "A -- b"},
        {"id": "3"},
    )
    assert rows["1"]["brewery_type_normalized"] == "brew_pub"
    assert rows["2"]["brewery_type_normalized"] == "a____b"
    assert rows["3"]["brewery_type_normalized"] is None


def test_address_and_location_key(listings):
    rows = cleaned(listings, PADDED, {"id": "none"})
    assert rows["n-18"]["full_address"] == "Boise, Idaho, 83702, USA"
    assert rows["n-18"]["location_key"] == "usa_idaho"
    assert rows["none"]["full_address"] == ""
    assert rows["none"]["location_key"] == "unknown_unknown"


def test_processing_metadata_is_the_run_time(listings):
    row = one(clean.add_processing_metadata(listings(COMPLETE), RUN_AT))
    assert row["silver_processed_at"] == "2026-01-21T06:30:00"
    assert row["processing_date"] == RUN_AT.date()
    assert (row["processing_year"], row["processing_month"]) == (2026, 1)


def test_quoted_coordinates_are_kept(spark):
    raw = spark.createDataFrame(
        [("1", "-122.4", "37.7"), ("2", "west", None)], "id string, longitude string, latitude string"
    )
    df = clean.enforce_schema(raw)
    assert df.columns == LISTING_COLUMNS
    rows = by(df, "id")
    assert (rows["1"]["longitude"], rows["1"]["latitude"]) == (-122.4, 37.7)
    assert rows["2"]["longitude"] is None


def test_dedup_takes_the_preferred_row(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "w")], "id string, v int, name string"
    )
    rows = by(clean.dedup_by_id(df, -F.col("v")), "id")
    assert (rows["a"]["v"], rows["a"]["name"]) == (3, "y")
    assert rows["b"]["name"] == "w"


def test_rows_without_an_id_are_no_duplicates(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), ("a", 1, "x"), ("a", 1, "x")], "id string, v int, name string")
    assert sorted(str(r["id"]) for r in clean.dedup_by_id(df).collect()) == ["None", "None", "a"]
