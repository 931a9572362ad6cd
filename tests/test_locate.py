from conftest import by, one

from sitewright.functions.text import joined
from sitewright.operators import clean, locate

POINTS = {
    # id: (country, latitude, longitude, in range, off null island, in box, valid)
    "none": ("United States", None, None, False, True, None, False),
    "half": ("United States", 40.0, None, False, True, None, False),
    "half-out": ("United States", 10.0, None, False, True, False, False),
    "origin": (None, 0.0, 0.0, True, False, True, False),
    "near": (None, 0.05, -0.05, True, False, True, False),
    "edge": (None, 0.1, 0.0, True, True, True, True),
    "pole": (None, 90.0, 180.0, True, True, True, True),
    "south": (None, -90.0, -180.0, True, True, True, True),
    "over": (None, 91.0, 0.5, False, True, True, False),
    "corner": ("United States", 24.0, -125.0, True, True, True, True),
    "alaska": ("United States", 61.2, -149.9, True, True, False, False),
    "unlisted": ("Portugal", 61.2, -149.9, True, True, True, True),
    "scotland": ("Scotland", 55.9, -3.2, True, True, True, True),
    "empty-null": ("Portugal", None, None, False, True, True, False),
}


def placed(listings):
    df = clean.clean_sites(
        listings(
            *[
                {"id": i, "country": c, "latitude": lat, "longitude": lon}
                for i, (c, lat, lon, *_) in POINTS.items()
            ]
        )
    )
    return df


def test_checks(listings):
    rows = by(locate.coordinate_checks(placed(listings)), "id")
    for i, (_, _, _, in_range, off_island, in_box, _) in POINTS.items():
        got = [rows[i][c] for c in locate.CHECKS]
        assert got == [in_range, off_island, in_box], i


def test_valid_is_never_null_and_leaves_no_helper_columns(listings):
    df = placed(listings)
    checked = locate.coordinates_valid(df)
    assert checked.columns == df.columns + ["coordinates_valid"]
    rows = by(checked, "id")
    assert {i: rows[i]["coordinates_valid"] for i in POINTS} == {i: p[6] for i, p in POINTS.items()}


def test_breakdown(listings):
    row = one(locate.coordinate_breakdown(placed(listings)))
    assert row.asDict() == {
        "with_coordinates": 10, "valid": 6, "invalid": 4, "null_island": 2, "out_of_range": 5,
        "points_out_of_range": 1, "wrong_country": 1,
    }


def test_own_boxes(spark, listings):
    boxes = spark.createDataFrame(
        [("Portugal", 36.0, 43.0, -10.0, -6.0)],
        "box_country string, lat_min double, lat_max double, lon_min double, lon_max double",
    )
    rows = by(locate.coordinates_valid(placed(listings), boxes), "id")
    assert not rows["unlisted"]["coordinates_valid"] and rows["alaska"]["coordinates_valid"]


# ---- lookup -----------------------------------------------------------------

MISSING = [
    {"id": "address", "street": "1 Road", "city": "Town", "state": "S", "country": "France", "postal_code": "9"},
    {"id": "city", "street": "2 Road", "city": "Town", "state": "S", "country": "France"},
    {"id": "two-parts", "city": "Town", "country": "France"},
    {"id": "no-hit", "street": "3 Road", "city": "Nowhere", "country": "France"},
    {"id": "no-parts"},
    {"id": "zero", "street": "0 Road", "city": "Zero", "country": "France"},
]
HAS = {"id": "has", "city": "Town", "country": "France", "street": "1 Road", "latitude": 1.5, "longitude": 2.5}


def tables(spark):
    schema = "key string, latitude double, longitude double"
    return (
        spark.createDataFrame(
            [("1 Road, Town, S, France, 9", 45.0, 3.0), ("0 Road, Zero, France", 0.0, 0.0)], schema
        ),
        spark.createDataFrame([("Town, France", 46.0, 4.0)], schema),
    )


def look_up(spark, listings, rows, **kwargs):
    df = clean.clean_sites(listings(*rows))
    return df, locate.lookup_coordinates(df, *tables(spark), **kwargs)


EXPECTED = {
    "address": ("address", 45.0), "city": ("city", 46.0), "two-parts": (None, None),
    "no-hit": (None, None), "no-parts": (None, None), "zero": ("address", 0.0),
}


def test_lookup_levels(spark, listings):
    _, found = look_up(spark, listings, [*MISSING, HAS])
    got = {i: (r["found_level"], r["found_latitude"]) for i, r in by(found, "id").items()}
    assert got == EXPECTED


def test_lookup_is_the_same_when_keys_are_hot(spark, listings):
    _, found = look_up(spark, listings, [*MISSING, HAS], slot_rows=1, few_bytes=0)
    got = {i: (r["found_level"], r["found_latitude"]) for i, r in by(found, "id").items()}
    assert got == EXPECTED


def test_lookup_two_parts_hit_as_an_address(spark, listings):
    # The whole address is city and country, so it is looked up as the first key only.
    schema = "key string, latitude double, longitude double"
    city_as_address = spark.createDataFrame([("Town, France", 47.0, 5.0)], schema)
    df = clean.clean_sites(listings(*MISSING))
    found = by(locate.lookup_coordinates(df, city_as_address, tables(spark)[1]), "id")
    assert found["two-parts"]["found_level"] == "address"


def test_cap(spark, listings):
    for cap, expected in ((1, ["address"]), (3, ["address", "city", "no-hit"]), (0, None), (None, None)):
        df, found = look_up(spark, listings, [*MISSING, HAS], max_records=cap)
        ids = sorted(r["id"] for r in found.collect())
        assert ids == (expected or sorted(EXPECTED)), cap


def test_apply_updates_point_and_flag_only(spark, listings):
    rows = [{**row, "phone": "1"} for row in MISSING] + [HAS]
    df, found = look_up(spark, listings, rows)
    after = by(locate.apply_lookup(df, found, keep_level=True), "id")
    assert (after["address"]["latitude"], after["address"]["longitude"]) == (45.0, 3.0)
    assert after["address"]["has_coordinates"] and not after["address"]["is_complete"]
    assert after["address"]["geocoded_source"] == "address"
    assert (after["zero"]["latitude"], after["zero"]["has_coordinates"]) == (0.0, True)
    assert not after["no-hit"]["has_coordinates"]
    assert (after["has"]["latitude"], after["has"]["geocoded_source"]) == (1.5, None)
    again = by(locate.apply_lookup(df, found, recompute_complete=True), "id")
    assert again["address"]["is_complete"]


def test_repeated_ids_do_not_multiply(spark, listings):
    twice = [MISSING[0], MISSING[0], {**MISSING[1], "id": "address"}, {**HAS, "id": "address"}]
    df, found = look_up(spark, listings, twice)
    assert {(r["found_level"], r["copies"]) for r in found.collect()} == {("address", 2), ("city", 1)}
    for kwargs in ({}, {"slot_rows": 1}, {"few_bytes": 0, "slot_rows": 1}):
        after = locate.apply_lookup(df, found, **kwargs).collect()
        # One hit per id, the address match, for every row of that id.
        assert [r["latitude"] for r in after] == [45.0] * 4, kwargs


def test_many_shared_ids_join_another_way(spark, listings):
    twice = [MISSING[0], {**MISSING[1], "id": "address"}, {**HAS, "id": "address"}, HAS, MISSING[4]]
    df, found = look_up(spark, listings, twice)
    for few_bytes in (0, 1 << 20):
        for slot_rows in (1, 1000):
            after = locate.apply_lookup(df, found, slot_rows=slot_rows, few_bytes=few_bytes).collect()
            got = sorted((r["id"], r["latitude"]) for r in after if r["latitude"])
            assert got == [("address", 45.0)] * 3 + [("has", 1.5)] and len(after) == 5


def test_coverage(spark, listings):
    df, found = look_up(spark, listings, [*MISSING, MISSING[0], HAS])
    row = one(locate.lookup_coverage(df, locate.apply_lookup(df, found), found))
    assert (row["total_records"], row["before_with"], row["before_missing"]) == (8, 1, 7)
    assert (row["after_with"], row["new_coordinates"]) == (5, 4)
    assert (row["attempted"], row["successful"], row["failed"]) == (7, 4, 3)
    assert row["before_percent"] == 12.5 and row["after_percent"] == 62.5
    assert row["improvement_percent"] == round(4 / 7 * 100, 2) == row["success_rate"]


def test_coverage_of_nothing(spark, listings):
    df, found = look_up(spark, listings, [])
    row = one(locate.lookup_coverage(df, locate.apply_lookup(df, found), found))
    assert set(row) == {0}


def test_density_cells(listings):
    df = clean.clean_sites(
        listings(
            {"id": "1", "city": "B", "state": "S", "latitude": 10.25, "longitude": 0.35},
            {"id": "2", "city": "A", "latitude": 10.15, "longitude": 0.44},
            {"id": "3", "latitude": 10.35, "longitude": 0.44},
        )
    )
    cells = by(locate.density_grid(df), "lat_rounded", "lon_rounded")
    assert cells[(10.2, 0.4)]["count"] == 2 and cells[(10.2, 0.4)]["city"] == "A"
    assert cells[(10.4, 0.4)]["count"] == 1
    top = locate.top_density_cells(df).collect()
    assert [r["location"] for r in top] == ["A", "N/A"]


def test_joined_skips_missing(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(joined(F.lit("a"), F.lit(None), F.lit("c")).alias("x")).first()
    assert row["x"] == "a, c"
