"""Points: checks against boxes, lookup of missing ones, coverage, density."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions import points
from sitewright.functions.numbers import percent, rows_where
from sitewright.functions.text import joined
from sitewright.operators.clean import complete_flag
from sitewright.operators.parts import (
    BROADCAST_BYTES,
    SLOT_ROWS,
    few_left_join,
    first_by,
    merge_parts,
    planned_left_join,
)
from sitewright.operators.positions import first_rows
from sitewright.operators.select import missing_coordinates
from sitewright.schema import country_boxes
from sitewright.sources.files import measured

CHECKS = ["coords_in_range", "not_null_island", "coords_match_country"]


def coordinate_checks(df: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """The three point checks as columns.

    The built-in boxes are 13 fixed rows and are broadcast. A table given
    instead must be unique by box_country; how it is joined is left to its size.
    """
    boxes = F.broadcast(country_boxes(df.sparkSession)) if boxes is None else boxes
    boxed = df.join(boxes, F.col("country_normalized") == F.col("box_country"), "left")
    return boxed.select(
        *df.columns,
        points.on_globe().alias("coords_in_range"),
        points.off_null_island().alias("not_null_island"),
        points.in_box().alias("coords_match_country"),
    )


def _all_passed() -> Column:
    passed = points.present()
    for check in CHECKS:
        passed = passed & F.col(check)
    return F.coalesce(passed, F.lit(False)).alias("coordinates_valid")


def coordinates_valid(df: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """All three checks passed on a full point; never null."""
    return coordinate_checks(df, boxes).select(*df.columns, _all_passed())


def coordinate_breakdown(df: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """How many points failed, and on which check.

    out_of_range counts rows without a point too; points_out_of_range does not.
    """
    checked = coordinate_checks(df, boxes).select("*", _all_passed(), points.present().alias("placed"))
    counts = checked.agg(
        rows_where(F.col("placed")).alias("with_coordinates"),
        rows_where(F.col("coordinates_valid")).alias("valid"),
        rows_where(~F.col("not_null_island")).alias("null_island"),
        rows_where(~F.col("coords_in_range")).alias("out_of_range"),
        rows_where(F.col("placed") & ~F.col("coords_in_range")).alias("points_out_of_range"),
        rows_where(F.col("placed") & ~F.col("coords_match_country")).alias("wrong_country"),
    )
    return counts.withColumn("invalid", F.col("with_coordinates") - F.col("valid"))


# ---- lookup -----------------------------------------------------------------


def _address_parts() -> list[Column]:
    columns = ("street", "city", "state", "country_normalized", "postal_code")
    return [F.nullif(F.col(c), F.lit("")) for c in columns]


def address_key() -> Column:
    """The whole address as looked up; null when no part is there."""
    return F.nullif(joined(*_address_parts()), F.lit(""))


def city_key() -> Column:
    """City and country, for rows whose address says more than just those two."""
    parts = _address_parts()
    known = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    city, country = parts[1], parts[3]
    return F.when((known > 2) & city.isNotNull() & country.isNotNull(), joined(city, country))


def lookup_capped(df: DataFrame, max_records: int | None = None) -> DataFrame:
    """The rows to look up: those without a point, at most `max_records` in id order.

    A cap of any size is found by counting, so `df` should be a table.
    """
    rows = missing_coordinates(df)
    return first_rows(rows, max_records, "id") if max_records else rows


def lookup_coordinates(
    df: DataFrame,
    by_address: DataFrame,
    by_city: DataFrame,
    max_records: int | None = None,
    slot_rows: int = SLOT_ROWS,
    few_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Looked-up points of the rows that have none: id, point, level that matched, row count.

    Both gazetteers hold (key, latitude, longitude); of a repeated key the
    lowest point counts. Rows that are looked up alike are looked up once, with
    their number in `copies`; what is to be looked up is written and measured.
    Up to `few_bytes` of it are broadcast, and the gazetteers are only scanned.
    More is joined with the gazetteers by slots planned from the keys' counts,
    since addresses and cities repeat, some very often.
    """
    addressed = df.select(
        "id", "latitude", "longitude", address_key().alias("address_key"), city_key().alias("city_key")
    )
    wanted = lookup_capped(addressed, max_records)
    found, size = measured(
        wanted.groupBy("id", "address_key", "city_key").agg(F.count(F.lit(1)).alias("copies")), "wanted"
    )
    counted = found
    for table, level in ((by_address, "address"), (by_city, "city")):
        key = f"{level}_key"
        points_of = table.select(
            F.col("key").alias(key),
            F.col("latitude").alias(f"{level}_lat"),
            F.col("longitude").alias(f"{level}_lon"),
        ).dropna()
        points_of = first_by(points_of, [key], F.col(f"{level}_lat"), F.col(f"{level}_lon"))
        if size <= few_bytes:
            found = few_left_join(found, points_of, key)
        else:
            found = planned_left_join(found, points_of, key, slot_rows, keys_from=counted)
    on_address, on_city = F.col("address_lat").isNotNull(), F.col("city_lat").isNotNull()
    return found.select(
        "id",
        F.coalesce("address_lat", "city_lat").alias("found_latitude"),
        F.coalesce("address_lon", "city_lon").alias("found_longitude"),
        F.when(on_address, F.lit("address")).when(on_city, F.lit("city")).alias("found_level"),
        "copies",
    )


def one_hit_per_id(found: DataFrame) -> DataFrame:
    """The hits, one per id: an address match before a city match, then the lowest point."""
    hits = found.where(F.col("found_level").isNotNull()).drop("copies")
    return first_by(hits, ["id"], F.col("found_level"), F.col("found_latitude"), F.col("found_longitude"))


def _with_hits(df: DataFrame, hits: DataFrame, slot_rows: int, few_bytes: int) -> DataFrame:
    """Rows with the hit of their id.

    The hits are written and measured, and broadcast if they are few. Else only
    what can be concerned meets them: hits come from rows without a point, so
    those are joined with all of them; a row that has a point is concerned if
    it shares its id with one that has none. The ids alone tell which hits
    those are, and they are measured too, so the bulk of the listings stays.
    """
    hits, size = measured(hits, "hits")
    if size <= few_bytes:
        return df.join(F.broadcast(hits), "id", "left")
    without, having = missing_coordinates(df), df.where(points.present())
    shared, size = measured(hits.join(having.select("id").distinct(), "id", "left_semi"), "shared")
    if size <= few_bytes:
        concerned = having.join(F.broadcast(shared), "id", "left")
    else:
        concerned = planned_left_join(having, shared, "id", slot_rows)
    return planned_left_join(without, hits, "id", slot_rows).unionByName(concerned)


def apply_lookup(
    df: DataFrame,
    found: DataFrame,
    recompute_complete: bool = False,
    keep_level: bool = False,
    slot_rows: int = SLOT_ROWS,
    few_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with the point found for their id, where there is one.

    `df` and `found` should be tables, since both are read more than once.
    has_coordinates follows the new point. is_complete keeps its earlier value
    unless asked for, which is what downstream numbers are based on.
    `keep_level` adds geocoded_source, the level that matched.
    """
    hit = F.col("found_level").isNotNull()
    updated = (
        _with_hits(df, one_hit_per_id(found), slot_rows, few_bytes)
        .withColumns(
            {
                "latitude": F.when(hit, F.col("found_latitude")).otherwise(F.col("latitude")),
                "longitude": F.when(hit, F.col("found_longitude")).otherwise(F.col("longitude")),
            }
        )
        .withColumn("has_coordinates", points.present())
    )
    if recompute_complete:
        updated = updated.withColumn("is_complete", complete_flag())
    kept = list(df.columns)
    if keep_level:
        updated = updated.withColumnRenamed("found_level", "geocoded_source")
        kept.append("geocoded_source")
    return updated.select(*kept)


def lookup_coverage(before: DataFrame, after: DataFrame, found: DataFrame) -> DataFrame:
    """Coverage before and after a lookup, and how the lookup itself went.

    `attempted` is the number of rows looked up, so it respects a cap;
    success_rate is of all rows that missed a point, success_rate_attempted of
    those looked up.
    """
    total = F.count(F.lit(1)).alias("total_records")
    counts = after.agg(total, rows_where(points.present()).alias("coordinate_coverage_rows"))
    return lookup_coverage_of(before, counts, found)


def lookup_coverage_of(before: DataFrame, after_counts: DataFrame, found: DataFrame) -> DataFrame:
    """The same where rows and points after the lookup were counted elsewhere: total_records, coordinate_coverage_rows."""
    total = F.count(F.lit(1))
    parts = merge_parts(
        [],
        before.agg(total.alias("total_records"), rows_where(points.present()).alias("before_with")),
        after_counts.select(F.col("total_records").alias("after_total"), F.col("coordinate_coverage_rows").alias("after_with")),
        found.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("attempted"),
            F.coalesce(
                F.sum(F.when(F.col("found_level").isNotNull(), F.col("copies"))), F.lit(0)
            ).alias("successful"),
        ),
    )
    counts = parts.withColumns(
        {
            "before_missing": F.col("total_records") - F.col("before_with"),
            "after_missing": F.col("after_total") - F.col("after_with"),
            "new_coordinates": F.col("after_with") - F.col("before_with"),
            "failed": F.col("attempted") - F.col("successful"),
        }
    )
    zero = F.lit(0.0)
    return counts.select(
        "total_records",
        "before_with",
        "before_missing",
        F.coalesce(percent("before_with", "total_records"), zero).alias("before_percent"),
        "after_with",
        "after_missing",
        F.coalesce(percent("after_with", "after_total"), zero).alias("after_percent"),
        "new_coordinates",
        F.coalesce(percent("new_coordinates", "before_missing"), zero).alias("improvement_percent"),
        "attempted",
        "successful",
        "failed",
        F.coalesce(percent("successful", "before_missing"), zero).alias("success_rate"),
        F.coalesce(percent("successful", "attempted"), zero).alias("success_rate_attempted"),
    )


# ---- density ----------------------------------------------------------------


def density_grid(df: DataFrame) -> DataFrame:
    """Listings per cell of a tenth of a degree, with one place (city, state and country of one listing) of each.

    Listings are counted per place first; the first place of a cell, by name and
    with missing names last, is then taken from those few rows.
    """
    cell = ["lat_rounded", "lon_rounded"]
    names = ["city", "state", "country_normalized"]
    places = df.groupBy(points.cell("latitude").alias("lat_rounded"), points.cell("longitude").alias("lon_rounded"), *names)
    counted = places.agg(F.count("id").alias("_n"))
    order = [x for name in names for x in (F.col(name).isNull().alias(f"_no_{name}"), F.col(name))]
    first = counted.groupBy(*cell).agg(F.sum("_n").alias("count"), F.min(F.struct(*order)).alias("_first"))
    return first.select(*cell, "count", *[F.col("_first")[name].alias(name) for name in names])


def top_density_cells(df: DataFrame, n: int = 10) -> DataFrame:
    place = joined(F.coalesce("city", F.lit("N/A")), F.nullif("state", F.lit("")))
    return (
        density_grid(df)
        .orderBy(F.desc("count"), "lat_rounded", "lon_rounded")
        .limit(n)
        .select("lat_rounded", "lon_rounded", "count", place.alias("location"))
    )
