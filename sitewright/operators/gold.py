"""The seven reporting tables."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.functions.numbers import flagged, percent
from sitewright.schema import GOLD_SCHEMAS, REPORT_COLUMNS
from sitewright.sources.files import staged

FLAGS = {
    "with_coordinates": "has_coordinates",
    "with_contact": "has_contact",
    "complete_records": "is_complete",
}
DIMENSIONS = ["brewery_type_normalized", "country_normalized", "state", "city"]

# So many ids are few enough to broadcast.
FEW_IDS = 100_000


@dataclass(frozen=True)
class Rollup:
    """What one table groups by, counts distinct values of, and sums."""

    keys: list[str]
    order: list[str]
    distinct: dict[str, str] = field(default_factory=dict)
    flags: list[str] = field(default_factory=list)
    total: str = "brewery_count"
    needs: str | None = None


ROLLUPS = {
    "breweries_by_type": Rollup(
        ["brewery_type_normalized"], ["-brewery_count"], flags=list(FLAGS)
    ),
    "breweries_by_country": Rollup(
        ["country_normalized"],
        ["-brewery_count"],
        distinct={"distinct_types": "brewery_type_normalized"},
        flags=["with_coordinates", "with_contact"],
    ),
    "breweries_by_state": Rollup(
        ["country_normalized", "state"],
        ["-brewery_count"],
        distinct={"distinct_types": "brewery_type_normalized", "distinct_cities": "city"},
        needs="state",
    ),
    "breweries_by_type_and_country": Rollup(
        ["brewery_type_normalized", "country_normalized"],
        ["brewery_type_normalized", "-brewery_count"],
    ),
    "breweries_by_type_and_state": Rollup(
        ["brewery_type_normalized", "country_normalized", "state"],
        ["brewery_type_normalized", "country_normalized", "-brewery_count"],
        needs="state",
    ),
    "brewery_summary_statistics": Rollup(
        [],
        [],
        distinct={
            "distinct_types": "brewery_type_normalized",
            "distinct_countries": "country_normalized",
            "distinct_states": "state",
            "distinct_cities": "city",
        },
        flags=list(FLAGS),
        total="total_breweries",
    ),
}


@dataclass(frozen=True)
class Parts:
    """What tables are rolled up from. All but `ids` are small whatever the row count.

    `places` has rows and flag sums per combination of dimensions. Distinct ids
    are in `ids`, with the dimensions each occurs under; ids that occur under
    one combination only may instead be counted per combination in `settled`.
    """

    places: DataFrame
    ids: DataFrame
    settled: DataFrame | None = None


def place_totals(silver: DataFrame, keys: list[str]) -> DataFrame:
    return silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[flagged(flag).alias(name) for name, flag in FLAGS.items()]
    )


def id_places(silver: DataFrame, keys: list[str]) -> DataFrame:
    return silver.where(F.col("id").isNotNull()).select("id", *keys).distinct()


def roll_up(spec: Rollup, parts: Parts, run_at: datetime) -> DataFrame:
    """One table from the parts, in one last aggregate.

    The rows to add up are stacked: place totals, distinct ids, and one row per
    distinct value of a counted column. Only distinct ids need a shuffle that
    grows with the listings, and it carries nothing but the keys and the id; an
    aggregate with several distinct counts would instead copy every listing
    once per count.
    """

    def needed(df: DataFrame) -> DataFrame:
        return df.where(F.col(spec.needs).isNotNull()) if spec.needs else df

    keys, places = spec.keys, needed(parts.places)
    each_id = needed(parts.ids).select("id", *keys).distinct()
    stacked = [
        places.select(*keys, "rows", *spec.flags),
        each_id.select(*keys, F.lit(1).cast("long").alias("ids")),
    ]
    if parts.settled is not None:
        stacked.append(needed(parts.settled).select(*keys, "ids"))
    if spec.distinct:
        pairs = [
            F.struct(F.lit(name).alias("counted"), F.col(column).alias("value"))
            for name, column in spec.distinct.items()
        ]
        values = places.select(*keys, F.inline(F.array(*pairs))).where("value IS NOT NULL")
        stacked.append(values.distinct().drop("value"))
    rows = stacked[0]
    for more in stacked[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    # A sum over no rows is null, which is right for flags but not for counts.
    return rows.groupBy(*keys).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias(spec.total),
        F.coalesce(F.sum("ids"), F.lit(0)).alias("unique_breweries"),
        *[F.count_if(F.col("counted") == name).alias(name) for name in spec.distinct],
        *[F.sum(name).alias(name) for name in spec.flags],
        F.lit(run_at.isoformat()).alias("aggregation_timestamp"),
    )


def _finish(name: str, table: DataFrame) -> DataFrame:
    if name == "breweries_by_type":
        table = table.withColumn("completeness_rate", percent("complete_records", "brewery_count"))
    shaped = table.select(*GOLD_SCHEMAS[name].names)
    spec = ROLLUPS[name]
    if not spec.order:
        return shaped
    order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in spec.order]
    return shaped.orderBy(*order, *spec.keys)


def gold_table(name: str, silver: DataFrame, run_at: datetime) -> DataFrame:
    """One reporting table straight from the curated listings."""
    if name == "breweries":
        return gold_entity_table(silver)
    spec = ROLLUPS[name]
    keys = list(dict.fromkeys([*spec.keys, *spec.distinct.values()]))
    parts = Parts(place_totals(silver, keys), id_places(silver, spec.keys))
    return _finish(name, roll_up(spec, parts, run_at))


def gold_entity_table(silver: DataFrame) -> DataFrame:
    """The listings as reports read them: 21 columns in a fixed order."""
    return silver.select(*REPORT_COLUMNS)


def shared_parts(silver: DataFrame) -> Parts:
    """The parts of all tables at once, written aside.

    Nearly every id occurs under one combination of dimensions. Such ids are
    counted once per combination, and only the others are left to be counted
    for each table. The others' ids are broadcast if they are few.
    """
    pairs = staged(id_places(silver, DIMENSIONS[:3]), "pairs")
    with ThreadPoolExecutor(3) as pool:
        places = pool.submit(staged, place_totals(silver, DIMENSIONS), "places")
        times = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        moving = staged(times.where("n > 1").select("id"), "moving")
        side = F.broadcast(moving) if moving.count() <= FEW_IDS else moving
        ids = pool.submit(staged, pairs.join(side, "id", "left_semi"), "ids")
        alone = pairs.join(side, "id", "left_anti").groupBy(*DIMENSIONS[:3])
        settled = pool.submit(staged, alone.agg(F.count(F.lit(1)).alias("ids")), "settled")
        return Parts(places.result(), ids.result(), settled.result())


def gold_tables(silver: DataFrame, parts: Parts, run_at: datetime) -> dict[str, DataFrame]:
    """All seven tables from the curated listings and their shared parts."""
    tables = {name: _finish(name, roll_up(spec, parts, run_at)) for name, spec in ROLLUPS.items()}
    return {"breweries": gold_entity_table(silver), **tables}
