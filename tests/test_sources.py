import glob
import json
from datetime import datetime

import pytest
from conftest import RUN_AT, by, one
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_clean import COMPLETE, ENGLISH, PADDED

from sitewright.operators import metrics, rules, select
from sitewright.plans.curate import curated, transform_listings
from sitewright.sources import keyed, landing, tables, versions
from sitewright.streaming.incremental import incremental_gold, incremental_silver, read_incremental

LATER = datetime(2026, 2, 3, 1, 0)


def test_landed_layout(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    landing.land_batch(listings(COMPLETE, PADDED), base, RUN_AT)
    files = glob.glob(f"{base}/year=2026/month=01/day=21/*.json")
    lines = [json.loads(line) for name in files for line in open(name)]
    assert len(lines) == 2
    # Nulls are written, not left out.
    assert {len(line) for line in lines} == {16}
    assert landing.read_landed(spark, base).count() == 2


def test_append_and_replace(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    first = one(landing.ingest(listings(COMPLETE, PADDED), base, RUN_AT))
    second = one(landing.ingest(listings(ENGLISH), base, LATER))
    assert (first["status"], first["total_records"], first["pages_processed"]) == ("success", 2, 1)
    assert first["file_size_bytes"] > 0 and first["partition_date"]["day"] == 21
    assert first["ingestion_id"] != second["ingestion_id"]
    manifest = landing.read_manifest(spark, landing.manifest_path(base))
    listed = landing.list_ingestions(manifest).collect()
    assert [r["total_records"] for r in listed] == [1, 2]
    assert len(landing.list_ingestions(manifest, 1).collect()) == 1
    assert one(landing.latest_ingestion(manifest))["ingestion_id"] == second["ingestion_id"]
    assert landing.read_landed_listings(spark, base).count() == 3
    for date, expected in (
        ({"year": 2026, "month": 1, "day": 21}, 2), ({"month": 2}, 1), ({"day": 4}, 0), ({}, 3), (None, 3),
    ):
        assert landing.read_landed_listings(spark, base, date).count() == expected, date
    landing.ingest(listings(ENGLISH), base, LATER, clean_before_run=True)
    assert landing.read_landed_listings(spark, base).count() == 1
    assert landing.read_manifest(spark, landing.manifest_path(base)).count() == 1


def test_empty_batch_is_a_warning_and_lands_nothing(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    row = one(landing.ingest(listings(), base, RUN_AT))
    assert (row["status"], row["total_records"], row["pages_processed"]) == ("warning", 0, 0)
    assert not (tmp_path / "bronze").exists()
    assert landing.latest_ingestion(landing.read_manifest(spark, landing.manifest_path(base))).collect() == []


def test_one_ingestion_of_a_day_is_read_alone(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    paths = [
        one(landing.ingest(listings(*rows), base, RUN_AT))["file_path"]
        for rows in ((COMPLETE, PADDED), (ENGLISH,), (ENGLISH,))
    ]
    # The same batch at the same time is a repeated run.
    assert paths[0] != paths[1] == paths[2]
    assert [landing.read_batch(spark, path).count() for path in paths] == [2, 1, 1]
    assert landing.read_landed_listings(spark, base, {"day": 21}).count() == 3
    stream = incremental_silver(spark, base, str(tmp_path / "silver"), str(tmp_path / "progress"), RUN_AT)
    stream.awaitTermination()
    assert read_incremental(spark, str(tmp_path / "silver")).count() == 3
    # It is listed once.
    assert landing.read_manifest(spark, landing.manifest_path(base)).count() == 2


def test_a_repeated_ingestion_leaves_its_files_alone(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    path = one(landing.ingest(listings(COMPLETE, PADDED), base, RUN_AT))["file_path"]
    before = sorted(glob.glob(f"{path}/*"))
    again = one(landing.ingest(listings(PADDED, COMPLETE), base, RUN_AT))
    assert again["file_path"] == path and again["total_records"] == 2 and again["file_size_bytes"] > 0
    assert sorted(glob.glob(f"{path}/*")) == before


def broken(df):
    """The rows, of which the last one read fails."""
    return df.withColumn("name", F.when(F.col("id") == "n-19", F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("name")))


def test_a_killed_write_leaves_the_old_table(spark, listings, tmp_path):
    good, bad = listings(COMPLETE, PADDED), broken(listings(COMPLETE, ENGLISH).repartition(4))
    silver, gold, base = str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "bronze")
    tables.write_silver(curated(good, RUN_AT), silver)
    tables.write_gold(good, gold, "t")
    landing.land_batch(good, base, RUN_AT)
    for write in (
        lambda: tables.write_silver(curated(bad, RUN_AT), silver),
        lambda: tables.write_gold(bad, gold, "t"),
        lambda: landing.land_batch(bad, base, RUN_AT, clean_before_run=True),
        lambda: tables.write_gold(bad, gold, "never"),
    ):
        with pytest.raises(Exception, match="killed"):
            write()
    assert tables.read_silver(spark, silver).count() == 2
    assert tables.read_gold(spark, gold, "t").count() == 2 and tables.list_gold(spark, gold) == ["t"]
    assert landing.read_landed_listings(spark, base).count() == 2
    with pytest.raises(ValueError):
        tables.read_gold(spark, gold, "never")


def test_old_versions_go_after_the_one_before(spark, listings, tmp_path):
    base, path = str(tmp_path / "gold"), str(tmp_path / "gold" / "t")
    listings(COMPLETE).write.parquet(path)  # a plain table of an earlier time
    for n, rows in enumerate(((COMPLETE, PADDED), (ENGLISH,), (COMPLETE, PADDED, ENGLISH)), 1):
        assert tables.read_gold(spark, base, "t").count() == {1: 1, 2: 2, 3: 1}[n]
        tables.write_gold(listings(*rows), base, "t")
    assert tables.read_gold(spark, base, "t").count() == 3
    kept = sorted(name.split("/")[-1][:8] for name in glob.glob(f"{path}/*") if "_current" not in name)
    assert kept == ["v-000002", "v-000003"]
    with pytest.raises(ValueError, match="neither"):
        tables.write_gold(listings(), base, "t", mode="ignore")


def test_failed_ingestion_is_recorded(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    landing.ingest(listings(COMPLETE), base, RUN_AT)
    broken = listings(ENGLISH).withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    row = one(landing.ingest(broken, base, LATER, clean_before_run=True))
    assert (row["status"], row["total_records"], row["file_size_bytes"]) == ("failed", 0, 0)
    manifest = landing.read_manifest(spark, landing.manifest_path(base))
    assert [r["status"] for r in landing.list_ingestions(manifest).collect()] == ["failed", "success"]
    # What was there before stays.
    assert landing.read_landed_listings(spark, base).count() == 1


def test_array_files_and_quoted_coordinates(spark, tmp_path):
    day = tmp_path / "bronze" / "year=2026" / "month=01" / "day=21"
    day.mkdir(parents=True)
    rows = [
        {"id": "1", "name": "A", "longitude": "-122.4", "latitude": "37.7"},
        {"id": "2", "name": "B", "longitude": -97.7, "latitude": 30.2},
    ]
    (day / "batch.json").write_text(json.dumps(rows, indent=2))
    base = str(tmp_path / "bronze")
    got = by(landing.read_landed_listings(spark, base, arrays=True), "id")
    assert (got["1"]["longitude"], got["2"]["latitude"]) == (-122.4, 30.2)
    one_file = by(landing.read_batch(spark, str(day / "batch.json"), arrays=True), "id")
    assert one_file["1"]["latitude"] == 37.7 and one_file["2"]["longitude"] == -97.7


def test_date_filter_prunes_folders(spark, listings, tmp_path):
    base = str(tmp_path / "bronze")
    landing.land_batch(listings(COMPLETE), base, RUN_AT)
    landing.land_batch(listings(PADDED), base, LATER)
    df = landing.read_landed_listings(spark, base, {"month": 2})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert len(df.inputFiles()) == 1 or df.count() == 1


def test_fingerprint_ignores_order_and_layout(listings):
    def of(df):
        return one(landing.batch_fingerprint(df))["fingerprint"]

    base = of(listings(COMPLETE, PADDED))
    assert len(base) == 8
    assert base == of(listings(PADDED, COMPLETE)) == of(listings(COMPLETE, PADDED).repartition(3))
    assert base == of(listings(COMPLETE, PADDED).select("street", *[c for c in listings().columns if c != "street"]))
    assert base != of(listings(COMPLETE)) and base != of(listings(COMPLETE, PADDED, PADDED))
    # A blank is not a null.
    assert of(listings({"id": "1", "city": ""})) != of(listings({"id": "1"}))
    assert of(listings()) == "00000000"


def test_union_fills_missing_columns(spark):
    a, b = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2 AS x, 'b' AS y")
    assert landing.union_batches(a, b, b).count() == 3
    assert by(landing.union_batches(a, b), "x")[1]["y"] is None


def test_silver_roundtrip_and_filters(spark, listings, tmp_path):
    path = str(tmp_path / "silver")
    df = curated(listings(COMPLETE, PADDED, ENGLISH), RUN_AT)
    assert len(df.columns) == 28
    tables.write_silver(df, path)
    assert glob.glob(f"{versions.current(spark, path)}/country_normalized=United States/state=Idaho")
    back = tables.read_silver(spark, path)
    assert sorted(back.columns) == sorted(df.columns)
    # A row without a state comes back without one.
    assert by(back, "id")["n-19"]["state"] is None
    us = tables.read_silver(spark, path, {"country_normalized": "United States"})
    assert us.count() == 2
    plan = us._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country_normalized" in plan
    only = tables.read_silver(spark, path, {"country_normalized": "United States", "state": "Idaho"})
    assert one(only)["id"] == "n-18"
    stats = metrics.silver_statistics(back).where("dimension = 'by_country'")
    assert by(stats, "value")["United States"]["count"] == 2


def test_new_columns_and_other_partitions(spark, listings, tmp_path):
    path = str(tmp_path / "silver")
    df = curated(listings(COMPLETE), RUN_AT)
    tables.write_silver(df, path, partition_by=["processing_year"])
    assert glob.glob(f"{versions.current(spark, path)}/processing_year=2026")
    extra = curated(listings(ENGLISH), RUN_AT).withColumn("extra", F.lit(1))
    tables.write_silver(extra, path, partition_by=["processing_year"], mode="append")
    for kwargs in ({"merge_schema": True}, {"extra": StructType().add("extra", "integer")}):
        rows = by(tables.read_silver(spark, path, **kwargs), "id")
        assert rows["n-17"]["extra"] is None and rows["n-19"]["extra"] == 1
    assert "extra" not in tables.read_silver(spark, path).columns


def test_states_that_look_like_numbers_stay_text(spark, listings, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(curated(listings({**COMPLETE, "state": "01"}), RUN_AT), path)
    assert one(tables.read_silver(spark, path, {"state": "01"}))["state"] == "01"


def test_transform_reports_quality(spark, listings, tmp_path):
    path = str(tmp_path / "silver")
    made = transform_listings(spark, listings(COMPLETE, PADDED, ENGLISH), path, RUN_AT)
    row = one(made.quality)
    assert made.coverage is None
    # What was observed in the write is what the written table says.
    silver = tables.read_silver(spark, path)
    for name, value in one(metrics.silver_quality_metrics(silver)).asDict().items():
        assert row[name] == value, name
    assert (row["countries"], row["types"]) == (2, 2) or row["countries"] == 2
    assert one(made.rates) == one(metrics.enrichment_rates(silver))
    assert made.rules.collect() == rules.validate_silver(silver).collect()
    assert (row["total_records"], row["unique_ids"], row["complete_records"]) == (3, 3, 1)
    assert row["coordinate_coverage"] == 66.67
    by_city = spark.createDataFrame(
        [("Boise, United States", 43.6, -116.2)], "key string, latitude double, longitude double"
    )
    made = transform_listings(
        spark, listings(COMPLETE, PADDED, ENGLISH), path, RUN_AT, (by_city.limit(0), by_city)
    )
    assert one(made.quality)["with_coordinates"] == 3
    assert (one(made.coverage)["before_with"], one(made.coverage)["after_with"]) == (2, 3)
    assert by(tables.read_silver(spark, path), "id")["n-18"]["coordinates_valid"]


def test_one_row_per_id_if_asked_for(spark, listings, tmp_path):
    path = str(tmp_path / "silver")
    twice = listings(COMPLETE, {**COMPLETE, "latitude": None, "longitude": None, "name": "A"}, PADDED, {"name": "no id"}, {"name": "no id"})
    made = transform_listings(spark, twice, path, RUN_AT, unique_ids=True)
    assert one(made.quality)["total_records"] == 4
    kept = tables.read_silver(spark, path).where("id = 'n-17'")
    assert one(kept)["is_complete"]


def test_csv_has_a_header(spark, listings, tmp_path):
    path = str(tmp_path / "csv")
    quoted = {**COMPLETE, "name": 'The "Best", Inc'}
    tables.export_csv(listings(quoted).select("id", "name", "state_province").coalesce(1), path)
    text = "".join(open(f).read() for f in glob.glob(f"{path}/*.csv"))
    assert text == 'id,name,state_province\nn-17,"The ""Best"", Inc",\n'


# ---- the stream -------------------------------------------------------------


def test_stream_takes_each_landed_file_once(spark, listings, tmp_path):
    base, out, progress = (str(tmp_path / n) for n in ("bronze", "silver", "progress"))

    def run():
        incremental_silver(spark, base, out, progress, RUN_AT).awaitTermination()
        return read_incremental(spark, out)

    landing.land_batch(listings(COMPLETE, PADDED), base, RUN_AT)
    assert run().count() == 2
    assert run().count() == 2
    landing.land_batch(listings(ENGLISH), base, LATER)
    rows = by(run(), "id")
    assert len(rows) == 3 and rows["n-19"]["country_normalized"] == "United Kingdom"
    assert rows["n-17"]["coordinates_valid"]
    only = read_incremental(spark, out, {"country_normalized": "United Kingdom"})
    assert one(only)["id"] == "n-19"
    assert "PartitionFilters: [isnotnull(country_normalized" in only._jdf.queryExecution().executedPlan().toString()


def test_a_batch_landed_again_replaces_its_rows(spark, listings, tmp_path):
    base, out, progress = (str(tmp_path / n) for n in ("bronze", "silver", "progress"))
    many = listings(*[{**COMPLETE, "id": f"m-{i}", "state": f"S{i % 4}"} for i in range(60)])

    def run(progress=progress):
        incremental_silver(spark, base, out, progress, RUN_AT).awaitTermination()
        by_state = incremental_gold(spark, out, RUN_AT)["breweries_by_state"]
        return read_incremental(spark, out).count(), sorted((r["state"], r["brewery_count"], r["unique_breweries"]) for r in by_state.collect())

    path = one(landing.ingest(many, base, RUN_AT))["file_path"]
    first = run()
    assert first == (60, [(f"S{i}", 15, 15) for i in range(4)])
    many.repartition(3).write.mode("overwrite").json(path)  # the same rows in other files
    assert run() == first
    assert run(str(tmp_path / "anew")) == first  # also for a stream that begins again
    many.where("state <> 'S1'").write.mode("overwrite").json(path)  # and fewer rows in them
    assert run() == (45, [(f"S{i}", 15, 15) for i in (0, 2, 3)])
    landing.ingest(listings({**COMPLETE, "id": "m-0", "state": "S0"}, {**COMPLETE, "id": "new", "state": "S1"}), base, LATER)
    assert run() == (47, [("S0", 16, 15), ("S1", 1, 1), ("S2", 15, 15), ("S3", 15, 15)])
    assert keyed.drop_replaced(spark, out) == 3
    assert run() == (47, [("S0", 16, 15), ("S1", 1, 1), ("S2", 15, 15), ("S3", 15, 15)])


def test_a_killed_take_is_not_seen(spark, listings, tmp_path):
    path = str(tmp_path / "t")
    keyed.put(listings(COMPLETE).withColumn("ingestion", F.lit("a")), path)
    with pytest.raises(Exception, match="killed"):
        keyed.put(broken(listings(COMPLETE, ENGLISH)).withColumn("ingestion", F.lit("a")), path)
    (tmp_path / "t" / "take=half" / "ingestion=a").mkdir(parents=True)
    listings(PADDED).write.mode("append").parquet(f"{path}/take=half/ingestion=a")
    assert one(keyed.read(spark, path, listings().schema))["id"] == "n-17"
    gone = spark.createDataFrame([("a",)], "ingestion string")
    keyed.put(listings().withColumn("ingestion", F.lit("a")), path, keys=gone)
    assert keyed.read(spark, path, listings().schema).count() == 0


# ---- selection --------------------------------------------------------------


def test_pages_put_together_are_the_table(spark):
    df = spark.range(23).select((F.col("id") % 7).cast("string").alias("id"), F.col("id").alias("n"))
    pages = [select.page_slice(df, p, 5).collect() for p in range(1, 7)]
    assert [len(p) for p in pages] == [5, 5, 5, 5, 3, 0]
    assert sorted(r["n"] for page in pages for r in page) == list(range(23))
    assert select.first_pages(df, 2, 5).count() == 10
    assert select.first_pages(df, None, 5).count() == 23


def test_search(listings):
    df = listings(COMPLETE, PADDED, ENGLISH, {"id": "0"})
    assert [r["id"] for r in select.search_sites(df, "WHITBY").collect()] == ["n-19"]
    assert [r["id"] for r in select.search_sites(df, "o", 2).collect()] == ["n-17", "n-18"]
    assert one(select.lookup_by_id(df, "n-18"))["city"] == "Boise"
    assert one(select.filter_by_type(df, "brewpub"))["id"] == "n-17"


@pytest.mark.parametrize("country,kind,expected", [
    ("All", "All", {"n-17", "n-19"}), ("United Kingdom", "All", {"n-19"}),
    ("All", "brewpub", {"n-17"}), ("United Kingdom", "brewpub", set()),
])
def test_map_selection(listings, country, kind, expected):
    df = curated(listings(COMPLETE, PADDED, ENGLISH), RUN_AT)
    rows = select.selected_rows(select.map_rows(df), country, kind).collect()
    assert {r["id"] for r in rows} == expected
    # Without the checks, a point is enough.
    assert select.map_rows(df.drop("coordinates_valid")).count() == 2
