"""Pages and caps: the same rows as a sort with offset and limit, without its one task."""

import pytest
from pyspark.sql import functions as F

from sitewright.operators import locate, positions, select
from sitewright.operators.positions import first_rows, nth_row, page_index


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(positions, "SORTED_ROWS", 40)
    monkeypatch.setattr(positions, "DRAWN", 60)
    monkeypatch.setattr(positions, "BOUNDS", 5)


def table(spark, n=5000):
    """Ties, nulls and not-a-numbers; a third of the rows are equal."""
    i = F.col("id")
    a = F.when(i % 3 == 0, "same").when(i % 11 == 0, None).otherwise((i * 7919 % 97).cast("string"))
    b = F.when(i % 3 == 0, 1.5).when(i % 13 == 0, float("nan")).otherwise((i % 50).cast("double"))
    return spark.range(0, n, 1, 16).select(a.alias("id"), b.alias("b"))


def plain(df, start, stop):
    return [str(tuple(r)) for r in df.orderBy("id", "b").collect()[start:stop]]


@pytest.mark.parametrize("n", [1, 17, 455, 456, 1500, 2500, 3333, 4999, 5000, 6000])
def test_first_rows_are_those_of_a_sort(spark, few, n):
    df = table(spark)
    got = sorted(str(tuple(r)) for r in first_rows(df, n, "id").collect())
    assert got == sorted(plain(df, 0, n))


def test_first_rows_of_nothing(spark, few):
    df = table(spark)
    assert first_rows(df, 0, "id").count() == 0
    assert first_rows(df.limit(0), 5, "id").count() == 0
    assert nth_row(df, 5001, ["id", "b"]) is None


def test_half_a_table_passes_no_single_task(spark, few):
    df = table(spark)
    cut = first_rows(df, 2500, "id")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "Exchange" not in plan and "Window" not in plan
    sizes = [r["n"] for r in cut.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 4 * sorted(sizes)[len(sizes) // 2]


def test_a_capped_lookup_takes_half_of_what_misses_a_point(spark, listings, few):
    rows = [{"id": f"{i % 200:03d}", "name": str(i), **({"latitude": 1.0, "longitude": 2.0} if i % 4 == 0 else {})} for i in range(600)]
    df = listings(*rows)
    missing = sorted((r["id"], r["name"]) for r in select.missing_coordinates(df).collect())
    got = locate.lookup_capped(df, 225)
    assert sorted((r["id"], r["name"]) for r in got.collect()) == missing[:225]


@pytest.mark.parametrize("per_page", [7, 100, 1700, 9000])
def test_pages_are_slices_of_a_sort(spark, per_page):
    df = table(spark)
    index = page_index(df, parts=6)
    assert index.rows == 5000 and len(index.parts) > 1 and index.starts[0] == 0
    for page in (1, 2, -(-5000 // per_page) // 2 + 1, -(-5000 // per_page), -(-5000 // per_page) + 1):
        got = [str(tuple(r)) for r in index.page(page, per_page).collect()]
        assert got == plain(df, (page - 1) * per_page, page * per_page)
    assert sorted(str(tuple(r)) for r in index.head(1234).collect()) == sorted(plain(df, 0, 1234))


def test_a_deep_page_reads_only_its_parts(spark):
    index = page_index(spark.range(0, 200_000, 1, 8).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("n")), parts=8)
    page = index.page(40_000, 4)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "SinglePartition" not in plan
    assert "PartitionFilters: [isnotnull(_part" in plan and "_place" in plan
    assert page.count() == 4
    # The parts that hold no row of the page are not opened.
    parts = {r[0] for r in page.select(F.regexp_extract(F.input_file_name(), "_part=([0-9]+)", 1)).collect()}
    assert len(parts) <= 2 < len(index.parts)


def test_two_pages_read_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).select(F.col("id").cast("string").alias("id")).write.parquet(path)
    index = page_index(spark.read.parquet(path))
    for page in (1, 9):
        plan = index.page(page, 50)._jdf.queryExecution().executedPlan().toString()
        assert path not in plan and index.path in plan
    assert [r["id"] for r in select.page_slice(spark.read.parquet(path), 2, 3, index).collect()] == ["100", "101", "102"]


def test_equal_rows_are_dealt_over_parts(spark):
    same = spark.range(0, 50_000, 1, 8).select(F.lit("x").alias("id"), F.lit(1).alias("n"))
    index = page_index(same, parts=6)
    sizes = [b - a for a, b in zip(index.starts, [*index.starts[1:], index.rows])]
    assert len(sizes) > 1 and max(sizes) < 0.6 * index.rows
    assert index.page(7, 100).count() == 100


def test_pages_of_an_empty_table(spark):
    index = page_index(table(spark).limit(0))
    assert index.rows == 0 and index.page(1, 10).collect() == [] and index.head(5).count() == 0
