"""Rows by their place in an order, without one task that sees all rows before it.

`PageIndex` is for many reads of one table: its rows are written once in ordered
range partitions, with the number of rows of each, so that a page reads only the
partitions that hold it. `first_rows` is for one cut: the cut-off row is found by
counting, and the result is a filter.
"""

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.sources.files import fresh_path

# Where a row stands within its part; parts are numbered in order.
PART, PLACE = "_part", "_place"


def full_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The order with all other columns behind it, so that only equal rows tie."""
    return [*order, *[c for c in df.columns if c not in order]]


# ---- many pages of one table --------------------------------------------------


@dataclass(frozen=True)
class PageIndex:
    """A table in order: the path of its parts, where each begins, and its number of rows.

    `parts` and `starts` have one entry per written part, not per row.
    """

    spark: SparkSession
    path: str
    columns: list[str]
    schema: str
    parts: list[int]
    starts: list[int]
    rows: int

    def slice(self, start: int, stop: int) -> DataFrame:
        """The rows from `start` up to `stop`, counted from 0; parts that hold none of them are not read."""
        start, stop = max(start, 0), min(stop, self.rows)
        table = self.spark.read.schema(f"{self.schema}, {PLACE} BIGINT, {PART} INT").parquet(self.path)
        if start >= stop:
            return table.where(F.lit(False)).select(*self.columns)
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, stop - 1) - 1
        held = table.where((F.col(PART) >= self.parts[first]) & (F.col(PART) <= self.parts[last]))
        below = (F.col(PART) > self.parts[first]) | (F.col(PLACE) >= start - self.starts[first])
        above = (F.col(PART) < self.parts[last]) | (F.col(PLACE) < stop - self.starts[last])
        return held.where(below & above)

    def page(self, page: int, per_page: int) -> DataFrame:
        """Page `page`, counted from 1, in order."""
        start = (max(page, 1) - 1) * per_page
        return self.slice(start, start + per_page).sort(PART, PLACE).select(*self.columns)

    def head(self, n: int) -> DataFrame:
        """The first n rows, in no order."""
        return self.slice(0, n).select(*self.columns)


def page_index(
    df: DataFrame, order: Sequence[str] = ("id",), path: str | None = None, parts: int | None = None
) -> PageIndex:
    """Write the rows in order and note how many there are in each part; their number is left to their size unless given.

    All columns break ties. Ranges are cut by a running number last, so that
    rows that are equal, however many, are dealt over parts; which of them goes
    where makes no difference. The table is read twice here, once for a sample
    of the order, and never again.
    """
    spark, path = df.sparkSession, path or fresh_path(df.sparkSession, "pages")
    keys = full_order(df, order)
    numbered = df.withColumn(PLACE, F.monotonically_increasing_id())
    ranges = numbered.repartitionByRange(*([parts] if parts else []), *keys, PLACE)
    ranges = ranges.drop(PLACE).withColumn(PART, F.spark_partition_id())
    placed = ranges.sortWithinPartitions(PART, *keys).withColumn(
        PLACE, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    )
    placed.write.partitionBy(PART).parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    written = spark.read.schema(f"{schema}, {PLACE} BIGINT, {PART} INT").parquet(path)
    counts = sorted((row[0], row[1]) for row in written.groupBy(PART).agg(F.count(F.lit(1))).collect())
    starts, total = [], 0
    for _, rows in counts:
        starts.append(total)
        total += rows
    return PageIndex(spark, path, df.columns, schema, [part for part, _ in counts], starts, total)


# ---- one cut --------------------------------------------------------------------

# Rows between two bounds that are few enough to be sorted; bounds of one round; rows drawn to find them.
SORTED_ROWS, BOUNDS, DRAWN = 10_000, 31, 4_000


def _key(columns: Sequence[str], row: Sequence | None = None, df: DataFrame | None = None) -> Column:
    """The order's columns as one value, or that of a given row."""
    if row is None:
        return F.struct(*[F.col(c) for c in columns])
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(columns, row)])


def _bucket(key: Column, bounds: list[Column], low: int, high: int) -> Column:
    """How many of bounds low to high - 1 lie below the key, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key > bounds[middle], _bucket(key, bounds, middle + 1, high)).otherwise(_bucket(key, bounds, low, middle))


def nth_row(df: DataFrame, n: int, order: Sequence[str]) -> tuple[Sequence, int] | None:
    """The n-th row in order, counted from 1, and how many rows are before its first equal; None if there are fewer rows.

    Each round draws a few rows of what is left as bounds, counts the rows
    between them, and keeps the stretch in which the n-th row lies. It ends when
    that holds few rows, or none but equal ones. Nothing is shuffled but counts.
    """
    left, before = df.select(*order), 0
    rows = left.count()
    if rows < n:
        return None
    key, seed = _key(order), 0
    while rows > SORTED_ROWS:
        seed += 1
        drawn = left.sample(min(1.0, DRAWN / rows), seed).sort(*order).limit(4 * DRAWN).collect()
        picked = list(dict.fromkeys(drawn[(i + 1) * len(drawn) // (BOUNDS + 1)] for i in range(BOUNDS))) if drawn else []
        if not picked:
            continue
        bounds = [_key(order, row, df) for row in picked]
        counts = dict(left.groupBy(_bucket(key, bounds, 0, len(bounds))).agg(F.count(F.lit(1))).collect())
        at = 0
        while before + counts.get(at, 0) < n:
            before += counts.get(at, 0)
            at += 1
        rows = counts[at]
        if at < len(bounds):
            # The stretch ends with its bound; is it all rows like that?
            same = left.where(key == bounds[at]).count()
            if before + rows - same < n:
                return picked[at], before + rows - same
            left, rows = left.where(key < bounds[at]), rows - same
        if at > 0:
            left = left.where(key > bounds[at - 1])
    row = left.sort(*order).limit(n - before).collect()[-1]
    return row, before + left.where(key < _key(order, row, df)).count()


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The n rows that sort first, all columns breaking ties; `df` should be a table, as it is read several times.

    The result is a filter on the rows before the n-th one, and as many
    copies of that one as fit, so that no task takes more than its share.
    """
    keys = full_order(df, order)
    found = nth_row(df, n, keys) if n > 0 else None
    if found is None:
        return df if n > 0 else df.where(F.lit(False))
    row, before = found
    last = df.sparkSession.range(n - before).select(
        *[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(keys, row)]
    )
    # By the first column alone the scan can skip what lies behind.
    near = F.lit(True) if row[0] is None else F.col(keys[0]).isNull() | (F.col(keys[0]) <= F.lit(row[0]))
    return df.where(near & (_key(keys) < _key(keys, row, df))).unionByName(last)
