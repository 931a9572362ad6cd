"""What the operators of this subpackage share."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.sources.files import delete, fresh_path

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text, none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def map_texts(
    df: DataFrame, make: Callable[[], Callable], schema: str, chunk_bytes: int = 2_000_000, text_at: int = 1
) -> DataFrame:
    """Map rows in Arrow batches, in chunks of about `chunk_bytes` bytes of text.

    `make()` is called once per task and returns a function from a pyarrow
    table to a pyarrow record batch or table. A chunk always has whole rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in in_chunks(batch, chunk_bytes, text_at):
                out = work(piece)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def in_chunks(batch: pa.RecordBatch, chunk_bytes: int, text_at: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about `chunk_bytes` of text each, one row at least."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > chunk_bytes:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    yield batch.slice(start)


class Scratch:
    """Written tables that are dropped together when the block ends, and one by one before that if told so."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base, self.tables = spark, fresh_path(spark, label), 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.base)

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        """The rows by way of a table in the shared folder."""
        self.tables += 1
        path = f"{self.base}/{self.tables:03d}-{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
