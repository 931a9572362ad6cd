"""Exact top-k search by inner product over a vector-approximation file.

Components become integers, floor(256 x). Equal vectors are merged first, with
the k + 1 smallest ids of each: no other of their ids can be among k results.
The approximation of a vector is one byte per component, its cell among CELLS
equal cells of that component's range over all vectors. A task scans the cells
for upper bounds of every query's scores, then reads exact vectors in the order
of these bounds until the k-th best score found so far is above all that are left.

Queries come in blocks and vectors in stripes; each stripe meets each block
once, and a task keeps k + 1 results a query. The stripes' results are merged by
query. Nothing is collected but the range of each component.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part, neither do rows with a null id; an id stands for one vector, the
smallest of its rows'; vectors of another length than the query's are no
candidates; ties go to the smaller id; products beyond 64 bits stay at the
limit. Columns other than the id and the vector are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewright.sources.files import staged

SCALE = 256
CELLS = 64
#: Vectors of a stripe and queries of a block, on average and at most.
STRIPE, QUERIES = 16_384, 1_024
#: Exact vectors read at a time, between two looks at the bounds.
READ = 16


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector of the rows that take part, one per id."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    kept = rows.where(F.col(id_col).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    return kept.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(whole).alias("vector"))


def dots(query: np.ndarray, rows: np.ndarray) -> list[int]:
    """Exact integer inner products of a query with rows."""
    if not rows.size:
        return [0] * len(rows)
    if np.abs(query).max().astype(float) * np.abs(rows).max().astype(float) * len(query) < 2.0**53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64).tolist()
    exact = (sum(int(a) * int(b) for a, b in zip(query, row)) for row in rows)
    return [max(-(2**63), min(2**63 - 1, x)) for x in exact]


def ranges(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per length of vectors: the lowest value of each component and the width of its cells."""
    each = vectors.select(F.size("vector").alias("length"), F.posexplode("vector").alias("at", "x"))
    found: dict[int, list] = {}
    for r in each.groupBy("length", "at").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect():
        found.setdefault(r["length"], []).append((r["at"], r["low"], max(1, -(-(r["high"] - r["low"] + 1) // CELLS))))
    return {n: np.array([x[1:] for x in sorted(own)], dtype=np.float64).T for n, own in found.items()}


def approximated(vectors: DataFrame, marks: dict[int, np.ndarray]) -> DataFrame:
    """The vectors with their approximations."""

    def run(batches):
        for batch in batches:
            cells = []
            for vector in batch.column(0).to_pylist():
                low, width = marks.get(len(vector), np.zeros((2, 0)))
                cell = np.floor((np.array(vector, dtype=np.float64) - low) / width)
                cells.append(np.clip(cell, 0, CELLS - 1).astype(np.uint8).tobytes())
            yield pa.record_batch([*batch.columns, pa.array(cells, pa.binary())], [*batch.schema.names, "cells"])

    return vectors.select("vector", "ids").mapInArrow(run, "vector array<long>, ids array<long>, cells binary")


class Best:
    """The `most` best (score, id) of each query of a block, found so far."""

    def __init__(self, queries: np.ndarray, most: int, marks: np.ndarray):
        self.queries, self.most = queries, most
        self.low, self.width = marks
        self.weights = queries.astype(np.float64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in queries]
        self.reads = 0

    def search(self, ids: list[list[int]], cells: np.ndarray, exact: np.ndarray) -> None:
        """Take in vectors: scan their cells, then read exact ones by falling upper bound."""
        corner = self.low + cells * self.width
        # A product of one component is highest in one of its cell's ends.
        upper = self.weights @ corner.T + (np.maximum(self.weights, 0) @ (self.width - 1))[:, None]
        largest = np.abs(corner).max(axis=0) if len(corner) else self.low
        upper += 1 + 1e-9 * (np.abs(self.weights) @ largest)[:, None]  # the bounds' own rounding
        for q, query in enumerate(self.queries):
            own, bounds = self.found[q], upper[q]
            near = np.arange(len(bounds)) if len(own) < self.most else np.flatnonzero(bounds >= own[-1][0])
            near = near[np.argsort(-bounds[near], kind="stable")]
            for at in range(0, len(near), READ):
                some = near[at : at + READ]
                if len(own) == self.most and bounds[some[0]] < own[-1][0]:
                    break
                self.reads += len(some)
                scores = dots(query, exact[some])
                own = own + [(s, i) for s, row in zip(scores, some.tolist()) for i in ids[row]]
                own.sort(key=lambda x: (-x[0], x[1]))
                del own[self.most :]
            self.found[q] = own


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), length)


def searched(rows: DataFrame, marks: dict[int, np.ndarray], most: int) -> DataFrame:
    """The best of every query in every stripe; rows of a key follow each other, queries (role 0) first."""

    def run(batches):
        key = best = asked = None

        def results():
            out = [(first, s, i) for first, own in zip(names, best.found) for s, i in own] if best else []
            columns = list(zip(*out)) or [()] * 3
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["first", "score", "vec_id"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(a, b - a)
                if (now := tuple(keys[:3, a].tolist())) != key:
                    if best:
                        yield results()
                    key, best, asked, names = now, None, [], []
                length = key[0]
                if keys[3, a] == 0:
                    asked.append(_matrix(part.column(4), length))
                    names += [x[0] for x in part.column(5).to_pylist()]
                    continue
                if not names:
                    continue
                if best is None:
                    best = Best(np.concatenate(asked), most, marks.get(length, np.zeros((2, 0))))
                cells = np.frombuffer(b"".join(part.column(6).to_pylist()), dtype=np.uint8).reshape(len(part), length)
                best.search(part.column(5).to_pylist(), cells, _matrix(part.column(4), length))
        if best:
            yield results()

    return rows.mapInArrow(run, "first long, score long, vec_id long")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    stripe: int = STRIPE, query_block: int = QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows of `vectors` for each row of `queries`.

    Rows of `vectors` with the query's own id are no candidates of it.
    """
    spark = vectors.sparkSession
    place = Window.partitionBy("vector").orderBy("vec_id")
    merged = integer_vectors(vectors, id_col, vector_col)
    merged = merged.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k + 1)
    merged = staged(merged.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vectors")
    asked = staged(integer_vectors(queries, id_col, vector_col), "asked")
    distinct = asked.groupBy("vector").agg(F.array(F.min("vec_id")).alias("ids"))

    n_vectors, n_queries = merged.count(), distinct.count()
    blocks = max(1, -(-n_queries * 2 // query_block))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(1, -(-n_vectors // stripe), min(-(-n_vectors // 256), -(-tasks // blocks)))
    marks = ranges(merged)

    def share(parts: int) -> Column:
        return F.pmod(F.xxhash64("vector"), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    length = F.size("vector").alias("length")
    dealt = approximated(merged, marks).select(
        length, every(blocks).alias("block"), share(stripes).alias("stripe"), F.lit(1).alias("role"), "vector", "ids", "cells"
    )
    asking = distinct.select(
        length, share(blocks).alias("block"), every(stripes).alias("stripe"), F.lit(0).alias("role"), "vector", "ids",
        F.lit(None).cast("binary").alias("cells"),
    )
    together = asking.unionByName(dealt).repartition("length", "block", "stripe")
    found = searched(together.sortWithinPartitions("length", "block", "stripe", "role"), marks, k + 1)

    best = Window.partitionBy("first").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n")
    # The best k + 1 rows for a vector serve every query that has it, each without itself.
    firsts = distinct.select("vector", F.col("ids")[0].alias("first"))
    members = asked.join(firsts, "vector").select(F.col("vec_id").alias("query_id"), "first")
    rows = members.join(found, "first").where(F.col("query_id") != F.col("vec_id"))
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")
