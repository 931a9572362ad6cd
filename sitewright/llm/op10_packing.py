"""Packing of whole documents into sequences of a fixed length, planned on a histogram of lengths.

A document is its token ids and an end id. One that is longer than a sequence
is cut into pieces of the sequence's length, of which the first may be shorter.
Best-fit decreasing then runs on the driver over the counts of the at most
`size` lengths: bins with one residual and a common history are a group, and a
whole group takes pieces at once. A group that took what fits of one length has
less than half of its residual left by the next, so that it takes part log2(size)
times at most, and every length adds three groups at most: the plan has a bound
that does not depend on the documents. Pieces take the planned slots by their
rank within their length. That rank is the piece's number in its task plus what
earlier tasks have, so that no task sees all pieces of a length.

Defined results: the file's added tokens, such as <|endoftext|>, have their own
ids wherever a text holds them; a null or empty text is the end id alone; a null doc_id stays
null; repeated rows are packed each; no documents give no pieces; columns other
than doc_id and text are ignored.
"""

import bisect
import functools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import map_texts
from sitewright.llm.op05_bpe import Encoder
from sitewright.sources.files import staged

END_ID = 2
SEQUENCE = 1024
#: Texts of more characters are encoded by the scan, whose time stays linear for any text.
LONG_TEXT = 200_000

PLAN = "length int, first long, last long, sequence long, per_bin int, base int"


def byte_of_letter() -> dict[str, int]:
    """The bytes that a byte-level vocabulary file's letters stand for: printable ones themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in printable]
    return letters | {chr(256 + n): b for n, b in enumerate(rest)}


@functools.cache
def added_tokens(path: str) -> tuple[re.Pattern, dict[str, int]]:
    """What matches a file's added tokens, the longest first, and their ids."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"the added tokens in {path} match more or less than their own text")
    ids = {t["content"]: t["id"] for t in tokens}
    whole = "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) or r"(?!)"
    return re.compile(f"({whole})"), ids


@functools.cache
def ranks_of(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level BPE file of the tokenizers library, whose merges are in the order of its ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_of_letter()
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = {bytes(map(letters.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merged = [vocab[b"".join(bytes(map(letters.__getitem__, x)) for x in (m.split(" ") if isinstance(m, str) else m))]
              for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"the merges in {path} are not in the order of their ids")
    return vocab


@functools.cache
def engines(path: str):
    """The library's encoder and the scan's, over the same ranks; one pair per worker."""
    import tiktoken
    from public_tokenizers import PATTERN

    ranks = ranks_of(path)
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), Encoder(ranks)


def token_ids(path: str, text: str) -> np.ndarray:
    """The ids of one text as the tokenizers library gives them: added tokens are found in it before all else."""
    added, ids = added_tokens(path)
    parts = added.split(text)
    if len(parts) == 1:
        return _plain_ids(path, text)
    of = lambda i, part: np.array([ids[part]], dtype=np.uint32) if i % 2 else _plain_ids(path, part)
    return np.concatenate([of(i, part) for i, part in enumerate(parts)])


def _plain_ids(path: str, text: str) -> np.ndarray:
    quick, scan = engines(path)
    if len(text) > LONG_TEXT:
        return np.array(scan.encode_all([text])[0], dtype=np.uint32)
    return quick.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Every document's pieces, numbered per length in their task (`part`, `nth`)."""

    def make():
        part = TaskContext.get().partitionId()
        seen = [0] * (size + 1)

        def work(batch):
            rows, ids_of = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(token_ids(path, text or ""), np.uint32(END_ID)).astype("<u4")
                start, piece = 0, 0
                stop = len(ids) - size * ((len(ids) - 1) // size)
                while start < len(ids):
                    own = ids[start:stop]
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(own.tobytes()), part, seen[stop - start]))
                    seen[stop - start] += 1
                    if with_ids:
                        ids_of.append(own.astype(np.int32))
                    start, stop, piece = stop, stop + size, piece + 1
            columns = list(zip(*rows)) or [()] * 7
            arrays = [pa.array(c, t) for c, t in zip(columns, KINDS)]
            if with_ids:
                arrays.append(pa.array(ids_of, pa.list_(pa.int32())))
            return pa.record_batch(arrays, NAMES + ["ids"] * with_ids)

        return work

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return map_texts(docs.select("doc_id", "text"), make, schema + ", ids array<int>" * with_ids)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows of PLAN.

    The pieces of a length with ranks from first to last go to sequences from
    `sequence` on, `per_bin` to each, the first of them at `base`.
    """
    rows: list[tuple[int, int, int, int, int, int]] = []
    spare: list[tuple[int, int, int]] = []  # residual, first sequence, sequences; sorted
    following = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect.bisect_left(spare, (length, -1, -1))
            if i < len(spare):
                residual, sequence, bins = spare.pop(i)
            else:
                residual, sequence = size, following
                bins = -(-left // (size // length))
                following += bins
            per_bin = residual // length
            taken = min(left, bins * per_bin)
            rows.append((length, rank, rank + taken - 1, sequence, per_bin, size - residual))
            full, rest = divmod(taken, per_bin)
            used = full + bool(rest)
            for bins_here, at, space in (
                (full, sequence, residual - per_bin * length),
                (bool(rest), sequence + full, residual - rest * length),
                (bins - used, sequence + used, residual),
            ):
                if bins_here and space:
                    bisect.insort(spare, (space, at, int(bins_here)))
            rank, left = rank + taken, left - taken
    return rows


def pack(docs: DataFrame, path: str, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if wanted."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, path, size, with_ids), "pieces")
    by_task = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_task = staged(by_task, "piece-counts")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    counts = {int(r[0]): int(r[1]) for r in by_task.groupBy("length").agg(F.sum("n")).collect()}
    slots = spark.createDataFrame(plan(counts, size), PLAN)
    ranked = cut.join(offsets, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    slots = F.broadcast(slots.withColumnRenamed("length", "_length"))  # bounded, see above
    fits = (F.col("length") == F.col("_length")) & F.col("rank").between(F.col("first"), F.col("last"))
    placed = ranked.join(slots, fits)
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("per_bin")).cast("long")).alias("sequence_id"),
        (F.col("base") + (nth % F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
