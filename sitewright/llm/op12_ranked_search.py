"""Ranked lexical search: every item's best documents, by branch and bound in trees of frequent terms.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with only A-Z in
lower case. A term's weight, a document's length penalty m and the score
are the whole numbers that `weight`, `penalty` and `part` give.

One pass over the documents counts terms and writes, for each document, its length
and its term vector restricted to the terms of all items. Counts over all documents
come from that table. Then every task builds trees of at most TREE documents and TREE_TERMS terms: a
vector is a path of its terms, most frequent first, and documents that begin alike
share it. Nodes are kept where documents part; one that holds most of its
parent's documents hands its children over, so that trees stay shallow, and one
of at most LEAF documents is a list of them. With the children of a node stand
the largest tf of every term and the smallest m in each. Since a score grows with
tf and falls with m, these bound the score of all documents below, and
for a single document the bound is the score. An item goes down a tree
depth first, the best bound first, and leaves out what cannot reach the
best K it holds from this tree and those before it. Every task returns its best K
of every item, and the best K of these are the result.

Items are handled in blocks of at most BLOCK_BYTES of text, a pass each; a
block's terms go to all tasks, their size is thereby bounded.

Defined results: rows with equal item_id (nulls included) are one item with the
terms of all; a null or empty text has no terms and finds nothing; rows of
documents are documents each, also with equal ids; of equal scores the smaller
doc_id comes first, null ids last; other columns are ignored.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import map_texts
from sitewright.sources.files import staged

K = 10
#: Documents and terms of one tree; documents of a node that is not divided further, and of a range that is no node.
TREE, TREE_TERMS, LEAF, FEW = 8192, 2_000_000, 64, 8
#: A child with more than this share of its parent's documents is no node of its own.
HEAVY = 0.75
#: Text of the items that are searched for in one pass.
BLOCK_BYTES = 8_000_000

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"
#: Letters and digits stay, A-Z become small, other ASCII parts terms; bytes beyond ASCII stay.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_NO_ID = (1 << 63) - 1


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats."""
    return raw.translate(_TABLE).split()


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def penalty(n: int, documents: int, total: int) -> int:
    return 100 - 90 + (90 * n * documents) // total


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score, apart from its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Node:
    """Children that are nodes or documents, with the largest tf of their terms and their smallest m."""

    def __init__(self, children, vectors, m, first):
        self.children = children
        self.m, self.first = np.array(m, dtype=np.int64), np.array(first, dtype=np.int64)
        sizes = [len(terms) for terms, _ in vectors]
        terms = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int32)
        tfs = np.concatenate([f for _, f in vectors]) if vectors else np.zeros(0, np.int64)
        order = np.argsort(terms, kind="stable")
        self.terms, self.tfs = terms[order], tfs[order]
        self.owner = np.repeat(np.arange(len(vectors)), sizes)[order]

    def maxima(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms below this node and the largest tf of each."""
        if not len(self.terms):
            return self.terms, self.tfs
        starts = np.flatnonzero(np.r_[True, self.terms[1:] != self.terms[:-1]])
        return self.terms[starts], np.maximum.reduceat(self.tfs, starts)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every child a bound of the scores below it; the score itself for a document."""
        low, high = np.searchsorted(self.terms, terms), np.searchsorted(self.terms, terms, "right")
        sizes = high - low
        at = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        owner = self.owner[at]
        out = np.zeros(len(self.children), dtype=np.int64)
        np.add.at(out, owner, np.repeat(weights, sizes) * part(self.tfs[at], self.m[owner]))
        return out


def tree(docs: list[tuple[int, np.ndarray, np.ndarray, int]]) -> Node:
    """The tree of documents (id, terms from the most frequent one, tfs, m)."""
    docs = sorted(docs, key=lambda d: d[1].astype(">u4").tobytes())
    shared = np.zeros(len(docs) + 1, dtype=np.int64)  # terms in common with the document before
    for i in range(1, len(docs)):
        a, b = docs[i - 1][1], docs[i][1]
        k = min(len(a), len(b))
        differ = a[:k] != b[:k]
        shared[i] = differ.argmax() if differ.any() else k

    def parts(low: int, high: int) -> Iterator[tuple[int, int]]:
        """Where documents low to high - 1 part."""
        inner = shared[low + 1 : high]
        cuts = np.flatnonzero(inner == inner.min()) + low + 1
        for a, b in zip([low, *cuts.tolist()], [*cuts.tolist(), high]):
            if b - a > HEAVY * (high - low) and b - a > LEAF:
                heavy.append((a, b))
            elif b - a > FEW:
                yield a, b
            else:
                yield from ((i, i + 1) for i in range(a, b))

    def node(low: int, high: int) -> Node:
        """Only ranges that are at most HEAVY of this one's are nodes below it, so that calls are few deep."""
        spans: list[tuple[int, int]] = []
        todo = [(low, high)] if high - low > LEAF else []
        if not todo:
            spans = [(i, i + 1) for i in range(low, high)]
        while todo:
            heavy.clear()
            spans += parts(*todo.pop())
            todo += heavy
        children, vectors, m, first = [], [], [], []
        for a, b in spans:
            if b - a == 1:
                own, terms, tfs, penalty_ = docs[a]
                children.append(own), vectors.append((terms, tfs)), m.append(penalty_), first.append(own)
            else:
                below = node(a, b)
                children.append(below), vectors.append(below.maxima())
                m.append(int(below.m.min())), first.append(int(below.first.min()))
        return Node(children, vectors, m, first)

    heavy: list[tuple[int, int]] = []
    return node(0, len(docs))


def search(root: Node, terms: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], k: int = K) -> list[tuple[int, int]]:
    """The best k of `best` and the tree's documents, as (-score, id), sorted."""
    todo = [root]
    while todo:
        at = todo.pop()
        bounds = at.bounds(terms, weights)
        keep = np.flatnonzero(bounds > 0)
        if len(best) == k:
            score, own = -best[-1][0], best[-1][1]
            keep = keep[(bounds[keep] > score) | ((bounds[keep] == score) & (at.first[keep] < own))]
        below = []
        for c in keep[np.lexsort((at.first[keep], -bounds[keep]))].tolist():
            bound, child = int(bounds[c]), at.children[c]
            if len(best) == k and (-bound, int(at.first[c])) >= best[-1]:
                break
            if isinstance(child, Node):
                below.append(child)
            else:
                best.append((-bound, child))
                best.sort()
                del best[k:]
        todo += reversed(below)
    return best


def _vectors(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """Rows of VECTORS of all documents with a term; `known` numbers the items' terms."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def make():
        numbers = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, lengths, terms, tfs = [], [], [], []
            raw = batch.column(1).cast(pa.large_binary())
            for own, text in zip(batch.column(0).to_pylist(), raw):
                words = terms_of(text.as_py() or b"")
                if words:
                    counts = Counter(filter(numbers.__contains__, words))
                    ids.append(own), lengths.append(len(words))
                    terms.append([numbers[t] for t in counts]), tfs.append(list(counts.values()))
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, VECTORS)


def _best(vectors: DataFrame, items: list[tuple[list[int], list[int]]], ranks: list[int], documents: int, total: int, k: int) -> DataFrame:
    """Rows of FOUND, every task's best k of every item; `ranks` gives a term's place by frequency."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, ranks = shared.value
        place = np.array(ranks, dtype=np.int32)
        asked = []
        for terms, weights in items:
            at = place[np.array(terms, dtype=np.int64)]
            order = np.argsort(at)
            asked.append((at[order], np.array(weights, dtype=np.int64)[order]))
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        held: list[tuple] = []
        size = 0

        def settle():
            root = tree(held)
            for i, (terms, weights) in enumerate(asked):
                best[i] = search(root, terms, weights, best[i], k)
            held.clear()

        for batch in batches:
            terms, tfs = batch.column(2), batch.column(3)
            ends = terms.offsets.to_numpy()
            flat, counts = place[terms.values.to_numpy()], tfs.values.to_numpy().astype(np.int64)
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends.tolist(), ends[1:].tolist())
            for own, n, a, b in rows:
                if a == b:
                    continue  # shares no term with any item
                order = np.argsort(flat[a:b])
                m = penalty(n, documents, total)
                held.append((_NO_ID if own is None else own, flat[a:b][order], counts[a:b][order], m))
                size += b - a
                if len(held) == TREE or size >= TREE_TERMS:
                    settle()
                    size = 0
        if held:
            settle()
        rows = [(i, None if own == _NO_ID else own, -score) for i, found in enumerate(best) for score, own in found]
        columns = list(zip(*rows)) if rows else [[], [], []]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, FOUND)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items and their terms, in blocks of about that much text; one whose text is larger is a block of its own."""
    block: dict[object, set[bytes]] = {}
    held = 0
    rows = items.select("item_id", "text").orderBy("item_id")
    for row in rows.toLocalIterator():
        size = len(row["text"] or "")
        if held + size > block_bytes and block and row["item_id"] not in block:
            yield [(i, sorted(t)) for i, t in block.items()]
            block, held = {}, 0
        block.setdefault(row["item_id"], set()).update(terms_of((row["text"] or "").encode()))
        held += size
    if block:
        yield [(i, sorted(t)) for i, t in block.items()]


def ranked(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents (doc_id, text) of every item (item_id, text)."""
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    for block in _blocks(items, block_bytes):
        words = sorted({t for _, terms in block for t in terms})
        known = {t: i for i, t in enumerate(words)}
        vectors = staged(_vectors(docs, known), "search-vectors")
        sums = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
        if not sums["total"]:
            continue
        counted = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
        df = {row["t"]: row["df"] for row in counted}
        order = sorted(range(len(words)), key=lambda t: (-df.get(t, 0), t))
        ranks = [0] * len(words)
        for place, t in enumerate(order):
            ranks[t] = place
        asked = [[known[t] for t in terms if known[t] in df] for _, terms in block]
        weights = [[weight(df[t], sums["documents"]) for t in terms] for terms in asked]
        found = _best(vectors, list(zip(asked, weights)), ranks, sums["documents"], sums["total"], k)
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, own) for i, (own, _) in enumerate(block)], f"item int, item_id {item_type}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def oracle() -> str:
    """DuckDB SQL for ranked(documents, benchmark)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS place, doc_id, text FROM documents),
        t AS (SELECT place, doc_id, {words} AS term FROM d),
        tf AS (SELECT place, doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY ALL),
        n AS (SELECT place, sum(tf)::BIGINT AS n FROM tf GROUP BY place),
        s AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM n),
        m AS (SELECT place, 100 - 90 + (90 * n * big_n) // l AS m FROM n, s),
        w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, big_n),
        q AS (SELECT DISTINCT item_id, {words} AS term FROM benchmark),
        r AS (
            SELECT item_id, doc_id, place, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (place) GROUP BY item_id, doc_id, place
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0
        ) WHERE rank <= 10
    """
