"""Near-duplicate groups by SimHash, searched with the pigeonring principle.

A fingerprint is cut into distance + 1 segments, set in a ring. If two
fingerprints differ in at most `distance` bits, then some segment starts a chain
of consecutive segments in which every prefix of l segments differs in at most
l * distance / (distance + 1) bits, rounded down to l - 1. So the first segment
is equal and the second differs in one bit at most: these two make the key, which
every fingerprint asks for as it is and answers to with each single bit of the
second segment turned. Pairs that meet are pruned by the rest of the chain and
only then compared in full.

Copies are merged before: distinct fingerprints are searched, each with its
smallest doc_id. Fingerprints with the same key are read in sorted order, those
that ask first, in memory, and those that answer as a stream. Keys that more than
HOT fingerprints ask for are dealt over several slots, each with a share of those
that ask and all that answer. A batch passes on a forest of its links and
never all pairs. Groups are the connected components of the links.

`near_copies` is for text that is to go, at a similarity of 0.8 over five-word
shingles, where fingerprints differ in more bits than a key can turn. It takes
fingerprints of WIDE_SHINGLE-word shingles, which differ less, a radius of
WIDE_DISTANCE and rings of WIDE_PARTS segments, and keys of two consecutive segments as they are. Two near
fingerprints have such a key in common more often than not; with FUNCTIONS independent ones
a pair at 0.82 is missed in about one case of twenty. Chains and the full check
prune the pairs, and links are verified on whole texts. What the fingerprints missed is
found by an exact join, over all texts, of pairs that are not in one component by then. Of two texts
with n and m different shingles that are similar, k = 0.8 / 1.8 (n + m) at least are
shared; so, in any order of all shingles, the first n - 0.8 n + 1 of the one and the
first m - 0.8 m + 1 of the other have one in common. The order puts the most common
shingles, COMMON_MOST at most, behind all others, and goes by hash among those; it decides
how many pairs meet and not which are found. Shingles that many texts have are dealt over slots.

Defined results: a null text, or one without words, has fingerprint zero; rows
with a null doc_id have a fingerprint and a component_id as well, which is null
only if no row of their component has an id; repeated rows give repeated
results; other columns are ignored.
"""

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import map_texts
from sitewright.llm.components import components, forest
from sitewright.llm.op08_passages import shingles
from sitewright.sources.files import staged

BITS, SHINGLE, SEED, DISTANCE = 64, 4, 42, 4
#: Fingerprints that ask for one key in one slot.
HOT = 2048
#: Pairs compared at a time.
PAIRS = 1_000_000
#: For near_copies: shingles of the fingerprints, their radius, ring and number; shingles that are compared in the end.
WIDE_SHINGLE, WIDE_DISTANCE, WIDE_PARTS, FUNCTIONS = 2, 12, 6, 5
EXACT_SHINGLE, SIMILARITY = 5, 0.8
#: Shingles with more texts than this are common; so many of them are put behind the others.
COMMON, COMMON_MOST = 16, 500_000


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle, as rows of eight bytes, most significant first."""
    import xxhash

    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - shingle + 1)
    span = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts[:n], starts[span:])])
    return np.frombuffer(hashes, dtype=np.uint8).reshape(n, 8)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed 64-bit number."""
    bits = np.unpackbits(hashes, axis=1)
    major = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(major).tobytes(), "big", signed=True)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # on ASCII white space alone
    return majority(shingle_hashes(words, shingle)) if words else 0


def independent(text: str | None, functions: int = FUNCTIONS) -> list[int]:
    """Fingerprints under several hash functions."""
    words = (text or "").encode().lower().split()
    if not words:
        return [0] * functions
    own = shingle_hashes(words, WIDE_SHINGLE).view(">u8").ravel().astype(np.uint64)
    out = []
    for j in range(functions):
        mixed = (own ^ np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out.append(majority((mixed ^ (mixed >> np.uint64(29))).astype(">u8").view(np.uint8).reshape(-1, 8)))
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint (fp) of every whole text."""

    def make():
        def work(batch):
            found = [fingerprint(text, shingle) for text in batch.column(1).to_pylist()]
            return pa.record_batch([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

        return work

    return map_texts(docs.select("doc_id", "text"), make, "doc_id long, fp long")


def segments(distance: int, parts: int | None = None) -> list[tuple[int, int]]:
    """Shift and width of each segment of the ring, which has distance + 1 unless told otherwise."""
    m = parts or distance + 1
    widths = [BITS // m + (i < BITS % m) for i in range(m)]
    ends = list(accumulate(widths))
    return [(BITS - end, width) for end, width in zip(ends, widths)]


def key_bits(ring: list[tuple[int, int]]) -> int:
    """Bits of a key below the number of its start."""
    return max(width + ring[(i + 1) % len(ring)][1] for i, (_, width) in enumerate(ring))


def ring_keys(fps: DataFrame, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """key, role (0 asks, 1 answers) and fp: one row that asks per start in the ring, and all that answer it.

    With `parts` given, keys are answered as they are only, without a turned bit.
    """
    ring = segments(distance, parts)
    top, starts = key_bits(ring), []
    for i, (shift, width) in enumerate(ring):
        shift2, width2 = ring[(i + 1) % len(ring)]
        first = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        second = F.shiftrightunsigned("fp", shift2).bitwiseAND(F.lit((1 << width2) - 1))
        base = F.lit(i << top) + F.shiftleft(first.cast("long"), width2) + second
        starts.append(F.struct(base.alias("key"), F.array(*[F.lit(0).cast("long")] + [F.lit(1 << j).cast("long") for j in range(0 if parts else width2)]).alias("turns")))
    rows = fps.select("fp", F.explode(F.array(*starts)).alias("s")).select("fp", "s.key", "s.turns")
    both = F.concat(
        F.array(F.struct(F.col("key"), F.lit(0).alias("role"))),
        F.transform("turns", lambda turn: F.struct(F.col("key").bitwiseXOR(turn).alias("key"), F.lit(1).alias("role"))),
    )
    return rows.select("fp", F.explode(both).alias("k")).select("k.key", "k.role", "fp")


def near(a: np.ndarray, b: np.ndarray, starts: np.ndarray, distance: int, parts: int | None = None) -> np.ndarray:
    """Which pairs hold the chain's budgets from their start on, up to the whole ring."""
    ring = segments(distance, parts)
    differ = (a ^ b).view(np.uint64)
    counts = np.stack([np.bitwise_count((differ >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in ring])
    total = np.zeros(len(a), dtype=np.int64)
    holds = np.ones(len(a), dtype=bool)
    for length in range(1, len(ring) + 1):
        left = np.flatnonzero(holds)
        total[left] += counts[(starts[left] + length - 1) % len(ring), left]
        holds[left] = total[left] <= length * distance // len(ring)
    return holds


def ring_links(keyed: DataFrame, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """Links (a, b) between near fingerprints; rows are key, slot, role, fp, sorted by the first three."""
    top = key_bits(segments(distance, parts))

    def pairs(key, slot, role, fp):
        edge = np.flatnonzero((key[1:] != key[:-1]) | (slot[1:] != slot[:-1])) + 1
        starts = np.concatenate([[0], edge])
        sizes = np.diff(np.append(starts, len(key)))
        asks = np.add.reduceat(role == 0, starts)
        asked = np.repeat(asks, sizes)
        answers = np.flatnonzero((role == 1) & (asked > 0) & (np.repeat(sizes - asks, sizes) > 0))
        first, times = np.repeat(starts, sizes)[answers], asked[answers]
        cuts = np.searchsorted(np.cumsum(times), np.arange(0, times.sum(), PAIRS), side="left") if len(times) else []
        bounds = np.unique(np.append(cuts, len(answers))).astype(int)
        for i, j in zip(np.concatenate([[0], bounds]), bounds):
            if i == j:
                continue
            t = times[i:j]
            right = np.repeat(answers[i:j], t)
            offset = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
            left = np.repeat(first[i:j], t) + offset
            keep = fp[left] < fp[right]
            left, right = left[keep], right[keep]
            holds = near(fp[left], fp[right], key[left] >> top, distance, parts)
            if holds.any():
                yield forest(fp[left][holds], fp[right][holds])

    def run(batches):
        held = [np.zeros(0, dtype=np.int64)] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            rows = [np.concatenate(x) for x in zip(held, new)]
            key, slot, role, _ = rows
            for a, b in pairs(*rows):
                yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])
            last = (key == key[-1]) & (slot == slot[-1]) & (role == 0)
            held = [c[last] for c in rows]

    return keyed.mapInArrow(run, "a long, b long")


def linked(fps: DataFrame, distance: int = DISTANCE, hot: int = HOT, parts: int | None = None) -> DataFrame:
    """A spanning set of links between distinct fingerprints that differ in at most `distance` bits."""
    keyed = ring_keys(fps, distance, parts)
    asked = keyed.where("role = 0").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    slots = staged(asked.select("key", F.ceil(F.col("n") / hot).cast("int").alias("slots")), "hot-keys")
    if slots.isEmpty():
        keyed = keyed.withColumn("slot", F.lit(0))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("slots")).cast("int")
        every = F.sequence(F.lit(0), F.col("slots") - 1)
        slot = F.when(F.col("slots").isNull(), F.array(F.lit(0))).when(F.col("role") == 0, F.array(own)).otherwise(every)
        keyed = keyed.join(slots, "key", "left").withColumn("slot", F.explode(slot))
    keyed = keyed.select("key", "slot", "role", "fp").repartition("key", "slot")
    return ring_links(keyed.sortWithinPartitions("key", "slot", "role"), distance, parts)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of docs."""
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(linked(fps.select("fp"), distance, hot))
    labelled = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    labelled = staged(labelled, "labelled")
    smallest = staged(labelled.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    names = labelled.join(smallest, "root").select("fp", "component_id")
    named = prints.join(names, "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return named.select("doc_id", digits, "component_id")


def text_prints(docs: DataFrame, functions: int = FUNCTIONS) -> DataFrame:
    """doc_id, print (64-bit hash of the lower-case words) and fingerprints fp0, fp1, ... of every whole text."""

    def make():
        def work(batch):
            texts = batch.column(1).to_pylist()
            found = list(zip(*[independent(t, functions) for t in texts]))
            columns = [pa.array(column, pa.int64()) for column in found]
            return pa.record_batch(
                [batch.column(0), word_prints(texts), *columns], ["doc_id", "print", *[f"fp{i}" for i in range(functions)]]
            )

        return work

    schema = "doc_id long, print long, " + ", ".join(f"fp{i} long" for i in range(functions))
    return map_texts(docs.select("doc_id", "text"), make, schema)


def word_prints(texts: list[str | None]) -> pa.Array:
    """A hash of each text's words, with A-Z in lower case."""
    import xxhash

    own = [xxhash.xxh64_intdigest(b" ".join((t or "").encode().lower().split())) for t in texts]
    return pa.array(np.array(own, dtype=np.uint64).view(np.int64))


def exactly_similar(pairs: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of the pairs (a, b), prints of texts (print, text), that are similar over five-word shingles."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("print")).distinct()
    texts = staged(docs.join(wanted, "print", "left_semi").dropDuplicates(["print"]), "near-texts")
    both = pairs.join(texts.select(F.col("print").alias("a"), F.col("text").alias("x")), "a")
    both = both.join(texts.select(F.col("print").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")

    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + EXACT_SHINGLE]) for i in range(max(1, len(words) - EXACT_SHINGLE + 1))}

    def run(batches):
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            kept = []
            for i, (left, right) in enumerate(zip(x, y)):
                left, right = shingles(left), shingles(right)
                kept.append(len(left & right) >= similarity * len(left | right))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _own_shingles(texts: list[str | None]) -> list[np.ndarray]:
    """The different shingles of each text, as sorted hashes; none of texts with fewer words than one has, which only equal themselves."""
    return [np.unique(shingles(text)).view(np.int64) for text in texts]


def common_shingles(docs: DataFrame, common: int = COMMON, most: int = COMMON_MOST) -> np.ndarray:
    """The shingles of more than `common` texts, or the `most` most common of them, as sorted hashes."""

    def make():
        def work(batch):
            own = _own_shingles(list(set(batch.column(1).to_pylist())))
            found, times = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *own]), return_counts=True)
            return pa.record_batch([pa.array(found), pa.array(times)], ["v", "times"])

        return work

    counted = map_texts(docs.select("doc_id", "text"), make, "v long, times long").groupBy("v").agg(F.sum("times").alias("times"))
    found = counted.where(F.col("times") > common).orderBy(F.desc("times"), "v").limit(most).select("v").toArrow()
    return np.sort(found.column("v").to_numpy())


def prefixes(docs: DataFrame, similarity: float = SIMILARITY, common: int = COMMON) -> DataFrame:
    """v (shingle), print, n (different shingles) and at (v's place) of the first shingles of every text, as many as it takes."""
    last = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, common))

    def make():
        seen: set[int] = set()

        def work(batch):
            texts = batch.column(1).to_pylist()
            columns = [[np.zeros(0, dtype=np.int64)] for _ in range(4)]
            for print_, text in zip(word_prints(texts).to_pylist(), texts):
                own = _own_shingles([text])[0] if print_ not in seen else ()
                seen.add(print_)
                n = len(own)
                if n:
                    size = n - int(np.ceil(similarity * n - 1e-6)) + 1
                    rank = np.minimum(np.searchsorted(last.value, own), len(last.value) - 1)
                    behind = last.value[rank] == own if len(last.value) else np.zeros(n, dtype=bool)
                    first = own[np.argsort(behind, kind="stable")[:size]]
                    for column, x in zip(columns, (first, np.full(size, print_), np.full(size, n), np.arange(size))):
                        column.append(x)
            arrays = [pa.array(np.concatenate(c), k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
            return pa.record_batch(arrays, ["v", "print", "n", "at"])

        return work

    return map_texts(docs.select("doc_id", "text"), make, "v long, print long, n int, at int")


def missed_pairs(found: DataFrame, roots: DataFrame, similarity: float = SIMILARITY, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of texts of different components: all that are similar, and others; found has prefixes, roots node and root."""
    named = roots.select(F.col("node").alias("print"), "root")
    rows = found.join(named, "print", "left").withColumn("root", F.coalesce("root", "print"))
    rows = staged(rows.dropDuplicates(["v", "print"]), "prefix-rows")
    sizes = rows.groupBy("v", "root").agg(F.count(F.lit(1)).alias("times")).groupBy("v").agg(
        F.max(F.struct("times", "root")).alias("most"), F.sum("times").alias("times"), F.count(F.lit(1)).alias("roots")
    )
    slots = F.ceil(F.col("times") / hot).cast("int").alias("slots")
    sizes = sizes.where("roots > 1").select("v", F.col("most.root").alias("main"), slots)
    rows = rows.join(sizes, "v").withColumn("main", F.col("root") == F.col("main"))

    def side(x: str, slot):
        names = {"print": x, "n": f"n_{x}", "at": f"at_{x}", "root": f"root_{x}", "main": f"main_{x}"}
        return rows.select("v", slot.alias("slot"), *[F.col(c).alias(name) for c, name in names.items()])

    left = side("a", F.pmod(F.xxhash64("print"), F.col("slots")).cast("int"))
    right = side("b", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    shared = (F.col("n_a") + F.col("n_b")) * (similarity / (1 + similarity)) - 1e-6
    fits = (F.col("root_a") != F.col("root_b")) & (F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= shared)
    # Two texts of the component that has most of a shingle's texts never meet; all other pairs meet in one order at least.
    parts = [(left.where("NOT main_a"), right.where("main_b")), (left.where("NOT main_a"), right.where("NOT main_b"))]
    first, second = (x.join(y, ["v", "slot"]).where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for x, y in parts)
    return first.unionByName(second).distinct()


def near_copies(docs: DataFrame, functions: int = FUNCTIONS, distance: int = WIDE_DISTANCE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and component_id, the smallest doc_id of all near copies of a text, one row per row of docs.

    Copies, up to case and white space, are one text from the start. For every
    function, texts with equal fingerprints are linked with the first of them, and
    fingerprints within the radius by their first texts.
    """
    prints = staged(text_prints(docs, functions), "text-prints")
    names = [f"fp{i}" for i in range(functions)]
    texts = prints.groupBy("print").agg(F.min("doc_id").alias("first"), *[F.max(name).alias(name) for name in names])
    texts = staged(texts, "texts")
    pairs = None
    for name in names:
        leads = staged(texts.groupBy(F.col(name).alias("fp")).agg(F.min("print").alias("lead")), "leads")
        near = linked(leads.select("fp"), distance, parts=WIDE_PARTS)
        side = lambda x, lead: leads.select(F.col("fp").alias(x), F.col("lead").alias(lead))  # noqa: E731, B023
        near = near.join(side("a", "u"), "a").join(side("b", "v"), "b").select("u", "v")
        same = texts.join(leads, texts[name] == leads["fp"]).where("print <> lead").select(F.col("lead").alias("u"), F.col("print").alias("v"))
        own = near.unionByName(same)
        pairs = own if pairs is None else pairs.unionByName(own)
    pairs = staged(pairs.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "near-pairs")
    links = staged(exactly_similar(pairs, _with_print(docs), similarity), "near-links")
    # Only shingles that several texts have can bring them together.
    found = prefixes(docs, similarity)
    by_shingle = Window.partitionBy("v")
    found = found.select("*", F.min("print").over(by_shingle).alias("low"), F.max("print").over(by_shingle).alias("high"))
    found = staged(found.where("low < high").drop("low", "high"), "prefixes")
    missed = staged(missed_pairs(found, components(links), similarity), "missed-pairs")
    links = staged(links.unionByName(exactly_similar(missed, _with_print(docs), similarity)), "all-links")
    roots = components(links)
    labelled = texts.join(roots, texts["print"] == roots["node"], "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    labelled = staged(labelled, "near-labelled")
    smallest = staged(labelled.groupBy("root").agg(F.min("first").alias("component_id")), "near-smallest")
    return prints.select("doc_id", "print").join(labelled.join(smallest, "root").select("print", "component_id"), "print").select("doc_id", "component_id")


def _with_print(docs: DataFrame) -> DataFrame:
    """print and text of every text."""

    def make():
        def work(batch):
            return pa.record_batch([word_prints(batch.column(1).to_pylist()), batch.column(1)], ["print", "text"])

        return work

    return map_texts(docs.select("doc_id", "text"), make, "print long, text string")


def representatives(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One document of every component, that with the smallest doc_id, with all its columns.

    Components are those of `found` (doc_id, component_id), or else of near copies.
    Rows that share this doc_id are one document and stay together; so do rows
    with a null doc_id, if no row of their component has one.
    """
    found = near_copies(docs) if found is None else found
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
