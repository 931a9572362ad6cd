"""Removal of near-equal lines: MinHash of character shingles, one line per component stays.

Lines are trimmed; blank ones always stay. A line's shingles are the SHINGLE-byte
windows of its UTF-8 bytes (the whole line, if it is shorter). One hash per
shingle gives a signature of SIGNATURE minima, one per bin of hashes; an empty bin
borrows from the next one. Hashes are sorted within the row, where the first one of
a bin is its minimum, so that no shingle is a row of its own. A shingle that
repeats has one hash, so lines with equal sets have equal signatures.
ROWS minima are a band; two lines with a similarity of 0.8 share one of the bands
with a probability of 98.6 %, with 0.9 of 99.96 %.

Equal lines are counted first and are one line from there on, named by a 64-bit
hash. Lines that share a band's key meet in a bucket. First every line is
compared with one other, the most frequent of its buckets' most frequent lines:
where lines are copies with changes, that is what they were copied from. In ROUNDS
further rounds the lines of a bucket that are outside its hubs' components are
compared with the most frequent one of them. In the last round all lines that are still apart
in a bucket are compared. In buckets of at most PAIRWISE lines these are all pairs. Lines of larger
buckets are joined, over all of these, by their rarest shingles: of two lines
with n and m shingles that are similar, k = 0.8 / 1.8 (n + m) at least are shared, so
that the n - k + 1 rarest of the one and the m - k + 1 rarest of the other have one
in common, which no pair that is similar can be without. Pairs of one component
are never made, and shingles that many lines have are dealt over slots.

Before texts are fetched, a pair's signatures must agree in AGREE of their minima (lines of
fewer than SMALL shingles are let through); 0.6 % of the pairs at similarity 0.8 do
not, and fewer above. Every pair left is compared by the exact Jaccard similarity of the shingle
sets. Components come from distributed union-find; later rounds only link whole
components. Tables written in between are dropped when the last has read them.

The first line of a component, by doc_id, text hash and line number, stays.

Defined results: a null text has no lines and stays null; rows with equal doc_id
and equal text are one document, what goes from one goes from the others; rows
with a null doc_id come first; other columns are left as they are.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import Scratch
from sitewright.llm.components import components
from sitewright.sources.files import staged

SHINGLE, SIGNATURE, ROWS = 9, 18, 3
SIMILARITY = 0.8
#: Minima in which two signatures must agree; lines with fewer shingles have too few minima of their own for that.
AGREE, SMALL = 10, 64
#: Rounds with the most frequent line of those that are still apart.
ROUNDS = 2
#: Of a bucket of at most so many lines, all pairs are made; larger ones are joined by shingles.
PAIRWISE = 32
#: Lines with one rare shingle in one slot.
HOT = 2048


def lines_of(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, print (of the text), line_no (from 0), line (trimmed) and its hash h, without blank lines."""
    each = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("print"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    each = each.withColumn("line", F.trim(F.col("line"))).where(F.col("line") != "")
    return each.withColumn("h", F.xxhash64("line"))


def distinct_lines(lines: DataFrame) -> DataFrame:
    """h, raw (the bytes), times, first_doc and no_doc (whether a place has no doc_id) of each distinct line."""
    # Only numbers are aggregated, so the lines are hashed and not sorted.
    counted = lines.groupBy("line").agg(
        F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("first_doc"), F.max(F.col("doc_id").isNull()).alias("no_doc")
    )
    return counted.select(F.xxhash64("line").alias("h"), F.encode("line", "UTF-8").alias("raw"), "times", "first_doc", "no_doc")


def shingles(raw: str) -> Column:
    """The shingles of a line's bytes, as hashes, with repetitions."""

    def of(line: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.octet_length(line) - SHINGLE + 1, F.lit(1)))
        return F.transform(at, lambda i: F.xxhash64(F.substring(line, i, F.lit(SHINGLE))))

    # Bound in a lambda, the line is read once. As a column it would be copied whole for every shingle.
    return F.get(F.transform(F.array(raw), of), F.lit(0))


def signatures(distinct: DataFrame) -> DataFrame:
    """h, n (shingles, with repetitions), times and sig (the minima) of each distinct line."""
    # Bins are equal ranges of hashes. Their lower ends are sorted in among the hashes, each just before its bin's minimum.
    ends = [-(1 << 63) + (j << 64) // SIGNATURE for j in range(SIGNATURE)]
    rows = distinct.select("h", "times", F.sort_array(F.concat(shingles("raw"), F.array(*[F.lit(e) for e in ends]))).alias("own"))
    after = F.array(*[F.get("own", F.array_position("own", F.lit(e)).cast("int")) for e in ends])
    rows = rows.select("h", "times", (F.size("own") - SIGNATURE).alias("n"), after.alias("after"))
    # An empty bin is followed by the next one's end, or by nothing. Few lines have one, and few hashes then.
    borrowed = F.transform(
        F.sequence(F.lit(0), F.lit(SIGNATURE - 1)),
        lambda j: F.element_at(F.filter(F.concat(F.slice("after", j + 1, SIGNATURE), F.col("after")), lambda v: v.isNotNull() & ~v.isin(ends)), 1),
    )
    sig = F.when(F.arrays_overlap("after", F.array(*[F.lit(e) for e in ends])) | F.get("after", F.lit(SIGNATURE - 1)).isNull(), borrowed)
    sig = F.transform(sig.otherwise(F.col("after")), lambda v: v.bitwiseAND((1 << 31) - 1).cast("int"))
    return rows.select("h", "n", "times", sig.alias("sig"))


def bands(signed: DataFrame) -> DataFrame:
    """h, place (the line's rank: most frequent first, then by hash) and the key of each band."""
    keys = [
        F.xxhash64(F.lit(b), *[F.get("sig", F.lit(b * ROWS + r)) for r in range(ROWS)]) for b in range(SIGNATURE // ROWS)
    ]
    return signed.select("h", _rank().alias("place"), F.explode(F.array(*keys)).alias("key"))


def _rank() -> Column:
    """Of two lines the more frequent one has the larger rank."""
    return F.shiftleft(F.least("times", F.lit(1 << 22)), 40).bitwiseOR(F.col("h").bitwiseAND((1 << 40) - 1))


def bucketed(signed: DataFrame) -> DataFrame:
    """key, h, place, hub (the bucket's most frequent line), top (its place) and size, for buckets of two lines or more."""
    keyed = bands(signed)
    buckets = keyed.groupBy("key").agg(
        F.max_by("h", "place").alias("hub"), F.max("place").alias("top"), F.count(F.lit(1)).alias("size")
    )
    return keyed.join(buckets.where("size > 1"), "key")


def agreeing(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Those of the pairs (a, b and more) whose signatures agree well enough."""
    side = lambda x: signed.select(F.col("h").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_agree("a", "b")).select(*pairs.columns)


def _agree(a: str, b: str) -> Column:
    equal = [(F.get(f"sig_{a}", F.lit(j)) == F.get(f"sig_{b}", F.lit(j))).cast("int") for j in range(SIGNATURE)]
    return (F.least(f"n_{a}", f"n_{b}") < SMALL) | (sum(equal[1:], equal[0]) >= AGREE)


def similar(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of the pairs (a, b and more) whose lines are similar; texts has h and raw, the line's bytes."""
    left = texts.select(F.col("h").alias("a"), F.col("raw").alias("raw_a"))
    right = texts.select(F.col("h").alias("b"), F.col("raw").alias("raw_b"))
    both = pairs.join(left, "a").join(right, "b")
    # Bound in a lambda, the shingles are made once for all that is done with them.
    sets = F.array(F.struct(shingles("raw_a").alias("x"), shingles("raw_b").alias("y")))
    holds = F.exists(
        sets, lambda s: F.size(F.array_intersect(s["x"], s["y"])) >= similarity * F.size(F.array_union(s["x"], s["y"]))
    )
    return both.where(holds).select(*pairs.columns)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of lines (a, b) of components (u, v)."""
    sides = [f(x, y).alias(name) for x, y in (("a", "b"), ("u", "v")) for f, name in ((F.least, x), (F.greatest, y))]
    return pairs.select(*sides).where("a <> b").distinct()


def merged(roots: DataFrame, moved: DataFrame) -> DataFrame:
    """The roots after components were linked; `moved` gives the new root of the old ones."""
    moved = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    alone = moved.join(roots.where("node = root").select("root"), "root", "left_anti")
    return old.unionByName(alone.select(F.col("root").alias("node"), F.col("to").alias("root")))


def rarest(lines: DataFrame, texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """v (shingle), at (its place, rarest first), h, n, root and short of lines (h, root).

    There are as many shingles of a line as one that is not longer may have to
    share; `short` are those that one that is not shorter may have to share.
    """
    sets = lines.join(texts, "h").select("h", "root", F.array_distinct(shingles("raw")).alias("own"))
    each = scratch.staged(sets.select("h", F.size("own").alias("n"), "root", F.explode("own").alias("v")), "shingles")
    ranked = each.join(each.groupBy("v").agg(F.count(F.lit(1)).alias("times")), "v")
    place = F.row_number().over(Window.partitionBy("h").orderBy("times", "v")) - 1
    ranked = ranked.select("v", "h", "n", "root", "times", place.alias("at"))
    # A shingle of one line keeps its place, but finds nothing.
    ranked = ranked.where(F.col("times") > 1).where(F.col("n") - F.col("at") >= similarity * F.col("n"))
    return ranked.select("v", "at", "h", "n", "root", (F.col("n") - F.col("at") >= _shared("n", "n", similarity)).alias("short"))


def _shared(n: str, m: str, similarity: float) -> Column:
    """Shingles that similar lines of n and m shingles share at least; a little less, for the rounding."""
    return (F.col(n) + F.col(m)) * (similarity / (1 + similarity)) - 1e-6


def rare_pairs(
    lines: DataFrame, texts: DataFrame, signed: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, hot: int = HOT
) -> DataFrame:
    """Pairs (a, b) of different components (u, v) among lines (h, root): all similar ones whose signatures agree, and others."""
    rows = scratch.staged(rarest(lines, texts, similarity, scratch), "rarest")
    by_root = rows.groupBy("v", "root").agg(F.count(F.lit(1)).alias("times"))
    known = by_root.groupBy("v").agg(
        F.max(F.struct("times", "root")).alias("most"), F.sum("times").alias("times"), F.count(F.lit(1)).alias("roots")
    )
    known = known.where("roots > 1").select("v", F.col("most.root").alias("main"), F.ceil(F.col("times") / hot).cast("int").alias("slots"))
    rows = rows.join(known, "v").withColumn("in_main", F.col("root") == F.col("main")).drop("main")
    rows = scratch.staged(rows.join(signed.select("h", "sig"), "h"), "rarest-signed")

    def side(df: DataFrame, x: str, slot: Column) -> DataFrame:
        names = {"h": x, "n": f"n_{x}", "root": f"root_{x}", "in_main": f"main_{x}", "at": f"at_{x}", "sig": f"sig_{x}"}
        return df.select("v", slot.alias("slot"), *[F.col(c).alias(name) for c, name in names.items()])

    left = side(rows.where("short"), "a", F.pmod(F.xxhash64("h"), F.col("slots")).cast("int"))
    # Nearly all shingles have one slot; only rows of the others are copied.
    right = side(rows.where("slots = 1"), "b", F.lit(0))
    right = right.unionByName(side(rows.where("slots > 1"), "b", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))))
    shared = _shared("n_a", "n_b", similarity)
    fits = (F.col("root_a") != F.col("root_b")) & (F.col("n_a") <= F.col("n_b")) & (F.col("n_a") >= F.col("n_b") * similarity - 1e-6)
    fits = fits & (F.col("n_a") - F.col("at_a") >= shared) & (F.col("n_b") - F.col("at_b") >= shared) & _agree("a", "b")
    # Two lines of the component that has most of a shingle's lines never meet.
    parts = [(left.where("main_a"), right.where("NOT main_b")), (left.where("NOT main_a"), right)]
    first, second = (
        x.join(y, ["v", "slot"]).where(fits).select("a", "b", F.col("root_a").alias("u"), F.col("root_b").alias("v")) for x, y in parts
    )
    return first.unionByName(second)


def _linked(roots: DataFrame, pairs: DataFrame, signed: DataFrame, texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame | None:
    """The roots after the components (u, v) of similar pairs (a, b) were linked; None if there were none."""
    agreed = scratch.staged(agreeing(pairs, signed), "agreed")
    new = scratch.staged(similar(agreed, texts, similarity).select("u", "v").distinct(), "similar")
    if new.isEmpty():
        return None
    moved = components(new.select(F.col("u").alias("a"), F.col("v").alias("b")))
    return scratch.staged(merged(roots, moved), "roots")


def _apart(members: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """The members with their roots, of buckets that hold lines of several components."""
    rooted = roots.select(F.col("node").alias("h"), "root")
    own = members.drop("root").join(rooted, "h", "left").withColumn("root", F.coalesce("root", "h"))
    own = scratch.staged(own, "members")
    ends = own.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return scratch.staged(own.join(ends.where("low < high").select("key"), "key"), "apart")


def line_components(
    distinct: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, pairwise: int = PAIRWISE, rounds: int = ROUNDS
) -> DataFrame:
    """node and root (hashes of lines) for every line that is similar to another; `distinct` is a table of distinct lines."""
    signed = scratch.staged(signatures(distinct), "signatures")
    members = scratch.staged(bucketed(signed), "buckets")
    met = members.select("h").distinct()
    signed = scratch.staged(signed.select("h", "n", "sig").join(met, "h", "left_semi"), "signatures")
    texts = scratch.staged(distinct.select("h", "raw").join(met, "h", "left_semi"), "texts")
    first = members.where("hub <> h").groupBy("h").agg(F.max_by("hub", "top").alias("a")).select("a", F.col("h").alias("b"))
    first = scratch.staged(agreeing(first, signed), "agreed")
    roots = scratch.staged(components(similar(first, texts, similarity)), "roots")
    members = _apart(members.drop("top", "hub"), roots, scratch)
    left = members
    for _ in range(rounds):
        # Whoever is in a bucket's largest component so far is done with; of the others the most frequent is the next hub.
        hubs = left.groupBy("key").agg(F.max_by("root", "place").alias("done"))
        left = scratch.staged(left.join(hubs, "key").where("root <> done").drop("done"), "left")
        hubs = left.groupBy("key").agg(F.max_by("h", "place").alias("hub"), F.max_by("root", "place").alias("u"))
        met = left.join(hubs, "key").where("root <> u").select(F.col("hub").alias("a"), F.col("h").alias("b"), "u", F.col("root").alias("v"))
        now = _linked(roots, _ordered(met), signed, texts, similarity, scratch)
        if now is None:
            break
        roots = now
        rooted = roots.select(F.col("node").alias("h"), "root")
        left = left.drop("root").join(rooted, "h", "left").withColumn("root", F.coalesce("root", "h"))
    own = _apart(members, roots, scratch)
    few = own.where(F.col("size") <= pairwise)
    side = lambda x, root: few.select("key", F.col("h").alias(x), F.col("root").alias(root))
    pairs = side("a", "u").join(side("b", "v"), "key").where("a < b AND u <> v").select("a", "b", "u", "v")
    large = own.where(F.col("size") > pairwise).select("h", "root").distinct()
    if not large.isEmpty():
        pairs = pairs.unionByName(rare_pairs(large, texts, signed, scratch, similarity))
    now = _linked(roots, _ordered(pairs), signed, texts, similarity, scratch)
    return roots if now is None else now


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY, pairwise: int = PAIRWISE) -> DataFrame:
    """doc_id, print and the numbers of the lines that go, for documents that lose lines."""
    lines = lines_of(docs.select("doc_id", "text"))
    with Scratch(docs.sparkSession, "lines") as scratch:
        distinct = scratch.staged(distinct_lines(lines), "distinct")
        roots = line_components(distinct, scratch, similarity, pairwise).select(F.col("node").alias("h"), "root")
        counted = distinct.drop("raw").join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
        groups = counted.groupBy("root").agg(
            F.sum("times").alias("times"), F.min("first_doc").alias("first_doc"), F.max("no_doc").alias("no_doc")
        )
        first_doc = F.when(~F.col("no_doc"), F.col("first_doc")).alias("first_doc")
        groups = groups.where("times > 1").select("root", first_doc)
        wanted = staged(counted.select("h", "root").join(groups, "root"), "line-wanted")
    # Lines that occur once and are like no other are out from here on.
    places = lines.select("h", "doc_id", "print", "line_no").join(wanted, "h")
    places = staged(places.select("doc_id", "print", "line_no", "root", "first_doc"), "line-places")
    in_first = F.col("doc_id").eqNullSafe(F.col("first_doc"))
    place = F.struct("print", "line_no")
    mine = places.where(in_first)
    kept = mine.groupBy("root").agg(F.min(place).alias("kept"))
    gone = places.where(~in_first).select("doc_id", "print", "line_no")
    gone = gone.unionByName(mine.join(kept, "root").where(place != F.col("kept")).select("doc_id", "print", "line_no"))
    # Equal rows give equal places, which are one place.
    return gone.groupBy("doc_id", "print").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def line_report(docs: DataFrame, similarity: float = SIMILARITY, pairwise: int = PAIRWISE) -> DataFrame:
    """doc_id, n_lines, n_removed and removed (line numbers from 0) for every document."""
    gone = removed_lines(docs, similarity, pairwise)
    sizes = docs.select(
        "doc_id", F.xxhash64("text").alias("print"), F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines")
    )
    rows = sizes.alias("d").join(gone.alias("g"), _same("d", "g"), "left")
    removed = F.coalesce("g.removed", F.array().cast("array<int>"))
    return rows.select("d.doc_id", "d.n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.print") == F.col(f"{right}.print"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, pairwise: int = PAIRWISE) -> DataFrame:
    """The documents without the lines that go; n_chars follows, if there is one."""
    gone = removed_lines(docs, similarity, pairwise)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", F.xxhash64("text").alias("print"))
    rows = rows.alias("d").join(gone.alias("g"), _same("d", "g"), "left").select("d.doc", "g.removed")
    left = F.filter(F.split("doc.text", "\n", -1), lambda _, i: ~F.array_contains("removed", i))
    rows = rows.select("doc", F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.array_join(left, "\n")).alias("own"))
    new = {"text": F.col("own")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("own").cast(docs.schema["n_chars"].dataType), F.col("doc.n_chars"))
    return rows.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
