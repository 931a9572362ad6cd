"""Near-duplicate passages across documents, found by compact windows.

A text is the sequence of its SHINGLE-word shingles, as hashes. Under one hash
function the shingles' minima form a Cartesian tree over the text: a node's
interval [l, r] is the largest one in which the shingle at c is the minimum, so
that all passages with l <= first <= c <= last <= r share this min-hash. Such a
compact window matters if it can hold a passage of LEAST words; these nodes are
the distinct minima of a window of that length that slides over the text, which
gives them and their intervals in linear time, without the rest of the tree.

Windows meet by min-hash in two rounds. In the first they are a stream, sorted by a
code of what follows the shingle they share, or, under every other function, of what
goes before it; each window is linked with the one before it and with the group's
first. Links of two texts are joined by overlap: where windows of at least ENOUGH of
the HASHES functions overlap in both texts, there is a candidate. It is verified on
the texts' words: a passage is a stretch of LEAST words or more of which the shared
shingles make up 80 %, and whose Jaccard similarity with the other text's stretch is
0.8 or more. Passages that were verified against each other are a class.

The second round takes all that the first left out, once with one partner for each window, so that
copies come into one class, and then with all: in every group, all pairs of windows
that are not in passages of one class are compared, in blocks of a code of one byte for each
shingle within reach of the shared one. Of 46 shingles of a stretch that is similar, 41 at least are shared,
in the same order and moved by SHIFT places at most; pairs whose codes hold no such 46 places are
no passages. All others are verified, whether a second function links them or not. Windows of one
class are never compared, so that copies of a passage make no pairs of pairs. Most pairs are ruled out before that by a
bit for every code of a half: any stretch has one of the halves before and behind the shared shingle in full, and
of a half no more places are missing in the other window than of the stretch.

Groups of more than DIVIDE windows are divided before that, without the loss of a pair: of two stretches
that share so many shingles, the first shared one in some order of all shingles is among the
first few of both. So a window goes to the subgroups of the first few shingles of all stretches it
can hold, and meets there those that share one. In a group's order those that many of a sample of its windows have
come last. Windows that such a common shingle may have to bring together (or that are all in
one long passage too short to count) meet in one subgroup more. One with a
shingle that repeats within SHIFT places may match more than one place for one; it is compared with its whole group.
Subgroups of more than HOT windows are dealt over slots; within a subgroup comparisons are still quadratic
in the windows that are in no common class.

Texts are named by a 64-bit hash, so that copies are one text, and their windows are one, whichever
tasks they come from. A text with several documents is
a passage by itself. Passages (a text and the stretch of it) that were verified
against each other, directly or by way of others, are a class, found by
distributed union-find.

Defined results: null texts and texts of fewer than LEAST words have no
passages; words are compared with A-Z in lower case; rows with a null doc_id
count as documents, with a null doc_id in the result; rows that repeat a doc_id
and its text are one document; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import WORD, Scratch, in_chunks, map_texts
from sitewright.llm.components import components
from sitewright.sources.files import staged

SHINGLE, LEAST, SIMILARITY = 5, 50, 0.8
HASHES, ENOUGH = 5, 2
#: Shingles in one step of the code by which windows are sorted, and the number of steps, a byte each.
STEP, STEPS = 11, 4
#: Places by which a stretch of least length moves where words were put in or left out.
SHIFT = 2
#: Windows of one group in one slot, pairs compared at a time, and windows of groups whose pairs are made all at once.
HOT, PAIRS, FEW = 8192, 50_000, 64
#: Windows of a group that is not divided: a window is compared in less time than it takes to make its subgroups; windows of a group that are looked at for common shingles, and how many of them have one.
DIVIDE, LOOK, COMMON = 16_384, 256, 4
#: Places of a stretch's half that are compared before the others.
PROBE = 10

_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_ODD = np.array(_MULTIPLIERS, dtype=np.uint64)


#: The constants of 64-bit xxHash.
_XX = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\r\x0b\f")] = True


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _xxh64(text: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The 64-bit xxHash of every stretch of a text; 7 bytes follow the last one."""
    import xxhash

    p1, p2, p3, p4, p5 = _XX
    out = sizes.astype(np.uint64) + p5
    single = np.frombuffer(text, dtype=np.uint8)
    fours, eights = (np.ndarray(max(0, len(text) - n + 1), f"<u{n}", text, strides=(1,)) for n in (4, 8))
    for at in (0, 8, 16):
        some = np.flatnonzero(sizes >= at + 8)
        out[some] = _turned(out[some] ^ _turned(eights[starts[some] + at] * p2, 31) * p1, 27) * p1 + p4
    place, rest = starts + (sizes & ~7), sizes & 7
    some = np.flatnonzero(rest >= 4)
    out[some] = _turned(out[some] ^ fours[place[some]].astype(np.uint64) * p1, 23) * p2 + p3
    place[some] += 4
    rest &= 3
    for at in range(3):
        some = np.flatnonzero(rest > at)
        out[some] = _turned(out[some] ^ single[place[some] + at].astype(np.uint64) * p5, 11) * p1
    for by, factor in ((33, p2), (29, p3)):
        out = (out ^ (out >> np.uint64(by))) * factor
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(sizes >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(text[starts[i] : starts[i] + sizes[i]])
    return out


def hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of the words (see words_of) of several texts, end to end, and the number of words of each text."""
    whole = b"\n".join([*texts, bytes(8)]).lower()
    blank = _BLANK[np.frombuffer(whole, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
    starts, stops = edges[::2], edges[1::2]  # the last word is what was put behind the texts
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    starts = starts[:-1]
    return _xxh64(whole, starts, stops[: len(starts)] - starts), counts


def shingles_of(own: np.ndarray) -> np.ndarray:
    """The hash of every shingle of a sequence of words' hashes."""
    n = max(0, len(own) - SHINGLE + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE if n else 0):
        total = (total ^ own[k : k + n]) * _ODD[k]
        total ^= total >> np.uint64(29)
    return total


def shingles(text: str | None) -> np.ndarray:
    return shingles_of(hashes_of([(text or "").encode()])[0])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # on ASCII white space alone


def mixed(hashes: np.ndarray, function: int) -> np.ndarray:
    """One of the hash functions, over shingles."""
    out = (hashes ^ np.uint64((function + 1) * _MULTIPLIERS[1] % 2**64)) * _ODD[2]
    out ^= out >> np.uint64(31)
    out *= _ODD[3]
    return out ^ (out >> np.uint64(32))


def compact_windows(values: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c and r of the Cartesian trees' nodes whose interval has `least` positions or more; ties go left.

    l and r are less than `least` positions from c, unless its value repeats.
    `values` are the hashes of several texts of `sizes` shingles, end to end;
    positions are those in `values`. They stand in the lowest bits of what is
    compared, so that a minimum tells its place.
    """
    n = len(values)
    if n < least:
        return (np.zeros(0, dtype=np.int64),) * 3
    bits = np.uint64(n.bit_length())
    placed = (values >> bits << bits) | np.arange(n, dtype=np.uint64)
    # Minima of sliding windows from the minima of blocks' beginnings and ends.
    blocks = -(-n // least)
    grid = np.full(blocks * least, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[:n] = placed
    grid = grid.reshape(blocks, least)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    ends = np.cumsum(sizes)
    counts = np.maximum(sizes - least + 1, 0)  # windows within each text
    starts = np.repeat(ends - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    low = np.minimum(back[starts], ahead[starts + least - 1])
    if not len(low):
        return (np.zeros(0, dtype=np.int64),) * 3
    # Windows of one text with equal minima are one node's, also where the shingle repeats.
    least_value = low >> bits
    change = np.flatnonzero(np.append(True, (least_value[1:] != least_value[:-1]) | (np.diff(starts) > 1)))
    last = np.append(change[1:], len(low))[: len(change)] - 1
    centre = (low[change] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return starts[change], centre, starts[last] + least - 1


def order_codes(total: np.ndarray, c: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
    """A number for what is after the places c, or before them: places with more in common there have more leading bytes in common.

    `total` has the sums of the shingles' hashes before each place.
    """
    out = np.zeros(len(c), dtype=np.int64)
    for k in range(1, STEPS + 1):
        x, y = (c + 1, np.minimum(c + 1 + k * STEP, high)) if after else (np.maximum(c - k * STEP, low), c)
        part = (total[y] - total[x]) * _ODD[1]
        out = (out << 8) | (part >> np.uint64(56)).astype(np.int64)
    return out - (1 << 31)


def windows(docs: DataFrame, hashes: int = HASHES, least: int = LEAST) -> DataFrame:
    """key (min-hash, with its function's number below), print, l, c, r and beside (see order_codes) of all compact windows."""
    span = least - SHINGLE + 1

    def make():
        seen: set[int] = set()

        def work(batch):
            prints, texts = [], []
            for print_, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if print_ not in seen:
                    seen.add(print_)
                    prints.append(print_)
                    texts.append(text)
            words, sizes = hashes_of(texts)
            enough = sizes >= least
            words, sizes = words[np.repeat(enough, sizes)], sizes[enough]
            prints = np.array(prints, dtype=np.int64)[enough]
            # Shingles of all texts at once, without those that reach over an end.
            within = np.ones(max(0, len(words) - SHINGLE + 1), dtype=bool)
            for end in np.cumsum(sizes)[:-1].tolist():
                within[end - SHINGLE + 1 : end] = False
            own = shingles_of(words)[within]
            sizes = sizes - SHINGLE + 1
            offsets = np.cumsum(sizes) - sizes
            columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
            total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(own, HASHES), dtype=np.uint64)])
            for j in range(hashes if len(prints) else 0):
                values = mixed(own, j)
                l, c, r = compact_windows(values, sizes, span)
                key = (values[c] & ~np.uint64(7)) | np.uint64(j)
                text = np.searchsorted(offsets, c, side="right") - 1
                base = offsets[text]
                names = prints[text]
                beside = order_codes(total, c, base, base + sizes[text], after=j % 2 == 0)
                for column, x in zip(columns, (key.view(np.int64), names, l - base, c - base, r - base, beside)):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4)
            arrays = [pa.array(np.concatenate(c) if c else [], k) for c, k in zip(columns, kinds)]
            return pa.record_batch(arrays, ["key", "print", "l", "c", "r", "beside"])

        return work

    rows = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("print"), "text")
    return map_texts(rows, make, "key long, print long, l int, c int, r int, beside int")


LINKS = "a long, b long, j int, al int, ar int, bl int, br int"
MET = "key long, print long, l int, c int, r int, first long, first_l int, first_r int, last long, last_l int, last_r int"


def met(found: DataFrame) -> DataFrame:
    """The windows (key, print, l, c, r) of groups of two texts or more, with the group's first and the one before the text's.

    Rows are sorted by key and what is beside them. Of the first text, both are the window itself.
    """

    def run(batches):
        carry, told = np.zeros((5, 0), dtype=np.int64), 0  # the last key's rows so far, or its first and last if it is told
        for batch in _with_end(batches):
            rows = carry
            if batch is not None:
                if not batch.num_rows:
                    continue
                rows = np.hstack([carry, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])])
            if not rows.shape[1]:
                continue
            # Copies of a text in several tasks give equal windows, one behind the other.
            rows = rows[:, np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))]
            n = rows.shape[1]
            key, text = rows[0], rows[1]
            new_key = np.append(True, key[1:] != key[:-1])
            starts = np.flatnonzero(new_key)
            first = starts[np.cumsum(new_key) - 1]
            several = np.logical_or.reduceat(text != text[first], starts)[np.cumsum(new_key) - 1]
            if told:
                several |= key == key[0]
            # The window before the text's own run; its last row speaks for the run.
            run_start = np.flatnonzero(new_key | np.append(True, text[1:] != text[:-1]))
            run = np.repeat(run_start, np.diff(np.append(run_start, n)))
            before = np.where(run > first, run - 1, first)
            out = np.flatnonzero(several & (np.arange(n) >= told))
            columns = [*rows[:, out], *rows[[1, 2, 4]][:, first[out]], *rows[[1, 2, 4]][:, before[out]]]
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 3, *[pa.int64(), pa.int32(), pa.int32()] * 2]
            names = [x.split()[0] for x in MET.split(", ")]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds)], names)
            if several[-1]:
                ends = sorted({int(first[-1]), n - 1})
                carry, told = rows[:, ends], len(ends)
            else:
                carry, told = rows[:, first[-1] :], 0

    return found.mapInArrow(run, MET)


def linked(windows: DataFrame) -> DataFrame:
    """The links of the first round, from the windows that met."""
    sides = [windows.where(f"{x} <> print").select(*_link("print", "l", "r", x, f"{x}_l", f"{x}_r")) for x in ("first", "last")]
    return sides[0].unionByName(sides[1].where("last <> first"))


def _link(a: str, al: str, ar: str, b: str, bl: str, br: str) -> list:
    """A link's columns; a pair has one order, whichever function finds it."""
    swap = F.col(a) < F.col(b)
    two = lambda x, y, name: [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(f"a{name}"), F.when(swap, F.col(x)).otherwise(F.col(y)).alias(f"b{name}")]
    columns = [*two(a, b, ""), F.col("key").bitwiseAND(7).cast("int").alias("j"), *two(al, bl, "l"), *two(ar, br, "r")]
    return [columns[i] for i in (0, 1, 2, 3, 5, 4, 6)]


def apart(windows: DataFrame, classes: DataFrame, by: tuple[str, ...] = ("key",)) -> DataFrame:
    """The windows, with their class, of groups that are not of one class.

    `classes` has print, start, stop and class of the passages that are known; a window outside them is a class by its text.
    """
    inside = (F.col("start") <= F.col("c")) & (F.col("c") + SHINGLE <= F.col("stop"))
    own = windows.alias("w").join(classes.alias("p"), (F.col("w.print") == F.col("p.print")) & inside, "left")
    own = own.select("w.*", F.coalesce("p.class", "w.print").alias("class"))
    ends = own.groupBy(*by).agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return own.join(ends.where("low < high").select(*by), [*by], "left_semi")


def codes(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """print and codes, a byte for each shingle of a text, with as many zeros before and behind as a window can reach."""
    around = bytes(least - SHINGLE)

    def make():
        def work(batch):
            words, counts = hashes_of(batch.column(1).cast(pa.binary()).to_pylist())
            texts = np.split(words, np.cumsum(counts)[:-1])
            own = [mixed(shingles_of(x), HASHES + 1) >> np.uint64(56) for x in texts]
            # Zero stands for no shingle, which is shared with none.
            own = [around + (x.astype(np.uint8) | np.uint8(1)).tobytes() + around for x in own]
            return pa.record_batch([batch.column(0), pa.array(own, pa.binary())], ["print", "codes"])

        return work

    return map_texts(texts.select("print", "text"), make, "print long, codes binary")


def with_codes(windows: DataFrame, coded: DataFrame, least: int = LEAST) -> DataFrame:
    """The windows with near, the codes of the shingles within reach."""
    near = F.substring("codes", F.col("c") + 1, F.lit(2 * (least - SHINGLE) + 1))
    return windows.join(coded, "print").withColumn("near", near).drop("codes")


def first_shingles(order: np.ndarray, least: int, share: int) -> np.ndarray:
    """The different values that any stretch of `least` places, with SHIFT more on either side, needs to have one in common
    with another that shares `share` places; `order` has the values of all places within reach, NONE where there is none."""
    size = least + 2 * SHIFT
    padded = np.concatenate([np.full(SHIFT, NONE), order, np.full(SHIFT, NONE)])
    stretches = np.lib.stride_tricks.sliding_window_view(padded, size)
    found = np.unique(np.partition(stretches, size - share, axis=1)[:, : size - share + 1])
    return found[found != NONE]


NONE = np.int64(1 << 40)
#: Added to the value of a common shingle, so that it comes last.
LAST = np.int64(1 << 33)
#: Instead of a shingle: windows that common shingles may have to bring together, and those that their whole group is compared with.
STUCK, WHOLE = -1, -2
MARKS = "key long, v long, role int, print long, l int, c int, r int, class long"


def marks(windows: DataFrame, texts: DataFrame, least: int, similarity: float, every: bool) -> DataFrame:
    """The subgroups (key, v) of windows (key, print, l, c, r, class, common); or, of `every` window, all shingles within reach."""
    reach, span = least - SHINGLE, least - SHINGLE + 1
    share = _share(span, similarity)
    by_text = windows.groupBy("print").agg(F.collect_list(F.struct("key", "l", "c", "r", "class", "common")).alias("own"))
    names = ["key", "v", "role", "print", "l", "c", "r", "class"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 3, pa.int64()]

    def values_of(found, c):
        order = np.full(2 * reach + 1, NONE)
        low, high = max(0, c - reach), min(len(found), c + reach + 1)
        order[low - c + reach : high - c + reach] = found[low:high]
        return order

    def run(batches):
        for batch in batches:
            for piece in in_chunks(batch, 500_000, 1):
                out: list[list] = [[] for _ in names]
                for print_, text, own in zip(*(piece.column(n).to_pylist() for n in ("print", "text", "own"))):
                    found = (mixed(shingles(text), HASHES + 1) >> np.uint64(32)).astype(np.int64)
                    for w in own:
                        order = values_of(found, w["c"])
                        if every:
                            v = np.unique(order[order != NONE])
                        else:
                            there = order != NONE
                            repeats = any(((order[d:] == order[:-d]) & there[d:]).any() for d in range(1, 2 * SHIFT + 1))
                            if w["common"]:
                                order[np.isin(order, w["common"])] += LAST
                            v = first_shingles(order, span, share)
                            stuck = len(v) and v[-1] >= LAST
                            v = np.concatenate([v[v < LAST], [STUCK] * bool(stuck), [WHOLE] * repeats]).astype(np.int64)
                        row = (w["key"], v, 0, print_, w["l"], w["c"], w["r"], w["class"])
                        for column, x in zip(out, row):
                            column.append(x if x is v else np.full(len(v), x, dtype=np.int64))
                columns = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds)], names)

    rows = texts.join(by_text, "print").select("print", "text", "own")
    return rows.mapInArrow(run, MARKS)


def divided(
    rows: DataFrame, texts: DataFrame, scratch: Scratch, least: int = LEAST, similarity: float = SIMILARITY, divide: int = DIVIDE
) -> DataFrame:
    """The windows (see apart) by the subgroups (key, v) in which they are compared.

    `role` is null where all windows of a subgroup are compared with each other, or else 0 for those
    that are compared with all that have 1. Large groups are divided by shingles, others are one subgroup.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > divide)
    sizes = scratch.staged(sizes, "sizes")
    whole = lambda df, v, role: df.select("key", F.lit(v).cast("long").alias("v"), F.lit(role).cast("int").alias("role"), "print", "l", "c", "r", "class")
    small = whole(rows.join(sizes, "key", "left_anti"), 0, None)
    if sizes.isEmpty():
        return small
    large = scratch.staged(rows.join(sizes, "key"), "large")
    # The sample decides the order only, which any order may be; it is the same for all windows of a group.
    some = large.where(F.pmod(F.xxhash64("print"), F.ceil(F.col("n") / LOOK)) == 0).withColumn("common", F.lit(None).cast("array<long>"))
    seen = marks(some, texts, least, similarity, True).groupBy("key", "v").agg(F.count(F.lit(1)).alias("times"))
    common = seen.where(F.col("times") >= COMMON).groupBy("key").agg(F.collect_list("v").alias("common"))
    found = marks(large.join(common, "key", "left"), texts, least, similarity, False)
    group = Window.partitionBy("key", "v")
    found = found.select("*", F.min("class").over(group).alias("low"), F.max("class").over(group).alias("high"))
    found = scratch.staged(found.where(f"low < high OR v = {WHOLE}").drop("low", "high"), "marks")
    asks = found.where(F.col("v") == WHOLE)
    answers = whole(large.join(asks.select("key").distinct(), "key", "left_semi"), WHOLE, 1)
    parts = found.withColumn("role", F.when(F.col("v") == WHOLE, F.col("role")))
    return small.unionByName(parts).unionByName(answers)


def _share(least: int, similarity: float) -> int:
    """Places that a stretch of least length shares at least."""
    return int(np.ceil(2 * similarity / (1 + similarity) * least - 1e-6))


def similar_places(a: np.ndarray, b: np.ndarray, least: int, similarity: float = SIMILARITY) -> np.ndarray:
    """Of rows of codes around a shared shingle, which pairs (a row of each) may hold a stretch of `least` places that is similar."""
    width = a.shape[1]
    share = _share(least, similarity)
    likely = _likely(a, b, least, share)
    if not likely.all():
        likely[likely] = similar_places(a[likely], b[likely], least, similarity) if likely.any() else False
        return likely
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    there = np.zeros(a.shape, dtype=bool)
    for shift in range(-SHIFT, SHIFT + 1):
        x, y = slice(max(0, shift), width + min(0, shift)), slice(max(0, -shift), width - max(0, shift))
        there[x] |= (a[x] == b[y]) & (a[x] != 0)
    out = there.sum(axis=0, dtype=np.uint8 if width < 256 else np.int32) >= share
    rest = np.flatnonzero(out)
    if len(rest):
        total = np.cumsum(there[:, rest], axis=0, dtype=np.int32)
        best = (total[least - 1 :] - np.vstack([np.zeros((1, len(rest)), dtype=np.int32), total[: width - least]])).max(axis=0)
        first, last = there[:, rest].argmax(axis=0), width - 1 - there[::-1, rest].argmax(axis=0)
        out[rest] = (best >= share) & (last - first + 1 >= least)
    return out


def _likely(a: np.ndarray, b: np.ndarray, least: int, share: int) -> np.ndarray:
    """Whether enough of the outer PROBE places are shared in one of the halves, before and behind, that any stretch has one of in full."""
    half, middle = (least - 1) // 2, a.shape[1] // 2
    size = min(PROBE, half - SHIFT)
    out = np.zeros(len(a), dtype=bool)
    if size <= least - share:
        return ~out
    for start in (middle + half - size + 1, middle - half):
        x, y = (np.ascontiguousarray(side[:, start - SHIFT : start + size + SHIFT].T) for side in (a, b))
        own = x[SHIFT : SHIFT + size]
        there = np.zeros(own.shape, dtype=bool)
        for shift in range(2 * SHIFT + 1):
            there |= own == y[shift : shift + size]
        there &= own != 0
        out |= there.sum(axis=0, dtype=np.uint8) >= size - (least - share)
    return out


def half_bits(near: np.ndarray, least: int, share: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """own, around and most for the half before and the half behind, one of which any stretch has in full.

    Of own's bits at most `most` are not among the other window's `around` if the half may be in a stretch that the two share:
    own has a bit for every code of the half, around one for every code that SHIFT places more may hold.
    """
    half, middle, allowed = (least - 1) // 2, near.shape[1] // 2, least - share
    bits = np.where(near != 0, np.uint64(1) << (near >> 1 & 63).astype(np.uint64), np.uint64(0))
    out = []
    for start in (middle - half, middle + 1):
        own = np.bitwise_or.reduce(bits[:, start : start + half], axis=1)
        around = np.bitwise_or.reduce(bits[:, max(0, start - SHIFT) : start + half + SHIFT], axis=1)
        # Places without a shingle are not shared; where they are too many, no other half has all bits.
        most = allowed - (near[:, start : start + half] == 0).sum(axis=1)
        own = np.where(most < 0, np.iinfo(np.uint64).max, own)
        out.append((own, ~around, np.maximum(most, 0).astype(np.uint8)))
    return out


PLACES = "array<struct<slot: int, role: int>>"


def slotted(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """The windows (see divided) with the number of slots over which their subgroup is dealt, null for one that is not."""
    if "v" not in rows.columns:
        rows = rows.withColumn("v", F.lit(0).cast("long")).withColumn("role", F.lit(None).cast("int"))
    large = rows.where(F.coalesce(F.col("role"), F.lit(0)) == 0).groupBy("key", "v").agg(F.count(F.lit(1)).alias("n"))
    large = large.where(F.col("n") > hot).select("key", "v", F.ceil(F.col("n") / hot).cast("int").alias("slots"))
    return rows.join(large, ["key", "v"], "left")


def other_links(rows: DataFrame, least: int, similarity: float = SIMILARITY, every: bool = True, hot: int = HOT) -> DataFrame:
    """The links between all windows (see divided, slotted, with_codes) of a subgroup that are not of one class and may hold a passage.

    Or else, of every window and slot, the first one that was found.
    """
    span = least - SHINGLE + 1
    if "slots" not in rows.columns:
        rows = slotted(rows, hot)
    alone = F.col("slots").isNull() & F.col("role").isNull()
    slots = F.coalesce("slots", F.lit(1))
    # Of a small group those that ask are also those that answer.
    place = lambda slot, role: F.struct(slot.cast("int").alias("slot"), F.lit(role).alias("role"))
    asks = F.when(F.coalesce("role", F.lit(0)) == 0, F.array(place(F.pmod(F.xxhash64("print"), slots), 0)))
    answers = F.when(~alone & F.coalesce(F.col("role") == 1, F.lit(True)), F.transform(F.sequence(F.lit(0), slots - 1), lambda x: place(x, 1)))
    places = F.explode(F.concat(F.coalesce(asks, F.array().cast(PLACES)), F.coalesce(answers, F.array().cast(PLACES))))
    dealt = rows.select("key", places.alias("place"), "print", "l", "r", "class", "near", alone.alias("alone"), "v")
    dealt = dealt.select("key", "place.slot", "place.role", "print", "l", "r", "class", "near", "alone", "v")
    dealt = dealt.repartition("key", "v", "slot").sortWithinPartitions("key", "v", "slot", "role")
    names = ["a", "b", "j", "al", "ar", "bl", "br"]

    def table(key, text, l, r, left, right):
        columns = (text[left], text[right], key[left] & 7, l[left], r[left], l[right], r[right])
        kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 5)
        return pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds)], names)

    share = _share(span, similarity)

    def close(halves, x, y):
        """Which windows have enough codes of a half in common; x and y are of one shape, or span a grid."""
        out = False
        for own, others, most in halves:
            out = out | (np.bitwise_count(own[x] & others[y]) <= most[x])
        return out

    def pairs(columns, near):
        """Those that ask and those that answer, as far as they are of two texts and classes and close, group by group."""
        key, slot, role, text, l, r, kind, alone, v = columns
        halves = half_bits(near, span, share)
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (v[1:] != v[:-1]) | (slot[1:] != slot[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        # All pairs of all small groups at once.
        few = (alone[starts] != 0) & (sizes <= FEW)
        place = np.arange(len(key)) - np.repeat(starts, sizes)
        before = np.where(np.repeat(few, sizes), place, 0)  # partners of each window
        left = np.repeat(np.arange(len(key)), before)
        right = np.arange(len(left)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(np.arange(len(key)) - place, before)
        apart = (kind[left] != kind[right]) & (text[left] != text[right])
        left, right = left[apart], right[apart]
        swap = text[left] < text[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        found = close(halves, left, right)
        left, right = left[found], right[found]
        for at in range(0, len(left), PAIRS):
            yield left[at : at + PAIRS], right[at : at + PAIRS]
        lefts, rights, waiting = [], [], 0
        for start, stop in zip(starts[~few].tolist(), (starts + sizes)[~few].tolist()):
            mine = slice(start, stop) if alone[start] else slice(start, start + int((role[start:stop] == 0).sum()))
            other = mine if alone[start] else slice(mine.stop, stop)
            step = max(1, PAIRS // max(1, mine.stop - mine.start))
            x = np.arange(mine.start, mine.stop)[:, None]
            for at in range(other.start, other.stop, step):
                y = np.arange(at, min(at + step, other.stop))[None, :]
                i, k = np.nonzero(close(halves, x, y) & (kind[x] != kind[y]) & (text[x] > text[y]))
                lefts.append(i + mine.start)
                rights.append(k + at)
                waiting += len(i)
                if waiting >= PAIRS:
                    yield np.concatenate(lefts), np.concatenate(rights)
                    lefts, rights, waiting = [], [], 0
        if waiting:
            yield np.concatenate(lefts), np.concatenate(rights)

    def run(batches):
        held, near_held = [np.zeros(0, dtype=np.int64)] * 9, np.zeros((0, 2 * span - 1), dtype=np.uint8)
        for batch in _with_end(batches):
            columns, near = held, near_held
            if batch is not None:
                if not batch.num_rows:
                    continue
                new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 3, 4, 5, 6, 8, 9)]
                columns = [np.concatenate(x) for x in zip(held, new)]
                codes = np.frombuffer(b"".join(batch.column(7).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
                near = np.concatenate([near_held, codes])
            key, slot, role, alone, v = (columns[i] for i in (0, 1, 2, 7, 8))
            if not len(key):
                continue
            # What is left for the next batch: the last group, without those that have answered.
            last = (key == key[-1]) & (v == v[-1]) & (slot == slot[-1])
            done = np.ones(len(key), dtype=bool)
            if batch is not None and (alone[-1] or role[-1] == 0):
                done = ~last
            now = [c[done] for c in columns]
            if len(now[0]):
                now_near = near[done]
                for left, right in pairs(now, now_near):
                    holds = similar_places(now_near[left], now_near[right], span, similarity)
                    left, right = left[holds], right[holds]
                    if not every:
                        right, at = np.unique(right, return_index=True)
                        left = left[at]
                    if len(left):
                        yield table(now[0], now[3], now[4], now[5], left, right)
            stay = last & ((alone == 1) | (role == 0))
            held, near_held = [c[stay] for c in columns], near[stay]

    return dealt.mapInArrow(run, LINKS)


CANDIDATES = "a long, b long, al int, ar int, bl int, br int"


def candidates(links: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """Stretches of two texts in which windows of enough functions overlap; links sorted by a, b and al."""

    def run(batches):
        carry = None
        for batch in _with_end(batches):
            rows = None
            if batch is not None and batch.num_rows:
                rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            if carry is not None:
                rows = carry if rows is None else np.hstack([carry, rows])
            if rows is None:
                continue
            a, b, j, al, ar, bl, br = rows
            pair = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            if batch is not None:  # the last pair may go on
                stop = int(np.flatnonzero(pair)[-1])
                carry = rows[:, stop:]
                if not stop:
                    continue
                a, b, j, al, ar, bl, br = rows[:, :stop]
                pair = pair[:stop]
            number = np.cumsum(pair)
            reach = np.maximum.accumulate(ar + number * (1 << 32)) - number * (1 << 32)
            cut = pair | np.append(True, al[1:] > reach[:-1])
            at = np.flatnonzero(cut)
            functions = np.bitwise_count(np.bitwise_or.reduceat(np.left_shift(1, j), at))
            keep = functions >= enough
            columns = (
                a[at], b[at], np.minimum.reduceat(al, at), np.maximum.reduceat(ar, at),
                np.minimum.reduceat(bl, at), np.maximum.reduceat(br, at),
            )
            kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4)
            yield pa.record_batch([pa.array(x[keep], k) for x, k in zip(columns, kinds)], ["a", "b", "al", "ar", "bl", "br"])

    return links.mapInArrow(run, CANDIDATES)


def _with_end(batches):
    yield from batches
    yield None


def _among(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which of the values are among others, which are sorted."""
    if not len(ranked):
        return np.zeros(len(values), dtype=bool)
    return ranked[np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)] == values


def passages(a: np.ndarray, b: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int]]:
    """Similar stretches (first and last position in a and in b) of two sequences of shingles.

    Runs of shared shingles are joined as long as enough of the stretch is
    shared; a stretch that is not similar in the end is cut at its widest gap.
    """
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    shared = _among(a, ranked)
    if shared.sum() < similarity * least:
        return []
    share = 2 * similarity / (1 + similarity)  # of both stretches, for this Jaccard similarity
    edges = np.flatnonzero(np.diff(np.concatenate([[0], shared.view(np.int8), [0]])))
    todo: list[list[tuple[int, int]]] = []  # stretches, as runs
    total = 0
    for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if todo and total + stop - start >= share * (stop - todo[-1][0][0]):
            todo[-1].append((start, stop))
            total += stop - start
        else:
            todo.append([(start, stop)])
            total = stop - start
    out = []
    while todo:
        runs = todo.pop()
        first, last = runs[0][0], runs[-1][1] - 1
        if last - first + 1 < least:
            continue
        where = _there(a[first : last + 1], b, order, ranked, similarity)
        if where:
            out.append((first, last, *where))
        elif len(runs) > 1:
            gaps = [y[0] - x[1] for x, y in zip(runs, runs[1:])]
            cut = gaps.index(max(gaps)) + 1
            todo += [runs[:cut], runs[cut:]]
    return out


def _there(own: np.ndarray, b: np.ndarray, order: np.ndarray, ranked: np.ndarray, similarity: float) -> tuple[int, int] | None:
    """The stretch of b that is similar to own, at the shift that most shared shingles have."""
    mine = np.unique(own)
    left = np.searchsorted(ranked, own)
    hits = np.flatnonzero((left < len(b)) & (ranked[np.minimum(left, len(b) - 1)] == own))
    shifts, counts = np.unique(order[left[hits]] - hits, return_counts=True)
    shift = int(shifts[counts.argmax()])
    spots = order[left[hits]]
    close = spots[np.abs(spots - hits - shift) <= len(own) // 4]
    for low, high in ((int(close.min()), int(close.max())), (max(0, shift), min(len(b), shift + len(own)) - 1)):
        there = np.unique(b[low : high + 1])
        both = _among(mine, there).sum()
        if both >= similarity * (len(mine) + len(there) - both):
            return low, high
    return None


def verified(found: DataFrame, texts: DataFrame, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """print, start, stop (words) and other, other_start, other_stop of the passages that hold, once for each pair; texts has print and text."""

    def cut(batches):
        known, words = None, []  # rows of one text follow each other, as a rule
        for batch in batches:
            out = []
            text = batch.column("text")
            for row, (print_, i, j) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("a", "al", "ar")))):
                if print_ != known:
                    known, words = print_, words_of(text[row].as_py())
                out.append(b" ".join(words[i : j + SHINGLE]))
            names = ["a", "b", "al", "bl", "br"]
            yield pa.record_batch([*[batch.column(n) for n in names], pa.array(out, pa.binary())], [*names, "own"])

    slices = found.join(texts, found["a"] == texts["print"]).select("a", "b", "al", "ar", "bl", "br", "text")
    slices = slices.mapInArrow(cut, "a long, b long, al int, bl int, br int, own binary")
    bases = texts.join(found.select(F.col("b").alias("print")).distinct(), "print", "left_semi")
    nothing = F.lit(None).cast("int")
    bases = bases.select(
        F.lit(None).cast("long").alias("a"), F.col("print").alias("b"), nothing.alias("al"), nothing.alias("bl"),
        nothing.alias("br"), F.col("text").cast("binary").alias("own"),
    )
    # A text that many others are compared with is held once; the others stream by.
    together = bases.unionByName(slices).repartition("b").sortWithinPartitions("b", F.col("a").asc_nulls_first())
    span = least - SHINGLE + 1

    def compare(batches):
        base = np.zeros(0, dtype=np.uint64)
        for piece in (piece for batch in batches for piece in in_chunks(batch, 2_000_000, 5)):
            out = []
            *columns, own = (c.to_pylist() for c in piece.columns)
            words, counts = hashes_of(own)
            for a, b, al, bl, br, mine in zip(*columns, np.split(words, np.cumsum(counts)[:-1])):
                if a is None:
                    base = shingles_of(mine)
                    continue
                for first, last, low, high in passages(shingles_of(mine), base[bl : br + 1], span, similarity):
                    out.append((a, al + first, al + last + SHINGLE, b, bl + low, bl + high + SHINGLE))
            columns = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int32()) * 2
            names = ["print", "start", "stop", "other", "other_start", "other_stop"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return together.mapInArrow(compare, "print long, start int, stop int, other long, other_start int, other_stop int")


def _passages(spans: DataFrame, whole: DataFrame) -> DataFrame:
    """print, start, stop, link, passage (overlapping stretches of a text are one, numbered from 0) and node of verified pairs and whole texts."""
    link = F.xxhash64("print", "start", "stop", "other", "other_start", "other_stop")
    sides = F.array(F.struct("print", "start", "stop"), F.struct(F.col("other").alias("print"), F.col("other_start").alias("start"), F.col("other_stop").alias("stop")))
    spans = spans.select(F.explode(sides).alias("s"), link.alias("link")).select("s.print", "s.start", "s.stop", "link")
    spans = spans.unionByName(whole.withColumn("link", F.lit(None).cast("long")))
    ordered = Window.partitionBy("print").orderBy("start", "stop")
    reach = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1))
    spans = spans.withColumn("passage", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast("int") - 1)
    return spans.drop("new").withColumn("node", F.xxhash64("print", "passage"))


def _classes(sides: DataFrame) -> DataFrame:
    """The sides of verified pairs (see _passages) with the class of their passages."""
    ends = sides.where(F.col("link").isNotNull()).groupBy("link").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    return sides.join(components(ends.select("a", "b")), "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")


def repeated_passages(docs: DataFrame, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, passage (from 0), start_word, n_words, first_doc_id and class_id of every stretch that repeats in another document.

    Stretches that repeat each other have one class_id, and no others have it; first_doc_id is the smallest doc_id of
    all documents with a stretch of the class, the document's own included.
    """
    known = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("print"), F.regexp_count("text", F.lit(WORD)).alias("n_words")
    )
    known = staged(known.distinct(), "passage-documents")
    first = known.groupBy("print").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("n_words")
    )
    first = staged(first, "passage-first")
    whole = first.where(F.col("copies") > 1).where(F.col("n_words") >= least)
    whole = whole.select("print", F.lit(0).alias("start"), F.col("n_words").alias("stop"))
    with Scratch(docs.sparkSession, "passages") as scratch:
        found = windows(docs.select("text"), HASHES, least).repartition("key")
        found = found.sortWithinPartitions("key", "beside", "print", "c").select("key", "print", "l", "c", "r")
        found = scratch.staged(met(found), "windows")
        texts = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("print"), "text")
        texts = texts.join(found.select("print").distinct(), "print", "left_semi").dropDuplicates(["print"])
        texts = scratch.staged(texts, "texts")
        pairs = candidates(linked(found).repartition("a", "b").sortWithinPartitions("a", "b", "al"))
        pairs = scratch.staged(pairs, "candidates")
        spans = scratch.staged(verified(pairs, texts, least, similarity), "spans")
        rest = None
        for every in (False, True):
            classes = _classes(scratch.staged(_passages(spans, whole), "passages"))
            classes = classes.groupBy("print", "passage", "class").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            classes = scratch.staged(classes, "classes")
            if rest is None:
                coded = scratch.staged(codes(texts, least), "codes")
                rest = scratch.staged(apart(found, classes).select("key", "print", "l", "c", "r", "class"), "apart")
                rest = scratch.staged(divided(rest, texts, scratch, least, similarity), "divided")
            else:
                rest = scratch.staged(apart(rest.drop("class"), classes, ("key", "v")), "apart")
            # Subgroups are counted before the codes come to the windows, which is done once.
            more = other_links(with_codes(slotted(rest), coded, least), least, similarity, every)
            more = more.repartition("a", "b").sortWithinPartitions("a", "b", "al")
            more = scratch.staged(candidates(more, 1), "more-candidates")
            spans = scratch.staged(spans.unionByName(verified(more, texts, least, similarity)).distinct(), "more-spans")
        spans = staged(_passages(spans, whole), "passage-sides")
    spans = _classes(spans)
    merged = spans.groupBy("print", "passage", F.col("class").alias("class_id")).agg(
        F.min("start").alias("start_word"), (F.max("stop") - F.min("start")).cast("int").alias("n_words")
    )
    merged = staged(merged.select("print", "passage", "start_word", "n_words", "class_id"), "passage-merged")
    smallest = merged.join(first.select("print", "first"), "print").groupBy("class_id").agg(F.min("first").alias("first_doc_id"))
    merged = merged.join(smallest, "class_id")
    return known.select("doc_id", "print").join(merged, "print").select(
        "doc_id", "passage", "start_word", "n_words", "first_doc_id", "class_id"
    )
