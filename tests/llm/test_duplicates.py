"""Near-duplicate operators and the pipeline, against brute force."""

import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sitewright.llm import op01_simhash, op04_lines, op08_passages
from sitewright.llm.common import Scratch
from sitewright.llm.components import components
from sitewright.sources.files import names, shared_folder, staged

from llm.conftest import prose


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(1000, 1200)]
    pairs += [(i, i + 1) for i in range(2000, 2060)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    roots = union(2100, pairs)
    assert got == {x: roots[x] for a, b in pairs if a != b for x in (a, b)} | {
        x: roots[x] for x in got
    }
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(g.encode(), 42) >> i & 1 for g in grams) for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(grams))


def test_fingerprints_and_groups(odd):
    rows = op01_simhash.near_duplicates(odd).collect()
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in rows) == sorted((i or -1, f"{plain_fingerprint(t):016x}") for i, t in texts)
    group = {r.doc_id: r.component_id for r in rows if r.doc_id}
    assert group[1] == group[2] == group[3] == 1 and group[4] == group[5] == 4 and group[7] == 7
    assert op01_simhash.near_duplicates(odd.limit(0)).collect() == []
    kept = op01_simhash.representatives(odd, op01_simhash.near_duplicates(odd))
    assert kept.columns == odd.columns and {1, 4, 7, 8} <= {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("hot", [op01_simhash.HOT, 3])
def test_no_link_between_fingerprints_is_lost(spark, hot):
    rng = np.random.default_rng(hot)
    bases = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(bases.tolist()) | {0}
    for base in bases.tolist():
        for _ in range(20):
            value = base
            for bit in rng.choice(64, rng.integers(1, 9), replace=False).tolist():
                value ^= 1 << bit
            fps.add(value)
    fps = np.array(sorted(fps), dtype=np.uint64)
    signed = [int(x) for x in fps.view(np.int64)]
    links = op01_simhash.linked(spark.createDataFrame([(x,) for x in signed], "fp long"), hot=hot).collect()
    at = {x: i for i, x in enumerate(signed)}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4]
    assert union(len(fps), [(at[r.a], at[r.b]) for r in links]) == union(len(fps), near)


def five_word_similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_near_copies_at_eight_tenths(documents):
    """Of texts at similarities of 0.8 and more at least nine in ten are caught; others stay."""
    rng, docs, near, far = random.Random(3), [], set(), 0
    for k in range(150):
        words = prose(3000 + k, rng.choice([120, 200, 400]))
        other = list(words)
        edits = rng.choice([1, 2, 3, 4]) * len(words) // 200 or 1
        for at in rng.sample(range(5, len(words) - 5), edits if k % 5 else len(words) // 12):
            other[at] = rng.choice(["x1", "y2", "z3"])
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other).upper() if k % 7 == 0 else " ".join(other))]
        if five_word_similarity(docs[-2][1].lower(), docs[-1][1].lower()) >= 0.8:
            near.add(2 * k)
        else:
            far += 1
    got = {r.doc_id: r.component_id for r in op01_simhash.near_copies(documents(*docs)).collect()}
    caught = {i for i in range(0, 300, 2) if got[i + 1] == i}
    assert len(near) > 80 and far > 20
    assert caught <= near and len(caught) >= 0.9 * len(near)
    assert all(got[i] in (i, i - 1) for i in got)


@pytest.mark.parametrize("functions", [1, op01_simhash.FUNCTIONS])
def test_near_copies_at_the_threshold_are_all_found(documents, functions):
    """Pairs just above a similarity of 0.8, and texts that share long parts; none may be missed, however few fingerprints."""
    rng, docs, near = random.Random(11), [], set()
    part = prose(77, 60)
    for k in range(120):
        words = [*prose(5000 + k, rng.choice([60, 90, 150])), *(part if k % 3 else [])]
        other = list(words)
        for at in range(20, len(words) - 7, 48):
            other[at] = "changed"
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        if five_word_similarity(docs[-2][1], docs[-1][1]) >= 0.8:
            near.add(2 * k)
    got = {r.doc_id: r.component_id for r in op01_simhash.near_copies(documents(*docs), functions).collect()}
    assert 60 < len(near) and {i for i in range(0, 240, 2) if got[i + 1] == i} == near
    assert all(got[i] in (i, i - 1) for i in got)


@pytest.mark.parametrize("hot", [op01_simhash.HOT, 3])
def test_missed_pairs_are_all_that_are_similar(spark, documents, hot):
    rng = random.Random(hot)
    bases = [prose(6000 + k, 80) for k in range(6)]
    texts = sorted({" ".join([*b[:i], *prose(i, rng.randint(0, 2)), *b[i:]]) for b in bases for i in (rng.randint(0, 80) for _ in range(10))})
    docs = documents(*enumerate(texts))
    prints = op01_simhash.word_prints(texts).to_pylist()
    roots = spark.createDataFrame([(p, prints[i - i % 4]) for i, p in enumerate(prints)], "node long, root long")
    found = op01_simhash.prefixes(docs, common=4)
    got = {(r.a, r.b) for r in op01_simhash.missed_pairs(found, roots, hot=hot).collect()}
    want = {
        tuple(sorted((prints[i], prints[j]))) for i in range(len(texts)) for j in range(i)
        if i // 4 != j // 4 and five_word_similarity(texts[i], texts[j]) >= 0.8
    }
    assert len(want) > 30 and want <= got


def test_near_copies_of_odd_rows(odd):
    out = op01_simhash.representatives(odd)
    assert out.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in out.collect())
    # 1, 2 and 3 have no words, 4 to 6 are near copies, one with and one without an id.
    assert ids == sorted(map(str, [1, 4, 7, 8, 9, 10, 11]))
    assert op01_simhash.representatives(odd.limit(0)).collect() == []


def plain_removed(docs):
    places = [(i, n, line.strip(" ")) for i, text in docs for n, line in enumerate((text or "").split("\n")) if line.strip(" ")]
    lines = sorted({p[2] for p in places})
    sets = [{line.encode()[i : i + 9] for i in range(max(1, len(line.encode()) - 8))} for line in lines]
    pairs = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = dict(zip(lines, union(len(lines), pairs)))
    seen, gone = set(), {i: [] for i, _ in docs}
    for i, n, line in sorted(places):
        if root[line] in seen:
            gone[i].append(n)
        seen.add(root[line])
    return gone


@pytest.mark.parametrize("pairwise", [32, 2])
def test_lines(documents, pairwise):
    docs = []
    base = prose(1, 60)
    for i in range(40):
        changed = list(base)
        changed[i % 60] = "zzz"
        own = " ".join(prose(100 + i, 50))
        docs.append((i, "\n".join(["", " ".join(changed if i % 3 else base) + " " * (i % 2), own, "short", own if i % 5 == 0 else "s%d" % i])))
    got = {r.doc_id: r.removed for r in op04_lines.line_report(documents(*docs), pairwise=pairwise).collect()}
    assert got == plain_removed(docs)


def test_repetitive_lines(documents):
    docs = []
    for i in range(20):
        phrase = " ".join(prose(900 + i, 60))[:39] + " "
        docs += [(10 * i + k, phrase * times) for k, times in enumerate((50, 60, 120))]
    docs += [(1000 + k, "-" * k + "=" * k) for k in (40, 60, 300, 900)]
    got = {r.doc_id: r.removed for r in op04_lines.line_report(documents(*docs)).collect()}
    assert got == plain_removed(docs) and sum(map(len, got.values())) >= 42


def test_shingles_of_a_long_line_take_linear_time(spark):
    """Read as a column in the inner lambda, the line would be copied once for every shingle: a terabyte here."""
    raw = random.Random(12).randbytes(1_000_000)
    lines = spark.createDataFrame([(bytearray(raw),), (bytearray(b"short"),), (bytearray(raw[:10]),)], "raw binary")
    began = time.monotonic()
    got = [r[0] for r in lines.select(F.size(F.array_distinct(op04_lines.shingles("raw")))).collect()]
    assert got == [len({raw[i : i + 9] for i in range(len(raw) - 8)}), 1, 2]
    assert time.monotonic() - began < 30


def test_templated_lines(documents):
    """Many lines with a long common part that is not enough, few of which are similar."""
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)).strip().ljust(n, "z")
    common = letters(200)
    lines = [common + letters(30) for _ in range(150)]
    lines += [line[:210] + letters(k) + line[210 + k :] for line in lines[:12] for k in (1, 9)]
    rng.shuffle(lines)
    docs = list(enumerate(lines))
    want = plain_removed(docs)
    assert 0 < sum(map(len, want.values())) <= 24
    got = {r.doc_id: r.removed for r in op04_lines.line_report(documents(*docs)).collect()}
    assert got == want


@pytest.mark.parametrize("hot", [op04_lines.HOT, 3])
def test_rare_shingles_find_all_similar_pairs(spark, hot):
    rng = random.Random(hot)
    bases = ["".join(rng.choice("abcd") for _ in range(rng.randint(60, 250))) for _ in range(12)]
    lines = {b[:i] + rng.choice("xy") * rng.randint(0, 3) + b[i:] for b in bases for i in (rng.randint(0, len(b)) for _ in range(8))}
    sets = {h: {x.encode()[i : i + 9] for i in range(max(1, len(x) - 8))} for h, x in enumerate(sorted(lines))}
    texts = spark.createDataFrame([(h, x.encode()) for h, x in enumerate(sorted(lines))], "h long, raw binary")
    rows = spark.createDataFrame([(h, h % 60) for h in sets], "h long, root long")
    signed = op04_lines.signatures(texts.withColumn("times", F.lit(1).cast("long"))).drop("times")
    with Scratch(spark, "lines") as scratch:
        found = op04_lines.rare_pairs(rows, texts, signed.withColumn("n", F.lit(0)), scratch, hot=hot)
        got = {(min(r.a, r.b), max(r.a, r.b)) for r in found.collect()}
    pairs = [(a, b) for a in sets for b in sets if a < b and a % 60 != b % 60]
    want = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    # The signatures may lose one pair in a hundred or two.
    assert len(want) > 20 and len(want & got) >= 0.97 * len(want)


def plain_signature(line):
    """The minima by their definition, with the same hash."""
    raw = line.encode()
    hashes = [xxhash.xxh64(raw[i : i + 9], seed=42).intdigest() for i in range(max(1, len(raw) - 8))]
    low = {}
    for v in (h - (1 << 64) if h >> 63 else h for h in hashes):
        j = ((v + (1 << 63)) * 18) >> 64
        low[j] = min(low.get(j, v), v)
    ring = lambda j: next(low[(j + k) % 18] for k in range(18) if (j + k) % 18 in low)
    return [ring(j) & ((1 << 31) - 1) for j in range(18)]


def test_signatures_are_the_minima_of_bins(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choice("abc de") for _ in range(n)) or "x" for n in (1, 5, 9, 12, 30, 60, 90, 200, 700, 3000)] + ["- " * 90, "é中😀" * 9]
    frame = spark.createDataFrame([(i, x.encode(), 1) for i, x in enumerate(lines)], "h long, raw binary, times long")
    got = {r.h: list(r.sig) for r in op04_lines.signatures(frame).collect()}
    assert got == {i: plain_signature(x) for i, x in enumerate(lines)}


def test_recall_of_similar_lines(documents):
    """Pairs of random lines at similarities of 0.8 and more; nine in ten have to be found, at least."""
    rng = random.Random(12)
    docs, near = [], 0
    for k in range(250):
        base = list("".join(rng.choice("abcdefghij klm") for _ in range(rng.randint(120, 400))))
        other = list(base)
        for at in rng.sample(range(10, len(base) - 10), max(1, len(base) // 130)):
            other[at] = "#"
        docs += [(2 * k, "".join(base)), (2 * k + 1, "".join(other))]
    want = sum(map(len, plain_removed(docs).values()))
    got = sum(len(r.removed) for r in op04_lines.line_report(documents(*docs)).collect())
    assert want >= 200 and 0.95 * want <= got <= want


def test_lines_leave_no_tables_behind(spark, documents, tmp_path):
    before = set(names(spark, shared_folder(spark)))
    op04_lines.line_report(documents((1, "one line here\nanother"), (2, "one line here"))).collect()
    after = set(names(spark, shared_folder(spark))) - before
    assert not [x for x in after if x.startswith("sitewright-lines")]


def test_lines_of_odd_rows(odd):
    out = op04_lines.deduplicated(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id}
    assert texts[1] is None and texts[2] == "" and texts[3] == " \n\t" and texts[11] == "line one\nLINE ONE  \n\nline two"
    assert op04_lines.line_report(odd.limit(0)).collect() == []


def test_compact_windows_are_the_tree_nodes():
    rng = np.random.default_rng(3)
    for sizes in ([30], [3, 50, 10, 9, 80], [10], [9]):
        values = rng.integers(0, 2**62, sum(sizes), dtype=np.uint64) << np.uint64(1)
        found = set(zip(*(x.tolist() for x in op08_passages.compact_windows(values, np.array(sizes), 10))))
        want, base = set(), 0
        for n in sizes:
            own = values[base : base + n].tolist()
            todo = [(0, n - 1)]
            while todo:
                left, right = todo.pop()
                if right - left + 1 >= 10:
                    c = min(range(left, right + 1), key=own.__getitem__)
                    want.add((base + max(left, c - 9), base + c, base + min(right, c + 9)))
                    todo += [(left, c - 1), (c + 1, right)]
            base += n
        assert found == want


def test_passages(documents):
    shared, other = prose(50, 70), prose(51, 60)
    rows = [(i, " ".join(prose(200 + i, 150))) for i in range(30)]
    for i in (3, 9, 17):
        own = prose(400 + i, 40 + i)
        rows.append((100 + i, " ".join([*own, *shared, *prose(500 + i, 30)])))
    rows += [(200, " ".join([*prose(600, 20), *other])), (201, " ".join([*other[:30], "changed", *other[31:], *prose(601, 90)]))]
    rows += [(300, rows[0][1]), (301, " ".join(prose(700, 40))), (302, " ".join(prose(700, 40))), (None, None), (303, "")]
    got = {}
    for r in op08_passages.repeated_passages(documents(*rows)).collect():
        got.setdefault(r.doc_id, []).append((r.start_word, r.n_words))
    assert set(got) == {0, 300, 103, 109, 117, 200, 201}
    for i in (3, 9, 17):
        [(start, n)] = got[100 + i]
        assert abs(start - (40 + i)) <= 1 and 69 <= n <= 72
    assert got[0] == got[300] == [(0, 150)]
    assert op08_passages.repeated_passages(documents((1, None)).limit(0)).collect() == []


@pytest.mark.parametrize("where", ["behind", "before", "both"])
def test_longer_passages_in_common_boilerplate(documents, where):
    """A hundred texts share 45 words, too few; two of them share six more, in each of several trials."""
    rows, pairs = [], {}
    for trial in range(6):
        common, more = prose(9000 + trial, 45), prose(9100 + trial, 6)
        texts = [[prose(trial * 1000 + i, 20), common, prose(trial * 1000 + 500 + i, 25)] for i in range(100)]
        for i in (17, 71):
            before, own, behind = texts[i]
            ahead = {"behind": 0, "before": 6, "both": 3}[where]
            texts[i] = [before, [*more[:ahead], *own, *more[ahead:]], behind]
        rows += [(1000 * trial + i, " ".join(w for part in text for w in part)) for i, text in enumerate(texts)]
        pairs[trial] = {1000 * trial + 17, 1000 * trial + 71}
    got = {}
    for r in op08_passages.repeated_passages(documents(*rows)).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, pairs.values()))


def test_changed_passages_in_common_boilerplate(documents):
    """Sixty texts share 45 words; two of them have twelve more behind, after a word that one of them has changed."""
    rows, pairs = [], {}
    for trial in range(12):
        common, more = prose(9300 + trial, 45), prose(9400 + trial, 12)
        behind = {17: ["former", *more], 41: ["changed", *more]}
        for i in range(60):
            text = [*prose(trial * 1000 + i, 20), *common, *behind.get(i, []), *prose(trial * 1000 + 500 + i, 25)]
            rows.append((1000 * trial + i, " ".join(text)))
        pairs[trial] = {1000 * trial + 17, 1000 * trial + 41}
    got = {}
    for r in op08_passages.repeated_passages(documents(*rows)).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, pairs.values()))


def test_windows_of_a_group_are_dealt_over_slots(spark):
    """All pairs of texts but those of one class, however the group is dealt."""
    rng = np.random.default_rng(4)
    near = rng.integers(1, 256, 91, dtype=np.uint8)
    far = rng.integers(1, 256, 91, dtype=np.uint8)
    rows = [(8, i, 0, 45, 90, bytes((far if i % 9 == 4 else near).tobytes()), i % 4) for i in range(60)]
    frame = spark.createDataFrame(rows, "key long, print long, l int, c int, r int, near binary, class long")
    want = {(i, j) for i in range(60) for j in range(i) if i % 4 != j % 4 and (i % 9 == 4) == (j % 9 == 4)}
    for hot in (2048, 7):
        links = op08_passages.other_links(frame, 50, hot=hot).collect()
        assert {(r.a, r.b) for r in links} == want and len(links) == len(want)


def test_hashes_of_words_are_those_of_xxhash():
    """Words of all lengths, of several texts at once, also of none."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("aBcé中😀 \t\n\x0b\x0c\x1c\x85\xa0") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    texts += ["x" * n for n in range(70)] + ["", " "]
    for some in (texts, [], [""], ["a"]):
        hashes, counts = op08_passages.hashes_of([t.encode() for t in some])
        words = [op08_passages.words_of(t) for t in some]
        assert counts.tolist() == [len(x) for x in words]
        assert hashes.tolist() == [xxhash.xxh64_intdigest(w) for x in words for w in x]


@pytest.mark.parametrize("sizes", [(2, 3, 40, 64), (65, 90)])
def test_pairs_that_halves_rule_out_are_not_similar(spark, sizes):
    """Links of small and large groups are those that codes alone give, with gaps, moved and missing places."""
    rng = np.random.default_rng(6)
    rows = []
    for group, size in enumerate(sizes):
        base = rng.integers(1, 256, 91, dtype=np.uint8) | 1
        for i in range(size):
            near = base.copy()
            side, shift = rng.integers(0, 2), rng.integers(-2, 3)
            if i % 3:  # one side is another's, and some places of the other one are
                near[46:] = np.where(side, near[46:], rng.integers(1, 256, 45) | 1)
                near[:45] = np.where(side, rng.integers(1, 256, 45) | 1, near[:45])
            if i % 5 == 0:
                near[47:] = np.roll(near[47:], shift)
            spots = rng.integers(0, 91, rng.integers(0, 9))
            near[spots] = np.where(i % 2, 0, rng.integers(1, 256, len(spots)) | 1)
            if i % 7 == 0:
                near[: rng.integers(0, 45)] = 0
            rows.append((8 * group, 100 * group + (i * 37) % size, 0, 45, 90, near.tobytes(), i % 11))
    frame = spark.createDataFrame(rows, "key long, print long, l int, c int, r int, near binary, class long")
    codes = {(key, text): np.frombuffer(near, dtype=np.uint8) for key, text, *_, near, _ in rows}
    kinds = {(key, text): kind for key, text, *_, kind in rows}
    pairs = [(x, y) for x in codes for y in codes if x[0] == y[0] and x[1] > y[1] and kinds[x] != kinds[y]]
    holds = op08_passages.similar_places(*(np.stack([codes[p[side]] for p in pairs]) for side in (0, 1)), 46)
    want = sorted((x[1], y[1]) for (x, y), similar in zip(pairs, holds.tolist()) if similar)
    assert 20 < len(want) < 0.9 * len(pairs)
    assert sorted((r.a, r.b) for r in op08_passages.other_links(frame, 50).collect()) == want


def test_groups_that_are_cheap_to_compare_are_not_divided(spark):
    """A thousand windows are one subgroup: shingles of theirs would be many more rows."""
    rows = [(8, i, 0, 45, 90, i) for i in range(1000)]
    windows = spark.createDataFrame(rows, "key long, print long, l int, c int, r int, class long")
    texts = spark.createDataFrame([(i, " ".join(prose(i, 100))) for i in range(1000)], "print long, text string")
    with Scratch(spark, "cheap") as scratch:
        got = op08_passages.divided(windows, texts, scratch).groupBy("key", "v", "role").count().collect()
    assert [tuple(r) for r in got] == [(8, 0, None, 1000)]


def test_equal_windows_of_several_tasks_are_one(spark):
    """Copies of a text that several tasks hold give equal windows, which meet others once."""
    rows = [(8, 1, 0, 45, 90), (8, 1, 0, 45, 90), (8, 1, 50, 95, 140), (8, 2, 0, 45, 90), (8, 2, 0, 45, 90), (16, 1, 0, 9, 90), (16, 1, 0, 9, 90)]
    for size in (1, 2, 100):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            frame = spark.createDataFrame(rows, "key long, print long, l int, c int, r int").coalesce(1)
            got = [(r.key, r.print, r.c) for r in op08_passages.met(frame).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(got) == [(8, 1, 45), (8, 1, 95), (8, 2, 45)]


def test_large_groups_are_divided_without_losing_pairs(spark):
    """Texts that share words with all others, some of which share a passage with one, some with a word that repeats."""
    common, rows, pairs = prose(70, 24), [], set()
    for i in range(60):
        own = prose(7000 + i // 2, 60) if i % 6 < 2 else prose(7100 + i, 60)
        if i % 20 == 0:
            own[3:18] = ["la"] * 15
        if i % 6 == 1:  # a changed word and one left out
            own = [*rows[-1][1].split()[44:64], "changed", *rows[-1][1].split()[65:90], *rows[-1][1].split()[91:104]]
            pairs.add((i - 1, i))
        rows.append((i, " ".join([*prose(8000 + i, 20), *common, *own])))
    texts = spark.createDataFrame(rows, "print long, text string")
    # One group: the windows around a shingle that all have.
    spots = [(8, i, 0, 42, 99, i) for i, _ in rows]
    windows = spark.createDataFrame(spots, "key long, print long, l int, c int, r int, class long")
    coded = op08_passages.codes(texts)
    every = {(min(r.a, r.b), max(r.a, r.b)) for r in op08_passages.other_links(op08_passages.with_codes(windows, coded), 50).collect()}
    assert pairs <= every
    with Scratch(spark, "test") as scratch:
        rows = op08_passages.divided(windows, texts, scratch, divide=8)
        sizes = {(r["key"], r["v"]): r["count"] for r in rows.where("role IS NULL").groupBy("key", "v").count().collect()}
        found = op08_passages.other_links(op08_passages.with_codes(rows, coded), 50).collect()
    assert pairs <= {(min(r.a, r.b), max(r.a, r.b)) for r in found} <= every
    # Nobody but those that share a passage meets in a subgroup: no pairs of all with all.
    assert sizes and max(sizes.values()) <= 12 and sum(n * n for n in sizes.values()) < 60 * 60 // 2


def test_first_shingles_have_one_in_common():
    """Stretches of 46 places of which 41 are shared, moved by two at most, whatever the order."""
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = rng.choice(1 << 20, 91, replace=False).astype(np.int64)
        start = int(rng.integers(0, 46))
        own, gone = a[start : start + 46], set(rng.choice(46, 5, replace=False).tolist())
        stretch = [int(x) if i not in gone else int(rng.integers(1 << 21, 1 << 22)) for i, x in enumerate(own)]
        cut = [x for i, x in enumerate(stretch) if i not in sorted(gone)[:2]]  # two places are left out
        b = rng.integers(1 << 22, 1 << 23, 91)
        b[start : start + len(cut)] = cut
        share = op08_passages._share(46, 0.8)
        first = [set(op08_passages.first_shingles(x.astype(np.int64), 46, share).tolist()) for x in (a, b)]
        assert share == 41 and first[0] & first[1]


def test_passages_that_repeat_each_other_are_a_class(documents):
    one, two = prose(70, 90), prose(71, 90)
    rows = [(i, " ".join([*prose(800 + i, 20 + i), *one, *prose(850 + i, 30)])) for i in range(1, 9)]
    rows += [(i, " ".join([*prose(800 + i, 20 + i), *two, *prose(850 + i, 30)])) for i in range(11, 15)]
    # Both passages, apart: two classes with the same smallest document.
    rows.append((0, " ".join([*one, *prose(900, 120), *two])))
    got = {}
    for r in op08_passages.repeated_passages(documents(*rows)).collect():
        got.setdefault((r.class_id, r.first_doc_id), []).append(r.doc_id)
    assert sorted(sorted(ids) for ids in got.values()) == [[*range(9)], [0, *range(11, 15)]]
    assert {first for _, first in got} == {0}


def test_passages_of_odd_rows(odd):
    rows = op08_passages.repeated_passages(odd).collect()
    assert {r.doc_id for r in rows} == {4, 5, 6, None} and all(r.n_words >= 50 for r in rows)


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset", "ids"} <= set(out.columns)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert 100 < len(ids) < docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert sum(labels.get(i) == 0 for i in ids) <= 2


def test_documents_go_to_python_in_small_batches(spark, documents):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        docs = documents((1, "one"), (2, "two"))
        corpus_pipeline.STAGES[-1][1](spark, docs, "")
        rows = spark.range(0, 2500, 1, 1).mapInArrow(lambda batches: (b.slice(0, 1).set_column(0, "id", [b.num_rows]) for b in batches), "id long")
        assert max(r.id for r in rows.collect()) <= corpus_pipeline.BATCH == 1_000
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_of_odd_tables(spark, odd, tmp_path, rows):
    """Null and empty texts, repeated rows and ids, clashing columns, labels that say nothing, and no rows at all."""
    docs = odd if rows == "odd" else odd.limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(4, 1, 0, "x"), (None, 0, 0, "y"), (9, None, None, "z")], "doc_id long, quality int, toxic int, text string")
    (labels if rows == "odd" else labels.limit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = staged(stage(spark, frame, str(tmp_path)), name)
        assert frame.columns == docs.columns
    out = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
    assert {"doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"} <= set(out.columns)
    assert (out.count() == 0) == (rows == "none")
