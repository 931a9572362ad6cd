"""URL reputation, ranked search and conversation repair, against plain versions and their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from sitewright.llm import op11_url_filters as urls
from sitewright.llm import op12_ranked_search as search
from sitewright.llm import op13_conversations as talks
from sitewright.llm.queries import ORACLE, QUERIES

from llm.conftest import prose

SF = "/root/testdata/sf0.001"


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def in_sql(sql, **tables):
    """Rows of SQL over pandas tables, by column name."""
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(sql).fetchall()


# -- URLs ----------------------------------------------------------------------------------------------------------------------


def outcomes_of(spark, counts):
    data = [(f"http://{host}/{i}", i < bad) for host, n, bad in counts for i in range(n)]
    return spark.createDataFrame(data, "url string, bad boolean")


def test_hosts_paths_and_rules(spark):
    data = [
        (1, "HTTP://Blog.Example.NET/en/x?y=/z#w"), (2, "http://example.net"), (3, "https://a.example.com/de/"), (4, "https://a.example.com/dex"),
        (5, "ftp://x.org/fr/#a"), (6, "no scheme/at/all"), (7, None), (8, "x?u=http://Ünï.org/fr/"), (9, "http://internet/"), (10, "http://notexample.net/en/"), (11, "://"),
    ]
    pages = spark.createDataFrame([(i, u, 5, "h") for i, u in data], "page_id long, url string, says int, own string")
    out = urls.judged(pages, urls.RULES, outcomes_of(spark, []))
    assert rows(out, "page_id", "host", "path", "rule", "verdict") == sorted([
        (1, "blog.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.net", "", None, "allow"),
        (3, "a.example.com", "/de/", "example.com/de/", "block"), (4, "a.example.com", "/dex", None, "allow"),
        (5, "x.org", "/fr/", "org/fr/", "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "Ünï.org", "/fr/", "org/fr/", "allow"),
        (9, "internet", "/", None, "allow"), (10, "notexample.net", "/en/", "net/", "block"), (11, "", "", None, "allow"),
    ], key=str)


def test_registered_domains(spark):
    hosts = ["a.b.example.com", "example.com", "x.shop.co.uk", "co.uk", "localhost", "10.0.0.1", "u@w.example.org:80", "", "odd."]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    assert {r.host: (r.d, r.s) for r in frame.select("host", *[c.alias(n) for c, n in zip(urls.levels_of(frame.host), "ds")]).collect()} == {
        "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "x.shop.co.uk": ("shop.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"), "localhost": ("localhost", "localhost"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"),
        "u@w.example.org:80": ("example.org", "org"), "": ("", ""), "odd.": ("odd.", "odd."),
    }


def plain_reputation(counts):
    """The same sums in plain Python."""
    level = lambda key: {k: [sum(c[i] for c in counts if key(c[0]) == k) for i in (1, 2)] for k in {key(c[0]) for c in counts}}
    top, domain = (lambda h: h.split(".")[-1]), (lambda h: ".".join(h.split(".")[-2:]))
    total = [sum(c[i] for c in counts) for i in (1, 2)]

    def fit(units, prior):
        beyond = sum(math.floor(((b - n * prior(k)) ** 2 - n * prior(k) * (1 - prior(k))) * urls.SCALE) for k, (n, b) in units.items())
        pairs = sum(math.floor(n * (n - 1) * prior(k) * (1 - prior(k)) * urls.SCALE) for k, (n, b) in units.items())
        r = min(max(beyond / pairs if pairs else 0, urls.LEAST_R), urls.MOST_R)
        m = 1 / r - 1
        return {k: ((b + m * prior(k)) / (n + m), n + m) for k, (n, b) in units.items()}

    tops = fit(level(top), lambda k: (total[1] + 1) / (total[0] + 2))
    domains = fit(level(domain), lambda k: tops[top(k)][0])
    return fit(level(lambda h: h), lambda k: domains[domain(k)][0])


def test_reputation_follows_the_counts_and_their_parents(spark):
    rng = random.Random(4)
    counts = [(f"h{i}.d{i % 7}.{'com' if i % 2 else 'org'}", n := rng.randint(1, 40), rng.randint(0, n) if i % 5 == 0 else 0) for i in range(80)]
    counts += [("spam.junk.net", 60, 60), ("once.junk.net", 1, 1), ("once.fine.com", 1, 1)]
    got = {r.host: r for r in urls.reputation(outcomes_of(spark, counts)).collect()}
    for host, (mean, weight) in plain_reputation(counts).items():
        assert got[host].mean == pytest.approx(mean, rel=1e-9) and got[host].weight == pytest.approx(weight, rel=1e-6)
        assert got[host].lower == pytest.approx(mean - urls.Z * math.sqrt(mean * (1 - mean) / (weight + 1)), rel=1e-6)
    assert got["spam.junk.net"].lower > 0.5
    assert got["once.junk.net"].mean > got["once.fine.com"].mean  # what is around a host counts
    assert got["once.fine.com"].lower < 0.5
    pages = spark.createDataFrame([(1, "http://spam.junk.net/x"), (2, "http://once.fine.com/x"), (3, "http://new.com/")], "page_id long, url string")
    assert rows(urls.judged(pages, [], outcomes_of(spark, counts)), "page_id", "verdict") == [(1, "block"), (2, "allow"), (3, "allow")]


def test_pages_that_repeat_and_no_pages(spark):
    data = [(1, "http://a.com/", None), (1, "http://a.com/", None), (None, "http://a.com/", "<p>x"), (2, None, "")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    assert len(urls.judged(pages, urls.RULES, urls.page_outcomes(pages)).collect()) == 4
    none = pages.limit(0)
    assert urls.judged(none, urls.RULES, urls.page_outcomes(none)).collect() == []


def test_page_outcomes(spark):
    text = " ".join(prose(3, 60))
    data = [
        ("a", f"<html><script>{'# ' * 99}</script><p>{text}</p>"), ("b", f"<p>{text} {'*** ' * 9}</p>"), ("c", "<p>few words</p>"), ("d", None),
        ("e", f"<style>#</style><p>{text.replace(' ', '&amp; ')}</p>"),
    ]
    pages = spark.createDataFrame(data, "url string, html string")
    assert rows(urls.page_outcomes(pages), "url", "bad") == [("a", False), ("b", True), ("c", True), ("d", True), ("e", False)]


# -- Search --------------------------------------------------------------------------------------------------------------------


def plain_ranking(docs, items, k=10):
    words = lambda t: ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    own = [(i, Counter(words(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    big_n, total = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(words(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c, n in own:
            m = 100 - 90 + (90 * n * big_n) // total
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank + 1, i, -score) for rank, (score, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [(8192, 64, 8), (40, 4, 1), (300, 2, 0)])
def test_trees_find_what_all_scores_find(spark, documents, monkeypatch, size):
    for name, value in zip(("TREE", "LEAF", "FEW"), size):
        monkeypatch.setattr(search, name, value)
    # In tasks the module is as it is; here the same trees are searched one after the other.
    rng = random.Random(2)
    words = [w for s in range(6) for w in prose(s, 60)]
    docs = [(i, " ".join(rng.choices(words[: rng.choice([30, 300])], k=rng.randint(1, 80)))) for i in range(400)]
    docs += [(1000 + i, docs[0][1]) for i in range(300)] + [(2000, " ".join(words))]
    rng.shuffle(docs)
    known = {t.encode(): i for i, t in enumerate(sorted({w.lower() for w in words}))}
    vectors = []
    for i, t in docs:
        c = Counter(known[w] for w in search.terms_of(t.encode()))
        vectors.append((i, np.array(sorted(c), dtype=np.int32), np.array([c[x] for x in sorted(c)], dtype=np.int64), search.penalty(sum(c.values()), 7, 90)))
    for seed in range(5):
        terms = np.unique(random.Random(seed).choices(range(len(known)), k=12)).astype(np.int32)
        weights = np.array([(int(t) * 37) % 900 for t in terms], dtype=np.int64)
        best = []
        for at in range(0, len(vectors), size[0]):
            best = search.search(search.tree(vectors[at : at + size[0]]), terms, weights, best)
        want = []
        for i, own, tfs, m in vectors:
            score = sum(int(w) * int(search.part(tf, m)) for t, w in zip(terms, weights) for x, tf in zip(own, tfs) if x == t)
            want.append((-score, i))
        assert best == sorted(w for w in want if w[0] < 0)[:10]


def test_ranking_of_odd_documents_and_items(spark, odd, documents):
    more = documents(*[(100 + i, " ".join(prose(i % 17, 40 + i % 5))) for i in range(200)])
    docs = odd.unionByName(more)
    items = [(1, " ".join(prose(3, 40))), (2, "Été 中文 naïve"), (3, None), (4, ""), (5, "never-seen-anywhere"), (6, " ".join(prose(5, 400))), (6, "the OF"), (None, "a b c")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, score int, rank string")
    want = plain_ranking([(r.doc_id, r.text) for r in docs.collect()], items)
    for block in (8_000_000, 50):
        assert rows(search.ranked(docs.repartition(3), frame, block_bytes=block), "item_id", "rank", "doc_id", "score") == want
    assert search.ranked(docs.limit(0), frame).collect() == []
    assert search.ranked(docs, frame.limit(0)).collect() == []


# -- Conversations -------------------------------------------------------------------------------------------------------------


def plain_edits(codes):
    """The least (cost, edits) by keeping the whole string for every state."""

    def put(states):
        for _ in range(4):
            for s, (cost, text) in list(states.items()):
                new = (cost + 3, text + "I")
                if talks.NEXT[s] not in states or new < states[talks.NEXT[s]]:
                    states[talks.NEXT[s]] = new
        return states

    states = put({0: (0, "")})
    for code in codes:
        fault, initial, found = code >> 2, "sua?"[code & 3], {}
        for s, (cost, text) in states.items():
            tries = [("D", 4, s)]
            if fault in (talks.FINE, talks.TRUNCATED):
                more = 3 * (fault == talks.TRUNCATED)
                tries += [("K", more, to) for i, at, to in (("s", (0,), 1), ("u", (0, 1, 3), 2), ("a", (2,), 3)) if i == initial and s in at]
                tries.append(("R", 3 + more, 3 if s == 2 else 2))
            for edit, price, to in tries:
                found[to] = min(found.get(to, (10**9, "")), (cost + price, text + edit))
        states = put(found)
    return min(states[s] for s in (0, 3) if s in states)


def test_divide_and_conquer_finds_the_least_edits():
    rng = random.Random(1)
    for _ in range(3000):
        codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 1, 2, 5, 9, 13, 14, 12, 10]) for _ in range(rng.randint(0, 14)))
        cost, text = plain_edits(codes)
        found, _ = talks.edits(codes, talks.START, list(talks.LAST))
        assert (talks.price(codes, found), found) == (cost, text)


TURNS = "conv_id long, turn long, role string, text string, key string, code int, seq int"


def awkward(spark):
    rng = random.Random(9)
    data = []
    for conv in range(60):
        for turn in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rng.choice(["Fine.", "cut off", "", " \t ", "Fine.", "Why?  ", "no ", "ok. ", None, f"t{turn}!", "é" * 20 + "."])
            data.append((conv if conv else None, rng.choice([turn, turn, turn * 3, None]), role, text))
            if rng.random() < 0.2:
                data.append(data[-1])
    data += [(77, i % 900, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{i}."])) for i in range(3000)]
    return data, spark.createDataFrame([(*d, "x", 1, 2) for d in data], TURNS)


def plain_report(data):
    convs = defaultdict(list)
    for conv, turn, role, text in data:
        convs[conv].append((turn, role if role is not None else " ", text if text is not None else " "))
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, codes = set(), []
        for turn, role, text in own:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = talks.BLANK if not bare else talks.DUPLICATE if (role, text) in seen else talks.TRUNCATED if bare[-1] not in ".!?" else talks.FINE
            seen.add((role, text))
            codes.append((max("sua?".find(role[:1]), 0) if role and role[0] in "sua" else 3) + 4 * fault)
        turns = [t for t, *_ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit = plain_edits(codes)
        left = list(talks.replay(iter(audit), iter([r[1:] for r in own])))
        count = [sum(c >> 2 == f for c in codes) for f in (talks.BLANK, talks.DUPLICATE, talks.TRUNCATED)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        initials = "".join(r[:1] for r, _ in left)
        assert re.fullmatch("(s?(ua)+)?", initials)
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(out, key=str)


REPORT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("segment", [talks.SEGMENT, 3])
def test_repair_of_odd_conversations(spark, segment):
    data, frame = awkward(spark)
    assert rows(talks.report(frame.repartition(5), segment), *REPORT) == plain_report(data)


def test_repaired_rows_are_conversations(spark):
    _, frame = awkward(spark)
    found = defaultdict(list)
    for r in talks.repair(frame, 50).collect():
        found[r.conv_id].append((r.place, r.role, r.text))
    for own in found.values():
        own.sort()
        assert [p for p, *_ in own] == list(range(len(own)))
        assert re.fullmatch("s?(ua)+", "".join(role[0] for _, role, _ in own))


def test_damage(spark):
    data = [(c, t, "assistant", "One. Two! Three?") for c in range(8) for t in range(9)] + [(None, None, None, None)]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = rows(talks.damaged(frame), "conv_id", "turn", "role", "text", "lost")
    want = []
    for conv, turn, role, text in data:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    assert got == sorted(want, key=str)


def test_conversations_that_lose_all_rows_and_none_at_all(spark):
    frame = spark.createDataFrame([(5, 0, "user", "x", True), (6, 0, "user", " ", False)], "conv_id long, turn long, role string, text string, lost boolean")
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows(talks.report(frame), *REPORT) == [(5, 0, 0, 0, 0, 0, 0, "", nothing), (6, 0, 1, 0, 0, 0, 4, "D", nothing)]
    assert talks.report(frame.limit(0)).collect() == []


# -- SQL -----------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_url_reputation", "op12_ranked_search", "op13_conversation_repair"])
def test_queries_agree_with_their_sql(spark, name):
    df = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    assert want and rows(df, *names) == want


def test_sql_of_the_reputation_blocks_the_same_pages(spark, tmp_path):
    import pandas as pd

    text, rng = " ".join(prose(3, 60)), random.Random(8)
    data = [(i, f"https://{rng.choice('abcdef')}.{rng.choice(['good', 'bad'])}.com/x", text) for i in range(300)]
    data = [(i, u, h if "good" in u or i % 9 == 0 else "***") for i, u, h in data] + [(900, None, None), (901, "http://shop.co.uk", "")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = rows(urls.judged(pages, urls.RULES, urls.page_outcomes(pages)), "page_id", "host", "path", "rule", "verdict")
    assert {v for *_, v in got} == {"allow", "block"}
    frame = pd.DataFrame(data, columns=["page_id", "url", "html"])
    want = in_sql(f"SELECT page_id, host, path, rule, verdict FROM ({urls.oracle()})", pages=frame)
    assert got == sorted(want, key=str)
