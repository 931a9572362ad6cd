"""Operators on single texts, against plain versions of what they compute."""

import base64
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitewright.llm import op02_topk, op03_quality_rules, op05_bpe, op06_quality_cnn, op07_secrets, op09_chat, op10_packing
from sitewright.llm.queries import ORACLE, QUERIES

from llm.conftest import prose

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_encoder_equals_the_library_on_awkward_texts():
    rng = random.Random(3)
    parts = [*"ab sS\n\t '''srevelldtm1٣é—!? 　\xa0中😀́", "'s", "'re", "  ", "\n\n", "'ll", "'ve"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 5000, "'" * 300, " " * 999, "ab" * 3000 + "'s's're", ""]
    assert op05_bpe.encoder(RANKS).encode_all(texts) == [library().encode_ordinary(t) for t in texts]


def test_bpe_digests_and_round_trip(spark, odd):
    known = library()
    want = sorted(
        ((r.doc_id, len(ids := known.encode_ordinary(r.text or "")), sha(",".join(map(str, ids))), sha(r.text or "")) for r in odd.collect()),
        key=str,
    )
    assert sorted(map(tuple, op05_bpe.encoded_digests(odd, RANKS).collect()), key=str) == want
    encoded = op05_bpe.encode(odd, RANKS)
    texts = sorted(bytes(r.decoded) for r in op05_bpe.decode(encoded, RANKS).collect())
    assert texts == sorted((r.text or "").encode() for r in odd.collect())
    for row in encoded.where("doc_id = 9").collect():
        raw = "été 中文 😀 naïve's".encode()
        stops = [*row.starts, len(raw)]
        assert [raw[a:b] for a, b in zip(stops, stops[1:])] == [known.decode_single_token_bytes(i) for i in row.ids]


def repeated_words(words):
    seen = Counter(zip(words, words[1:], words[2:]))
    return len({i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)})


def test_quality_counts(odd):
    got = sorted((tuple(r)[:6] for r in op03_quality_rules.judged(odd).collect()), key=str)
    want = []
    for r in odd.collect():
        words = (r.text or "").encode().split()
        lines = [x for x in (r.text or "").split("\n") if x.split()]
        chars = sum(len(w.decode()) for w in words)
        symbols = sum(c in "#*$%&|<>" for c in r.text or "")
        want.append((r.doc_id, len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)))
    assert got == sorted(want, key=str)


def test_quality_verdicts(documents):
    good = " ".join(prose(1, 120))
    shouted = " ".join(w.upper() + "!!" for w in prose(1, 120))
    marked = " ".join(w + "***" for w in prose(1, 120))
    rows = op03_quality_rules.judged(documents((1, good), (2, shouted), (3, marked), (4, "too short"), (5, "a b c " * 40)))
    assert {r.doc_id: (r.base_failed, r.kept) for r in rows.collect()} == {
        1: (False, True), 2: (False, False), 3: (False, False), 4: (True, False), 5: (True, False),
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_agree_with_sql(spark, name, sf_dir="/root/testdata/sf0.001"):
    df = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    columns = ", ".join(df.columns)
    want = con.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want) and want


def test_top_k_with_ties_copies_and_odd_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-3, 3)) / 4 for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 330)]  # copies of a query's vector
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] + [0.0] * 5),
             (None, [1.0] * 6), (450, [2.0, 1.0]), (451, [1.0, 1.0]), (500, []), (7, rows[7][1])]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    got = op02_topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, stripe=64, query_block=3)
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and not any(x is None or x != x or abs(x) == float("inf") for x in v):
            whole[i] = [int(256 * x // 1) for x in v]
    want = []
    for q in (i for i in whole if i % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:5], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert op02_topk.top_k(vectors.limit(0), vectors.limit(0)).collect() == []


def test_approximations_spare_reads():
    import numpy as np

    rng = np.random.default_rng(0)
    exact = rng.integers(-200, 200, (2000, 32))
    low, width = exact.min(axis=0).astype(float), np.full(32, 7.0)
    cells = np.floor((exact - low) / width).astype(np.uint8)
    best = op02_topk.Best(exact[:3], 5, np.stack([low, width]))
    best.search([[i] for i in range(2000)], cells, exact)
    for q in range(3):
        order = sorted((-int(s), i) for i, s in enumerate(exact @ exact[q]))[:5]
        assert best.found[q] == [(-s, i) for s, i in order]
    assert best.reads < 3 * 400


def test_classifier_learns_and_is_blind_to_ids(spark, documents):
    clean = [(i, " ".join(prose(i, 80))) for i in range(0, 240)]
    junk = [(i, " ".join(w + "***" for w in prose(i, 80))) for i in range(240, 400)]
    docs = documents(*clean, *junk, (None, None), (900, ""), (901, clean[0][1]))
    labels = spark.createDataFrame([(i, int(i < 240), None) for i in range(400)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in op06_quality_cnn.classified(docs, labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(i for i, r in rows.items() if r.held_out and i is not None and i < 400) == held
    assert sum(rows[i].predicted == (i < 240) for i in held) >= 0.95 * len(held)
    assert rows[901].score == pytest.approx(rows[0].score) and 0 <= rows[900].score <= 1 and rows[None].held_out is False
    none = labels.where("false")
    assert all(r.score == pytest.approx(1.0) for r in op06_quality_cnn.classified(docs.limit(3), none).collect())
    kept = op06_quality_cnn.accepted(docs, labels)
    assert kept.schema == docs.schema and kept.where("doc_id < 240").count() >= 228
    assert op06_quality_cnn.classified(docs.limit(0), labels).collect() == []


def test_network_reads_the_whole_text():
    net = op06_quality_cnn.new_net()
    text = b"plain words " * 20_000
    assert op06_quality_cnn.scores(net, [text])[0] != op06_quality_cnn.scores(net, [text[:-2000] + b"#" * 2000])[0]


def test_secrets(spark, documents, odd):
    rng = random.Random(4)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, secrets = [], {}
    for i in range(200):
        words = prose(i, 40)
        if i % 4 == 0:
            secret = [hexes(18), hexes(40), "AKIA" + "".join(rng.choice("ABCDEFGH234567") for _ in range(16))][i // 4 % 3]
            put = {18: f"password={secret}", 40: f'token = "{secret}"', 20: secret}[len(secret)]
            secrets[i] = [secret]
            words.insert(20, put)
        elif i % 4 == 1:
            words.insert(10, rng.choice(["the" * 7, f"commit {hexes(40)}", "4" * 16, f"/static/{hexes(32)}/x"]))
        rows.append((i, " ".join(words)))
    docs = documents(*rows).unionByName(odd.withColumn("doc_id", odd.doc_id + 1000))
    got = {r.doc_id: r.secrets for r in op07_secrets.scan(docs).collect()}
    assert len(got) >= 200
    assert {i: s for i, s in got.items() if s} == secrets
    masked = op07_secrets.redacted(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    texts = {r.doc_id: r for r in masked.where("doc_id < 1000").collect()}
    for i, text in rows:
        expected = text.replace(secrets[i][0], "[SECRET]") if i in secrets else text
        assert (texts[i].text, texts[i].n_chars) == (expected, len(expected))
    assert [r.n_secrets for r in op07_secrets.scan(documents((1, "no candidates"), (2, None))).collect()] == [0, 0]
    assert op07_secrets.scan(docs.limit(0)).collect() == []


def test_texts_are_searched_once_for_candidates(spark, documents):
    """As many rows are read as there are, whatever the kinds; places are those of the two kinds of candidates by themselves."""
    rng = random.Random(17)
    parts = ["password", "key", "Token", "=", ":", " ", "\n", "\"", "'", "a", "Z9", "é", "中文", "0123456789abcdef", "/_-", "+", "==", ",", "\x01", "$", "😀"]
    texts = ["".join(rng.choice(parts[: 18 if i % 3 else 21]) for _ in range(rng.randint(1, 60))) for i in range(2000)] + ["", None]
    docs = documents(*enumerate(texts))
    either = rf"{op07_secrets._ASSIGNED}|(?<![{op07_secrets._RUN}])[{op07_secrets._RUN}]{{{op07_secrets.MIN_LENGTH},}}+=*"
    whole = F.coalesce("text", F.lit(""))
    wanted = docs.select(F.split(whole, either, -1).alias("between"), F.regexp_extract_all(whole, F.lit(f"({either})"), F.lit(1)).alias("found"))
    wanted = sorted((r.between, r.found) for r in wanted.collect())
    assert sum(len(found) for _, found in wanted) > 2000 and any("\x01" in x for _, found in wanted for x in found)
    assert sorted((r.between, r.found) for r in op07_secrets.with_candidates(docs, "text").collect()) == wanted
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    op07_secrets.labelled_findings(docs.select("text").mapInArrow(counted, "text string")).collect()
    assert reads.value == len(texts)


def test_short_passwords_that_something_names(documents):
    """Precision and recall on documents the forest has not learned from."""
    rng = random.Random(11)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    learned, asked, secrets = [], [], {}
    for i in range(300):
        words = prose(5000 + i, 40)
        words.insert(9, f"api_key={pick('0123456789abcdef', 40)}" if i % 2 else f"commit {pick('0123456789abcdef', 40)}")
        learned.append((i, " ".join(words)))
    for i in range(120):
        words = prose(7000 + i, 30)
        if i % 2:
            secret = pick("abcdefghkmnpqrst", 4) + pick("0123456789", 2) + pick("!$%.@_", 1) + pick("ABCDEFabcdef0123", rng.randint(2, 6))
            words.insert(12, rng.choice(["password = \"%s\"", "secret: %s", "DB_PASSWORD=%s", "token='%s'"]) % secret)
            secrets[i] = secret
        else:
            words.insert(12, rng.choice(["password: required", "token = optional", "the key: therefore", "secret: nothing-there"]))
        asked.append((i, " ".join(words)))
    docs = documents(*learned)
    trees, words = op07_secrets.prepared(docs)
    found = op07_secrets.scanned(documents(*asked).select("doc_id", "text"), trees, words)
    got = {(r.doc.doc_id, x.candidate) for r in found.collect() for x in r.found if x.is_secret}
    right = got & set(secrets.items())
    assert len(right) >= 0.9 * len(secrets) and len(right) >= 0.9 * len(got), (sorted(got - right), sorted(set(secrets.items()) - got))


@pytest.mark.parametrize("text", ["<|im_end|>", "<\\|im_end|>", "<\\\\|a<|<\\", "<<||>>", ""])
def test_escapes_are_reversible(text):
    assert "<|" not in op09_chat.escape(text)
    assert op09_chat.unescape(op09_chat.escape(text)) == text


def test_chat(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", None]), rng.choice([None, "", " x", "\n\ny", "<|im_end|>", "été\\"]))
            for c in (1, 2, 2, None) for t in range(8)] + [(3, None, "assistant", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((-1 if t is None else t, role or "", text or ""))
    for block in (op09_chat.BLOCK_CHARS, 5):
        for r in op09_chat.digests(op09_chat.formatted(turns, RANKS, block)).collect():
            own = sorted(want[r.conv_id])
            assert r.n_turns == len(own)
            assert r.turns_sha256 == sha("".join(f"{role}\n{text}\n" for _, role, text in own))
            assert r.loss_sha256 == sha("".join(text for _, role, text in own if role == "assistant"))
    assert op09_chat.digests(op09_chat.formatted(turns.limit(0), RANKS)).collect() == []


def test_packing(spark, odd):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    got = op10_packing.pack(odd, JSON, size=64, with_ids=True).collect()
    want = []
    for r in odd.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, op10_packing.END_ID]
        stop, start, piece = len(ids) - 64 * ((len(ids) - 1) // 64), 0, 0
        while start < len(ids):
            own = ids[start:stop]
            want.append((r.doc_id, piece, start, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)), own))
            start, stop, piece = stop, stop + 64, piece + 1
    assert sorted(([*tuple(r)[:5], r.ids] for r in got), key=str) == sorted((list(w) for w in want), key=str)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 64
    assert op10_packing.pack(odd.limit(0), JSON).collect() == []


def test_added_tokens_inside_texts_have_the_library_s_ids(documents):
    tokenizer = Tokenizer.from_file(JSON)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"x{end}\n y  ", f"  {end}  ", "<|endoftext|", f"<{end}>", f"it{end}'s", "word " * 50_000 + end + " word" * 9]
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    assert [op10_packing.token_ids(JSON, t).tolist() for t in texts] == ids
    rows = op10_packing.pack(documents(*enumerate(texts)), JSON, size=100_000, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: [*own, op10_packing.END_ID] for i, own in enumerate(ids)}


def test_plan_is_best_fit_decreasing_over_single_pieces():
    rng = random.Random(9)
    for _ in range(30):
        counts = {n: rng.randint(1, 40) for n in rng.sample(range(1, 65), rng.randint(1, 40))}
        bins: list[int] = []
        for n in sorted(counts, reverse=True):
            for _ in range(counts[n]):
                fit = min((b for b in bins if b >= n), default=None)
                if fit is not None:
                    bins.remove(fit)
                bins.append((64 if fit is None else fit) - n)
        rows = op10_packing.plan(counts, 64)
        used = max(s + -(-(last - first + 1) // per) for _, first, last, s, per, _ in rows)
        assert used == len(bins)
        assert len(rows) <= 10 * 3 * 64
