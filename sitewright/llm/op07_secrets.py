"""Secret scans: long tokens as candidates, false positives removed by a random forest.

A candidate is a run of at least MIN_LENGTH letters, digits, `+/_-` and closing
`=`, or, where a secret word and an assignment stand before it, a run of at least
MIN_ASSIGNED characters up to white space, a quote, a bracket, `,` or `;`. A shorter
value, one that holds such a character, and a short one that nothing names are lost. Splitting the text at its candidates gives what stands between them, and so
each candidate's neighbours, in linear time and without positions. Features are
its length, its changes between kinds of characters, how much of it words of the
corpus cover, signs of a path, and the words beside it. The forest is trained on
labelled findings and compiled into nested conditions over these features, so
that scanning is one projection: no shuffle, no join, no user function.

The corpus's DICTIONARY most frequent words are counted over all texts. Findings to
learn from are any table of `candidate, before, behind, is_secret`. Where there
is none, `labelled_findings` labels candidates of the corpus by the formats of
known kinds of secrets, and adds the same strings in harmless places (commits,
checksums, paths), short strings cut from them and words with digits and signs in the
places of secrets, and harmless words there; at most FINDINGS rows of each kind are taken, by their hashes. So without
findings of one's own the forest spreads what the formats know, no more.

Defined results: null and empty texts have no candidates; every row of the input
is a row of the result; without findings of both kinds there is no forest and
nothing is called a secret; repeated rows give repeated results; other columns
are left as they are.
"""

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.sources.files import staged

MIN_LENGTH = 16
_RUN = r"\p{L}\p{N}+/_\-"
#: What is assigned to something that a secret word names may be shorter and hold other characters.
MIN_ASSIGNED = 6
_NAMED = r"""(?i:pass(?:word|wd|phrase)?|pwd|secret|token|credentials?|auth|bearer|key)["']?\s?[=:]\s?["']?"""
_ASSIGNED = rf"""(?<=[=:]\s?["']?)(?<={_NAMED})[^\s"'`,;<>(){{}}\[\]]{{{MIN_ASSIGNED},}}+"""
# Neither kind begins within a run, which one look at the character before tells for both; most places are within one.
CANDIDATE = rf"(?<![{_RUN}])(?:{_ASSIGNED}|[{_RUN}]{{{MIN_LENGTH},}}+=*)"
MARK = "\x01"
NEAR = 40  # characters of text beside a candidate that are looked at
DICTIONARY, FINDINGS = 300, 4_000
TREES, DEPTH, SEED = 12, 6, 11
MASK = "[SECRET]"

# Words that name a secret, and words that name something harmless, beside a candidate.
SECRET_WORDS = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|credentials?|auth|bearer|(api|access|private)?[_-]?key)"
HARMLESS_WORDS = r"(?i)(commit|sha-?[0-9]*|md5|checksum|digest|hash|revision|uuid|etag|build)"
# Formats whose findings are labelled as secrets: the candidate, and what stands before it.
KNOWN_FORMATS = (
    (r"^AKIA[0-9A-Z]{16}$", r""),
    (r"^(gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}|xox[abp]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35})$", r""),
    (r"^(?=.*[0-9])(?=.*[a-zA-Z])\S{8,}$", SECRET_WORDS + r"""\s?[=:]\s?["']?$"""),
)


def frequent_words(docs: DataFrame, most: int = DICTIONARY) -> list[str]:
    """The corpus's most frequent words of three letters or more, in lower case; ties by the word."""
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(\p{L}{3,})"), F.lit(1))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()]


def with_candidates(rows: DataFrame, text: str) -> DataFrame:
    """The rows with `found`, the candidates of a text, and `between`, what stands between them, one more than there are candidates.

    The text is searched once: candidates are put between marks, at which it is split. One that holds a mark itself is searched twice.
    """
    whole = F.coalesce(text, F.lit(""))
    marked = whole.contains(MARK)
    rows = rows.withColumn("pieces", F.split(F.regexp_replace(whole, f"({CANDIDATE})", f"{MARK}$1{MARK}"), MARK, -1))
    found = F.when(marked, F.regexp_extract_all(whole, F.lit(f"({CANDIDATE})"), F.lit(1)))
    between = F.when(marked, F.split(whole, CANDIDATE, -1))
    return rows.withColumns(
        {
            "found": found.otherwise(F.filter("pieces", lambda _, i: i % 2 == 1)),
            "between": between.otherwise(F.filter("pieces", lambda _, i: i % 2 == 0)),
        }
    ).drop("pieces")


def features(candidate: Column, before: Column, behind: Column, words: list[str]) -> dict[str, Column]:
    """The numbers that the forest sees, in the forest's order."""
    size = F.length(candidate)
    share = lambda pattern: F.regexp_count(candidate, F.lit(pattern)) / size
    # Longest first, so that a word is not hidden by its beginning.
    dictionary = "|".join(map(re.escape, sorted(words, key=lambda w: (-len(w), w)))) or r"\z."
    uncovered = F.length(F.regexp_replace(F.lower(candidate), dictionary, ""))
    flag = lambda found: F.when(found, 1.0).otherwise(0.0)
    return {
        "length": size.cast("double"),
        "kind_changes": share(
            r"(?<=\p{Ll})(?=[^\p{Ll}])|(?<=\p{Lu})(?=[^\p{Lu}])|(?<=\p{N})(?=[^\p{N}])|(?<=[+/_\-=])(?=[^+/_\-=])"
        ),
        "vowel_changes": share(r"(?i)(?<=[aeiouyäöüáéíóúèêà])(?=[b-df-hj-np-tv-zßçñ])"),
        "digits": share(r"\p{N}"),
        "capitals": share(r"\p{Lu}"),
        "hexadecimal": share(r"[0-9a-f]"),
        "covered": 1.0 - uncovered / size,
        "separators": share(r"[/_\-]"),
        "in_path": flag(before.rlike(r"([/\\.@]|://\S*)$") | behind.rlike(r"^([/\\@]|\.\w)")),
        "secret_word": flag(before.rlike(SECRET_WORDS + r"""\W{0,4}$""")),
        "harmless_word": flag(before.rlike(HARMLESS_WORDS + r"""\W{0,4}$""")),
        "assigned": flag(before.rlike(r"""[=:]\s?["']?$""")),
        "quoted": flag(before.rlike(r"""["']$""") & behind.rlike(r"""^["']""")),
    }


FEATURES = [
    "length", "kind_changes", "vowel_changes", "digits", "capitals", "hexadecimal", "covered", "separators", "in_path",
    "secret_word", "harmless_word", "assigned", "quoted",
]


def all_candidates(docs: DataFrame) -> DataFrame:
    """candidate, before and behind of every candidate, one row each."""
    split = with_candidates(docs.select("text"), "text")
    # A plain explode gives rise to a filter on the candidates' number, for which texts are searched again.
    each = split.select("between", F.posexplode_outer("found").alias("i", "candidate"))
    return each.where("candidate IS NOT NULL").select(
        "candidate",
        F.right(F.get("between", F.col("i")), F.lit(NEAR)).alias("before"),
        F.left(F.get("between", F.col("i") + 1), F.lit(NEAR)).alias("behind"),
    )


def secret_places() -> Column:
    """What stands beside a value that is named a secret."""
    places = (("password=", " "), ('token = "', '"'), ("secret: ", "\n"))
    return F.array(*[F.struct(F.lit(b).alias("before"), F.lit(a).alias("behind")) for b, a in places])


def labelled_findings(docs: DataFrame, most: int = FINDINGS, frequent: Sequence[str] = ()) -> DataFrame:
    """candidate, before, behind, is_secret (see the module's text); `frequent` are words of the corpus."""
    own = F.col("candidate")
    known = reduce(lambda a, b: a | b, (own.rlike(c) & F.col("before").rlike(b) for c, b in KNOWN_FORMATS))
    # Written once: the texts are searched once for both kinds.
    marked = staged(all_candidates(docs).withColumn("is_secret", known.cast("int")), "candidates")
    order = [F.xxhash64("candidate", "before", "behind"), "candidate", "before", "behind"]
    some = staged(
        marked.where("is_secret = 1").orderBy(*order).limit(most).unionByName(
            marked.where("is_secret = 0").orderBy(*order).limit(most)
        ),
        "findings",
    )
    harmless = F.array(
        *[
            F.struct(F.lit(b).alias("before"), F.lit(a).alias("behind"))
            for b, a in (("in commit ", " by"), ("checksum: ", ""), ("sha1=", "\n"), ("see /static/", "/x"), ("build ", ""))
        ]
    )
    moved = some.where("is_secret = 1").select("candidate", F.explode(harmless).alias("p"))
    moved = moved.select("candidate", "p.before", "p.behind", F.lit(0).alias("is_secret"))
    # Short ones of the same characters: a secret where a secret word names them, and none elsewhere.
    size = 6 + F.pmod(F.xxhash64("candidate"), F.lit(7)).cast("int")
    cut = F.concat(F.substring("candidate", 1, 4), F.element_at(F.array(*map(F.lit, ("!", "$", "", "_", "@"))), 1 + size % 5), F.substring(own, F.lit(5), size - 4))
    short = some.where("is_secret = 1").select(cut.alias("candidate"))
    short = short.where(F.col("candidate").rlike(r"\p{N}")).select("candidate", F.explode(secret_places()).alias("p"))
    short = short.select("candidate", "p.before", "p.behind", F.lit(1).alias("is_secret"))
    some = some.unionByName(short)
    words = some.where(F.col("is_secret") == 0).where(~own.rlike(r"\p{N}")).limit(most)
    words = words.select("candidate", F.explode(secret_places()).alias("p"))
    words = words.select("candidate", "p.before", "p.behind", F.lit(0).alias("is_secret"))
    names = [*frequent, *(f"{a}{'-_.'[i % 3]}{b}" for i, (a, b) in enumerate(zip(frequent, frequent[1:])))]
    # And words that are none of the corpus's frequent ones.
    names += [f"{a[::-1]}{b[:2]}" for a, b in zip(frequent, frequent[1:])] + [f"{a[:3]}{b[-4:]}" for a, b in zip(frequent, frequent[1:])]
    plain = [(w, 0) for w in names if len(w) >= MIN_ASSIGNED]
    # Words with digits and signs in them are what people choose.
    chosen = [f"{a[:4]}{i % 90 + 10}{'!$@_.%'[i % 6]}{(b[:5].upper(), b[:3], '')[i % 3]}" for i, (a, b) in enumerate(zip(frequent, frequent[1:]))]
    plain = docs.sparkSession.createDataFrame(plain + [(w, 1) for w in chosen if len(w) >= MIN_ASSIGNED], "candidate string, is_secret int")
    plain = plain.select("candidate", F.explode(secret_places()).alias("p"), "is_secret")
    plain = plain.select("candidate", "p.before", "p.behind", "is_secret")
    return some.unionByName(moved).unionByName(words).unionByName(plain)


def train(findings: DataFrame, words: list[str]) -> list[str]:
    """The forest's trees, as text, learned from candidate, before, behind, is_secret."""
    columns = features(F.col("candidate"), F.col("before"), F.col("behind"), words)
    rows = findings.select(*[c.alias(n) for n, c in columns.items()], F.col("is_secret").cast("double").alias("label"))
    rows = staged(rows.coalesce(1).sortWithinPartitions("label", *FEATURES), "labelled")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return []
    weights = F.when(F.col("label") == 1, counts[0.0] / counts[1.0]).otherwise(1.0)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.withColumn("weight", weights))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", featureSubsetStrategy="onethird")
    return [tree.toDebugString for tree in forest.fit(vectors).trees]


def compile_tree(text: str, values: dict[str, Column]) -> Column:
    """A tree as nested conditions that give 0 or 1."""
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]

    def node(i: int) -> tuple[Column, int]:
        if lines[i].startswith("Predict:"):
            return F.lit(int(float(lines[i].split(":")[1]))), i + 1
        feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[i]).groups()
        left, i = node(i + 1)
        right, i = node(i + 1)  # past the Else line
        return F.when(values[FEATURES[int(feature)]] <= float(bound), left).otherwise(right), i

    return node(0)[0]


def scanned(docs: DataFrame, trees: list[str], words: list[str]) -> DataFrame:
    """The documents with `between` and `found`: (candidate, is_secret) for every candidate of their texts."""
    # Names of documents' own that could clash are put aside in one struct.
    rows = with_candidates(docs.select(F.struct(*docs.columns).alias("doc")), "doc.text")

    def measure(candidate: Column, i: Column) -> Column:
        before = F.right(F.get("between", i), F.lit(NEAR))
        behind = F.left(F.get("between", i + 1), F.lit(NEAR))
        own = features(candidate, before, behind, words)
        return F.struct(candidate.alias("candidate"), *[c.alias(n) for n, c in own.items()])

    def judge(x: Column) -> Column:
        values = {name: x[name] for name in FEATURES}
        votes = reduce(lambda a, b: a + b, (compile_tree(t, values) for t in trees), F.lit(0))
        secret = (votes * 2 > len(trees)) if trees else F.lit(False)
        return F.struct(x["candidate"].alias("candidate"), secret.alias("is_secret"))

    return rows.select("doc", "between", F.transform(F.transform("found", measure), judge).alias("found"))


def prepared(docs: DataFrame, findings: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """The forest and the dictionary for a corpus."""
    words = frequent_words(docs)
    return train(labelled_findings(docs, frequent=words) if findings is None else findings, words), words


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, n_candidates, n_secrets and the secrets of every document, in the order of the text."""
    trees, words = prepared(docs, findings)
    rows = scanned(docs.select("doc_id", "text"), trees, words)
    secrets = F.transform(F.filter("found", lambda x: x["is_secret"]), lambda x: x["candidate"])
    rows = rows.select("doc.doc_id", F.size("found").cast("long").alias("n_candidates"), secrets.alias("secrets"))
    return rows.select("doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), "secrets")


def redacted(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """The documents with MASK in the place of every secret; n_chars follows, if there is one."""
    trees, words = prepared(docs, findings)
    pieces = F.transform(
        "between",
        lambda piece, i: F.concat(
            piece,
            F.when(i >= F.size("found"), "")
            .when(F.get("found", i)["is_secret"], MASK)
            .otherwise(F.get("found", i)["candidate"]),
        ),
    )
    hit = F.exists("found", lambda x: x["is_secret"])
    rows = scanned(docs, trees, words)
    rows = rows.select("doc", F.when(hit, F.array_join(pieces, "")).otherwise(F.col("doc.text")).alias("masked"))
    own = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.coalesce(F.length("masked").cast(docs.schema["n_chars"].dataType), F.col("doc.n_chars"))
    return rows.select(*[own.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
