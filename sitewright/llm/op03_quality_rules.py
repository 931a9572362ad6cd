"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every rule bounds a ratio of two counts of a text. The counts are columns of
nested arrays that a row carries for itself, so that nothing is shuffled and a
row's cost is n log n in its words. Ratios are compared as products of whole
numbers (ratio bounds are given in thousandths), never as quotients.

Repeated words: the 64-bit hashes of a text's three-word windows are sorted with
their positions; a window whose hash equals a neighbour's occurs twice or more
(hashes are only compared within a text: among 20,000 windows, two different
ones share a hash once in 10^11 texts), and the words that such windows cover
are counted once each.

Defined results: a null or empty text has no words, fails the base rules and is
not kept; a rule whose denominator is zero holds; rows with a null or repeated
doc_id are judged each by its own text; other columns are ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import WORD, words_of

SYMBOLS = "[#*$%&|<>]"
BULLETS = r"^[\x20\x09]*([-*]|•|●)[\x20\x09]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09\x0D]*$"

# Frequent short words of English, French, German and Spanish, as they stand within a sentence.
STOP_WORDS = (
    "a al als and are as at au auf avec be by con dans das de dem den der des die du ein eine el en es est et for from"
    " für have in is ist it la las le les los mit nicht no of on or para pas por pour que qui se sich sur that the this"
    " to un una und une von was with y zu"
).split()

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """low <= 1000 * count / per <= high; a bound that is None does not hold anything back."""

    name: str
    count: str
    per: str
    low: int | None = None
    high: int | None = None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 3_000, 10_000),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 100),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 60, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 400),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 900),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 300),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """All rules as one condition."""
    verdict = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            verdict = verdict & (F.col(rule.count) * 1000 >= F.col(rule.per) * rule.low)
        if rule.high is not None:
            verdict = verdict & (F.col(rule.count) * 1000 <= F.col(rule.per) * rule.high)
    return verdict


def _matching(lines: str, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda line: line.rlike(pattern))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules refer to."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    n = F.size("words")
    last = F.greatest(n - 2, F.lit(0))
    windows = F.transform(
        F.slice("words", F.lit(1), last),
        lambda word, i: F.struct(
            F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)).alias("hash"), i.alias("at")
        ),
    )
    counted = split.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda sum_, w: sum_ + F.length(w)).alias("word_chars"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.sort_array(windows).alias("windows"),
    )
    m = F.size("windows")
    neighbours = F.arrays_zip(
        F.slice("windows", F.lit(1), F.greatest(m - 1, F.lit(0))).alias("a"),
        F.slice("windows", F.lit(2), F.greatest(m - 1, F.lit(0))).alias("b"),
    )
    equal = F.filter(neighbours, lambda pair: pair["a"]["hash"] == pair["b"]["hash"])
    counted = counted.select(
        "doc_id", "n_words", "word_chars", "n_stop_words", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _matching("lines", BULLETS).alias("n_bullet_lines"),
        _matching("lines", ELLIPSIS).alias("n_ellipsis_lines"),
        equal.alias("equal"),
    )
    positions = F.sort_array(
        F.array_union(
            F.transform("equal", lambda pair: pair["a"]["at"]), F.transform("equal", lambda pair: pair["b"]["at"])
        )
    )
    counted = counted.withColumn("at", positions)
    k = F.size("at")
    steps = F.arrays_zip(
        F.slice("at", F.lit(1), F.greatest(k - 1, F.lit(0))).alias("a"),
        F.slice("at", F.lit(2), F.greatest(k - 1, F.lit(0))).alias("b"),
    )
    covered = F.aggregate(
        steps, F.lit(0).cast("long"), lambda sum_, step: sum_ + F.least(F.lit(3), step["b"] - step["a"])
    )
    return counted.withColumn("n_repeat_words", covered + F.when(k > 0, F.lit(3)).otherwise(F.lit(0)))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts, whether the base rules failed, and whether the text is kept."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return measured(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines",
        base_failed.alias("base_failed"), (~base_failed & compile_rules(rules)).alias("kept"),
    )


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in DuckDB's SQL."""
    bounds = [f"{r.count} * 1000 >= {r.per} * {r.low}" for r in rules if r.low is not None]
    bounds += [f"{r.count} * 1000 <= {r.per} * {r.high}" for r in rules if r.high is not None]
    stops = ", ".join(f"'{word}'" for word in STOP_WORDS)
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(text, '{WORD}') AS words,
                list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines FROM d
        ), grams AS (
            SELECT n, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
            FROM (SELECT n, words, unnest(range(1, len(words) - 1)) AS i FROM w)
        ), repeated AS (
            SELECT n, i FROM grams QUALIFY count(*) OVER (PARTITION BY n, gram) > 1
        ), covered AS (
            SELECT n, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) t(k) GROUP BY n
        ), counted AS (
            SELECT doc_id, len(words) AS n_words,
                coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words,
                len(list_filter(words, lambda x: x IN ({stops})))::BIGINT AS n_stop_words,
                len(lines) AS n_lines,
                len(list_filter(lines, lambda x: regexp_matches(x, '{_re2(BULLETS)}')))::BIGINT AS n_bullet_lines,
                len(list_filter(lines, lambda x: regexp_matches(x, '{_re2(ELLIPSIS)}')))::BIGINT AS n_ellipsis_lines
            FROM w LEFT JOIN covered USING (n)
        ), base AS (
            SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed
            FROM counted
        )
        SELECT *, NOT base_failed AND {' AND '.join(bounds)} AS kept FROM base
    """


def _re2(pattern: str) -> str:
    """A pattern whose code points are written as RE2 wants them."""
    return pattern.replace(r"•", r"\x{2022}").replace(r"●", r"\x{25cf}").replace(r"…", r"\x{2026}")
