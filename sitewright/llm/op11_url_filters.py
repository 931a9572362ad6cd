"""URL filters: a short list of rules, and host reputation by empirical Bayes for the rest.

A url's host is what follows the first `://` up to `/`, `?`, `#` or the end, with
A-Z in lower case; its path goes on up to `?`, `#` or the end. A rule has a host
and a path; it fits urls of its host and of all subdomains whose path starts with
the rule's. The longest rule that fits decides.

Where none fits, the reputation of the host does. Outcomes of labelled pages are
counted per host, registered domain and suffix. The share of bad pages of a
suffix has a beta prior around the share of all pages, that of a domain one around
its suffix's posterior mean, that of a host one around its domain's. How strong
the priors of a level are is measured: the counts' variance beyond the binomial
one gives the beta-binomial's correlation r by moments, and a prior counts as
1 / r - 1 pages. Where units of a level are alike, all are drawn to their parent;
where they differ much, a few pages speak for a unit. A host is blocked if the lower
bound of its posterior is LIMIT at least: mean - Z standard deviations, a
one-sided 95 % bound by the normal approximation of the beta distribution. So a
host is allowed until its pages show enough, and one without pages goes by its parents.

Only counts per host are shuffled, combined first. Sums that fit the priors are
taken over whole numbers, so that they do not depend on the order of rows. Three
one-row sums come to the driver. The pages meet the blocked hosts in a join whose
large keys adaptive execution splits.

The registered domain of a host is its last two labels, or three under a suffix
of two labels in SUFFIXES; a port and user are left out. An address of digits and
dots, and a host without a dot, is its own domain and suffix.

Defined results: a null url, or one without `://`, has an empty host and path, no
rule, and the reputation of the host ''; outcomes that are null are no outcomes;
rows that repeat are judged, and counted, each; without outcomes every page that no
rule decides is allowed; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.sources.files import staged

#: Suffixes of two labels; a longer list can be passed in.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
LIMIT, Z = 0.5, 1.645
#: Bounds of a level's correlation: a prior counts as a thousand pages at most and a hundredth of one at least.
LEAST_R, MOST_R = 1 / 1001, 1 / 1.01
#: Scale of the whole numbers that are summed.
SCALE = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host, path, verdict) that fits, as one string, and its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for own, prefix, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(prefix)
        rule, verdict = F.when(fits, own + prefix).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def levels_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    alone = ~bare.contains(".") | bare.rlike(r"^[0-9.]+$") | bare.endswith(".")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*suffixes)
    domain = F.when(alone, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, F.when(alone, bare).when(long, two).otherwise(F.substring_index(bare, ".", -1))


def _correlation(units: DataFrame) -> float:
    """How alike pages of one unit are beyond their prior mean, by moments; `units` has n, bad and mean, the prior's."""
    whole = lambda x: F.floor(x * SCALE).cast("decimal(38,0)")
    n, off = F.col("n").cast("double"), F.col("bad") - F.col("n") * F.col("mean")
    spread = F.col("mean") * (1 - F.col("mean"))
    sums = units.agg(F.sum(whole(off * off - n * spread)).alias("beyond"), F.sum(whole(n * (n - 1) * spread)).alias("pairs")).first()
    if not sums["pairs"]:
        return LEAST_R
    return min(max(float(sums["beyond"]) / float(sums["pairs"]), LEAST_R), MOST_R)


def _posterior(units: DataFrame, r: float) -> DataFrame:
    """The units with their posterior's mean and weight (pages of the prior and its own)."""
    prior = 1 / r - 1
    weight = F.col("n") + F.lit(prior)
    return units.withColumn("mean", (F.col("bad") + prior * F.col("mean")) / weight).withColumn("weight", weight)


def reputation(outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """host, n, bad, mean, weight and lower (bound of the share of bad pages) of every host of outcomes (url, bad)."""
    rows = outcomes.where(F.col("bad").isNotNull()).select(host_of(F.col("url")).alias("host"), F.col("bad").cast("long").alias("bad"))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    domain, suffix = levels_of(F.col("host"), suffixes)
    hosts = staged(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "url-hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    everywhere = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    tops = domains.groupBy("suffix").agg(*counts).withColumn("mean", F.lit(everywhere))
    tops = _posterior(tops, _correlation(tops)).select("suffix", "mean")
    domains = domains.join(tops, "suffix")
    domains = _posterior(domains, _correlation(domains)).select("domain", "suffix", "mean")
    hosts = hosts.join(domains, ["domain", "suffix"])
    hosts = _posterior(hosts, _correlation(hosts))
    mean, weight = F.col("mean"), F.col("weight")
    lower = mean - Z * F.sqrt(mean * (1 - mean) / (weight + 1))
    return hosts.select("host", "n", "bad", "mean", "weight", lower.alias("lower"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], outcomes: DataFrame, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule (or null) and verdict (`allow` or `block`) of every page (page_id, url).

    `rules` is a list kept by hand, which becomes one expression; `outcomes` has url and bad.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("says", says)
    blocked = staged(reputation(outcomes).where(F.col("lower") >= limit).select("host", F.lit("block").alias("own")), "url-blocked")
    return rows.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("says", "own", F.lit("allow")).alias("verdict")
    )


def page_outcomes(pages: DataFrame, most_symbols: float = 0.02, least_words: int = 20) -> DataFrame:
    """url and bad of pages (url, html), judged by their visible text alone, for want of labels given by people.

    A page is bad if its text outside tags, scripts and styles has fewer than `least_words`
    words, or more than `most_symbols` of its characters are among `#*$%|<>~^=`.
    """
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"&[A-Za-z0-9#]+;", " ")
    text = F.trim(F.regexp_replace(text, r"[\x09-\x0D\x20]+", " "))
    rows = pages.select("url", text.alias("text"))
    words = F.length("text") - F.length(F.translate("text", " ", "")) + F.when(F.col("text") == "", 0).otherwise(1)
    symbols = F.length("text") - F.length(F.translate("text", "#*$%|<>~^=", ""))
    return rows.select("url", ((words < least_words) | (symbols > most_symbols * F.length("text"))).alias("bad"))


#: The rules of the query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def oracle() -> str:
    """DuckDB SQL for judged(pages, RULES, page_outcomes(pages))."""
    order = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda own, prefix: f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{prefix}')"
    case = lambda k: "CASE " + " ".join(f"WHEN {fits(a, b)} THEN '{(a + b, v)[k]}'" for a, b, v in order) + " END"
    two = ", ".join(f"'{s}'" for s in SUFFIXES)

    def fit(units: str) -> str:
        off, spread, n = "(bad - n * mean)", "(mean * (1 - mean))", "n::DOUBLE"
        beyond = f"sum(floor(({off} * {off} - {n} * {spread}) * {SCALE})::HUGEINT)::DOUBLE"
        pairs = f"sum(floor(({n} * ({n} - 1) * {spread}) * {SCALE})::HUGEINT)::DOUBLE"
        return f"SELECT 1 / least(greatest(coalesce({beyond} / nullif({pairs}, 0), {LEAST_R!r}), {LEAST_R!r}), {MOST_R!r}) - 1 AS prior FROM {units}"

    def posterior(units: str) -> str:
        return f"SELECT * REPLACE ((bad + prior * mean) / (n + prior) AS mean), n + prior AS weight FROM {units}, ({fit(units)})"

    return f"""
        WITH r AS (
            SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), p AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, html FROM r
        ), t AS (
            SELECT host, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
                '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&[A-Za-z0-9#]+;', ' ', 'g'),
                '[\\x09-\\x0D\\x20]+', ' ', 'g')) AS text FROM p
        ), o AS (
            SELECT host, (CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END < 20
                OR length(regexp_replace(text, '[^#*$%|<>~^=]', '', 'g')) > 0.02::DOUBLE * length(text))::BIGINT AS bad FROM t
        ), c AS (
            SELECT host, count(*) AS n, sum(bad)::BIGINT AS bad, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM o GROUP BY host
        ), s AS (
            SELECT *, NOT contains(bare, '.') OR regexp_full_match(bare, '[0-9.]+') OR ends_with(bare, '.') AS alone, string_split(bare, '.') AS l FROM c
        ), h AS (
            SELECT host, n, bad, CASE WHEN alone THEN bare WHEN list_aggregate(l[-2:], 'string_agg', '.') IN ({two})
                    THEN list_aggregate(l[-3:], 'string_agg', '.') ELSE list_aggregate(l[-2:], 'string_agg', '.') END AS domain,
                CASE WHEN alone THEN bare WHEN list_aggregate(l[-2:], 'string_agg', '.') IN ({two})
                    THEN list_aggregate(l[-2:], 'string_agg', '.') ELSE l[-1] END AS suffix FROM s
        ), u0 AS (
            SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad, (SELECT (sum(bad) + 1)::DOUBLE / (sum(n) + 2) FROM h) AS mean FROM h GROUP BY suffix
        ), u AS ({posterior("u0")}), d0 AS (
            SELECT domain, h.suffix, sum(h.n)::BIGINT AS n, sum(h.bad)::BIGINT AS bad, any_value(u.mean) AS mean FROM h JOIN u USING (suffix) GROUP BY ALL
        ), d AS ({posterior("d0")}), h0 AS (
            SELECT host, h.n, h.bad, d.mean FROM h JOIN d USING (domain, suffix)
        ), x AS ({posterior("h0")}), b AS (
            SELECT host AS own FROM x WHERE mean - {Z} * sqrt(mean * (1 - mean) / (weight + 1)) >= {LIMIT}
        )
        SELECT page_id, host, path, {case(0)} AS rule, coalesce({case(1)}, CASE WHEN own IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM p LEFT JOIN b ON own = host
    """
