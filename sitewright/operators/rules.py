"""Data-quality rules.

A rule is a small spec. A suite of rules becomes a few aggregates, whatever its
length: one over the rows for all rules that look at single rows, one for each
rule that needs groups. The result has one row per rule:
(suite, rule, column, considered, unexpected, observed, threshold, success).

Cells that are null are not considered, except by the not-null and pair rules.
With nothing to consider a rule passes.
"""

import logging
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewright.functions import points
from sitewright.functions.numbers import percent, ratio
from sitewright.operators.parts import merge_parts
from sitewright.schema import KNOWN_TYPES, LISTING_COLUMNS

log = logging.getLogger(__name__)

COLUMNS = ["suite", "rule", "column", "considered", "unexpected", "observed", "threshold", "success"]


@dataclass(frozen=True)
class Rule:
    """Base of all rules; `column` is the column it needs, if it needs one."""

    column: str | None = None

    name = ""

    def text(self) -> str:
        return ""


@dataclass(frozen=True)
class RowRule(Rule):
    """A rule on the share of rows that pass."""

    mostly: float = 1.0

    def text(self) -> str:
        return f"{self.mostly:g}"

    def considered(self) -> Column:
        return F.col(self.column).isNotNull()

    def holds(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowRule):
    name = "not_null"

    def considered(self) -> Column:
        return F.lit(True)

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class InSet(RowRule):
    values: tuple[Any, ...] = ()
    name = "in_set"

    def holds(self) -> Column:
        return F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class Between(RowRule):
    low: float = 0
    high: float = 0
    name = "between"

    def holds(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


@dataclass(frozen=True)
class PairPresent(RowRule):
    other: str = ""
    name = "pair_present"

    def considered(self) -> Column:
        return F.lit(True)

    def holds(self) -> Column:
        return F.col(self.column).isNotNull() & F.col(self.other).isNotNull()


@dataclass(frozen=True)
class NoNullIsland(RowRule):
    """No point near (0, 0). `column` is the latitude."""

    longitude: str = "longitude"
    name = "no_null_island"

    def considered(self) -> Column:
        return F.lit(True)

    def holds(self) -> Column:
        return points.off_null_island(self.column, self.longitude)


@dataclass(frozen=True)
class Unique(Rule):
    """No value twice: every row of a repeated value is unexpected."""

    name = "unique"

    def text(self) -> str:
        return "1"


@dataclass(frozen=True)
class RowCount(Rule):
    low: int = 0
    high: int = 0
    name = "row_count"

    def text(self) -> str:
        return f"{self.low}..{self.high}"


@dataclass(frozen=True)
class ColumnCount(RowCount):
    name = "column_count"


@dataclass(frozen=True)
class ColumnsAre(Rule):
    """The table has exactly these columns in this order."""

    expected: tuple[str, ...] = ()
    name = "columns"

    def text(self) -> str:
        return str(len(self.expected))


@dataclass(frozen=True)
class Contains(Rule):
    """The value occurs."""

    value: Any = None
    name = "contains"

    def text(self) -> str:
        return str(self.value)


@dataclass(frozen=True)
class TopEntity(Rule):
    """The value is among the `k` with the highest measure."""

    value: Any = None
    measure: str = "brewery_count"
    k: int = 1
    name = "top_entity"

    def text(self) -> str:
        return f"{self.value} in top {self.k}"


@dataclass(frozen=True)
class SumMatches(Rule):
    """The column adds up to a number, or to the one value of a one-row table."""

    expected: Any = 0
    name = "sum_matches"

    def text(self) -> str:
        return "" if isinstance(self.expected, DataFrame) else str(self.expected)


def _verdict(rule: Rule, considered, unexpected, observed, success, threshold=None) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).cast("string").alias("column"),
        considered.cast("long").alias("considered"),
        unexpected.cast("long").alias("unexpected"),
        observed.cast("double").alias("observed"),
        (F.lit(rule.text()) if threshold is None else threshold).alias("threshold"),
        success.cast("boolean").alias("success"),
    )


def _share(rule: Rule, mostly: float, considered: Column, passed: Column) -> Column:
    share = ratio(passed, considered)
    return _verdict(rule, considered, considered - passed, share, F.coalesce(share >= mostly, F.lit(True)))


def _parts(df: DataFrame, rule: Rule, i: int) -> tuple[list[Column], DataFrame | None]:
    """What a rule adds to the pass over the rows, and its own aggregate if it needs one."""
    seen, good = f"c{i}", f"p{i}"
    if isinstance(rule, RowRule):
        seen_rows = rule.considered()
        return [
            F.count_if(seen_rows).alias(seen),
            F.count_if(seen_rows & rule.holds()).alias(good),
        ], None
    if isinstance(rule, Contains):
        return [
            F.count(rule.column).alias(seen),
            F.count_if(F.col(rule.column) == rule.value).alias(good),
        ], None
    if isinstance(rule, SumMatches):
        return [F.count(rule.column).alias(seen), F.sum(rule.column).cast("double").alias(good)], None
    if isinstance(rule, Unique):
        copies = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(
            F.count(F.lit(1)).alias("n")
        )
        return [], copies.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias(seen),
            F.count_if(F.col("n") == 1).alias(good),
        )
    if isinstance(rule, TopEntity):
        top = df.orderBy(F.desc(rule.measure), rule.column).limit(rule.k)
        return [], top.agg(
            F.count(F.lit(1)).alias(seen), F.count_if(F.col(rule.column) == rule.value).alias(good)
        )
    return [], None


def _judge(df: DataFrame, rule: Rule, i: int) -> Column:
    seen, good, none = F.col(f"c{i}"), F.col(f"p{i}"), F.lit(None)
    if isinstance(rule, RowRule):
        return _share(rule, rule.mostly, seen, good)
    if isinstance(rule, Unique):
        return _share(rule, 1.0, seen, good)
    if isinstance(rule, (Contains, TopEntity)):
        return _verdict(rule, seen, none, good, good > 0)
    if isinstance(rule, SumMatches):
        if isinstance(rule.expected, DataFrame):
            expected = F.coalesce(rule.expected.scalar().cast("double"), F.lit(0.0))
            shown = expected.cast("long").cast("string")
        else:
            expected, shown = F.lit(float(rule.expected)), None
        total = F.coalesce(good, F.lit(0.0))
        return _verdict(rule, seen, none, total, total == expected, shown)
    if isinstance(rule, ColumnCount):
        width = len(df.columns)
        return _verdict(
            rule, F.lit(width), none, F.lit(width), F.lit(rule.low <= width <= rule.high)
        )
    if isinstance(rule, ColumnsAre):
        wrong = sum(a != b for a, b in zip(df.columns, rule.expected))
        wrong += abs(len(df.columns) - len(rule.expected))
        width = F.lit(len(df.columns))
        return _verdict(rule, width, F.lit(wrong), width, F.lit(wrong == 0))
    if isinstance(rule, RowCount):
        rows = F.col("_rows")
        return _verdict(rule, rows, none, rows, rows.between(rule.low, rule.high))
    raise TypeError(f"unknown rule {rule!r}")


def _usable(df: DataFrame, suite: str, rules: list[Rule]) -> list[Rule]:
    """The rules whose column the table has; the others are named in a warning."""
    usable = []
    for rule in rules:
        if rule.column is not None and rule.column not in df.columns:
            log.warning("suite %s: no column %s, rule %s left out", suite, rule.column, rule.name)
        else:
            usable.append(rule)
    return usable


def row_measures(df: DataFrame, suite: str, rules: list[Rule]) -> list[Column]:
    """Aggregates over the rows of a table that are all a suite of rules on single rows needs.

    They can be observed while the table is written; judge_measured makes the
    suite's result of them.
    """
    columns = [F.count(F.lit(1)).alias("_rows")]
    for i, rule in enumerate(_usable(df, suite, rules)):
        more, own = _parts(df, rule, i)
        if own is not None:
            raise ValueError(f"rule {rule.name} needs groups, not only rows")
        columns += more
    return columns


def judge_measured(df: DataFrame, measured: DataFrame, suite: str, rules: list[Rule]) -> DataFrame:
    """One row per rule, from the one row that row_measures gave; `df` tells the columns and is not read."""
    return _judged(df, measured, suite, _usable(df, suite, rules))


def run_suite(df: DataFrame, suite: str, rules: list[Rule]) -> DataFrame:
    """One row per rule. A rule on a column the table lacks is left out, with a warning."""
    usable = _usable(df, suite, rules)
    over_rows, own = [F.count(F.lit(1)).alias("_rows")], []
    for i, rule in enumerate(usable):
        columns, part = _parts(df, rule, i)
        over_rows += columns
        own += [part] if part is not None else []
    return _judged(df, merge_parts([], df.agg(*over_rows), *own), suite, usable)


def _judged(df: DataFrame, measured: DataFrame, suite: str, usable: list[Rule]) -> DataFrame:
    verdicts = F.array(*[_judge(df, rule, i) for i, rule in enumerate(usable)])
    if not usable:
        verdicts = F.expr(
            "CAST(array() AS ARRAY<STRUCT<rule STRING, column STRING, considered BIGINT,"
            " unexpected BIGINT, observed DOUBLE, threshold STRING, success BOOLEAN>>)"
        )
    return (
        measured.select(F.explode(verdicts).alias("v"))
        .select(F.lit(suite).alias("suite"), "v.*")
        .select(*COLUMNS)
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """One row per suite: rules run, passed and failed, success rate; success if none failed."""
    return (
        results.groupBy("suite")
        .agg(
            F.count(F.lit(1)).alias("total_expectations"),
            F.count_if(F.col("success")).alias("passed_expectations"),
            F.count_if(~F.col("success")).alias("failed_expectations_count"),
            F.bool_and("success").alias("success"),
        )
        .withColumn("success_rate", percent("passed_expectations", "total_expectations"))
    )


def failed_suite(spark: SparkSession, suite: str) -> DataFrame:
    """The summary of a suite that could not run: no rules, and no success."""
    return spark.range(1).select(
        F.lit(suite).alias("suite"),
        *[
            F.lit(0).cast("long").alias(c)
            for c in ("total_expectations", "passed_expectations", "failed_expectations_count")
        ],
        F.lit(False).alias("success"),
        F.lit(0.0).alias("success_rate"),
    )


def summary_or_failure(spark: SparkSession, suite: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The suite's summary, built and computed now; that of a failed suite if it cannot be, or has no rules."""
    try:
        summary = suite_summary(build())
        rows = summary.collect()
    except (PySparkException, Py4JJavaError, ValueError, TypeError) as problem:
        log.error("suite %s could not run: %s", suite, problem)
        return failed_suite(spark, suite)
    return spark.createDataFrame(rows, summary.schema) if rows else failed_suite(spark, suite)


def combined_summary(summary: DataFrame) -> DataFrame:
    """Several suites as one: how many tables passed and failed, success if there are any and all did."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_aggregations"),
        F.count_if(F.col("success")).alias("passed_aggregations"),
        F.count_if(~F.col("success")).alias("failed_aggregations"),
        F.coalesce(F.bool_and("success"), F.lit(False)).alias("success"),
    )


def volume_anomaly(runs: DataFrame, at: str, count: str, limit: float = 0.20) -> DataFrame:
    """Each run's row count against the run before it.

    `runs` has one row per run, with the time in `at` and the row count in
    `count`. Runs are compared within their month; the first of a month takes
    the last run of the latest earlier month that has one. So only the short
    list of months is ordered as a whole, never all runs. A run is not compared
    if its own count or that of the run before it is unknown, nor if it has no
    time.
    """
    month = F.date_trunc("month", F.col(at))
    dated = runs.select(
        F.col(at), F.col(count).cast("long").alias("current_count"), month.alias("_month")
    )
    months = dated.where(F.col(at).isNotNull()).groupBy("_month").agg(F.max_by("current_count", at).alias("_last"))
    earlier = months.select(
        "_month", F.lag("_last").over(Window.orderBy("_month")).alias("_carried")
    )
    in_month = Window.partitionBy("_month").orderBy(at)
    place = dated.withColumn("_before", F.lag("current_count").over(in_month))
    place = place.withColumn("_first", F.row_number().over(in_month) == 1)
    compared = place.join(earlier, "_month", "left")
    previous = F.when(F.col(at).isNull(), None).when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    change = ratio(F.abs(F.col("current_count") - F.col("previous_count")), "previous_count")
    return (
        compared.select(at, "current_count", previous.alias("previous_count"))
        .withColumn("variance", change)
        .withColumn("anomaly", F.coalesce(F.col("variance") > limit, F.lit(False)))
    )


# ---- the suites of the three layers -----------------------------------------


@dataclass(frozen=True)
class Limits:
    """What the suites hold counts against; the defaults are meant for some ten thousand listings."""

    bronze_rows: tuple[int, int] = (5_000, 50_000)
    silver_rows: tuple[int, int] = (5_000, 50_000)
    #: Share of the landed rows that must be left in silver, where their number is known.
    silver_kept: float = 0.95
    gold_rows: tuple[int, int] = (1, 10_000)
    #: Largest count of a group, where the number of curated rows is not known.
    gold_count: int = 50_000


LIMITS = Limits()


def bronze_rules(limits: Limits = LIMITS) -> list[Rule]:
    return [
        Unique("id"),
        NotNull("id", 1.0),
        NotNull("name", 0.99),
        NotNull("brewery_type", 0.95),
        RowCount(low=limits.bronze_rows[0], high=limits.bronze_rows[1]),
        InSet("brewery_type", 0.95, tuple(KNOWN_TYPES)),
        Between("latitude", 0.5, -90.0, 90.0),
        Between("longitude", 0.5, -180.0, 180.0),
        NotNull("ingestion_timestamp", 1.0),
    ]


def bronze_documented_rules() -> list[Rule]:
    return [ColumnsAre(expected=tuple(LISTING_COLUMNS))]


def silver_rules(bronze_count: int | None = None, limits: Limits = LIMITS) -> list[Rule]:
    if bronze_count:
        volume = RowCount(low=int(bronze_count * limits.silver_kept), high=bronze_count)
    else:
        volume = RowCount(low=limits.silver_rows[0], high=limits.silver_rows[1])
    return [
        volume,
        NotNull("country_normalized", 1.0),
        PairPresent("latitude", 0.85, "longitude"),
        InSet("coordinates_valid", 1.0, (True, False)),
        ColumnCount(low=20, high=30),
    ]


def silver_documented_rules() -> list[Rule]:
    return [InSet("coordinates_valid", 0.85, (True,)), NoNullIsland("latitude")]


def gold_rules(
    table: str, silver_count: int | None = None, expected_total: Any = None, limits: Limits = LIMITS
) -> list[Rule]:
    """The rules of one reporting table; `expected_total` adds the check of its sum.

    The copy of the listings is no aggregate: it only must not be empty.
    """
    if table == "breweries":
        return [RowCount(low=1, high=2**63 - 1)]
    rules: list[Rule] = [
        RowCount(low=limits.gold_rows[0], high=limits.gold_rows[1]),
        Between("brewery_count", 1.0, 1, silver_count or limits.gold_count),
    ]
    if table == "breweries_by_country":
        rules.append(Contains("country_normalized", "United States"))
        rules.append(TopEntity("country_normalized", "United States", k=3))
    if table == "breweries_by_type":
        rules.append(Contains("brewery_type_normalized", "micro"))
        rules.append(TopEntity("brewery_type_normalized", "micro", k=1))
    if expected_total is not None:
        rules.append(SumMatches("brewery_count", expected_total))
    return rules


BRONZE_SUITE, SILVER_SUITE = "bronze_quality_suite", "silver_quality_suite"


def validate_bronze(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return run_suite(df, BRONZE_SUITE, bronze_rules(limits))


def validate_silver(df: DataFrame, bronze_count: int | None = None, limits: Limits = LIMITS) -> DataFrame:
    return run_suite(df, SILVER_SUITE, silver_rules(bronze_count, limits))


def validate_gold(
    tables: dict[str, DataFrame],
    silver_count: int | None = None,
    totals: dict[str, Any] | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """The rules of every given table, one suite each; without tables no rows, which is no success."""
    results = None
    for name, table in tables.items():
        rules = gold_rules(name, silver_count, (totals or {}).get(name), limits)
        one = run_suite(table, f"gold_{name}_suite", rules)
        results = one if results is None else results.unionByName(one)
    if results is None:
        spark = SparkSession.active()
        results = run_suite(spark.range(0), "gold", [RowCount(low=0, high=0)]).where(F.lit(False))
    return results


def validation_summary(results_by_layer: dict[str, DataFrame]) -> DataFrame:
    """One row per layer and one for all of them, from their rule rows."""
    layers = None
    for layer, results in results_by_layer.items():
        one = results.select(F.lit(layer).alias("layer"), "success")
        layers = one if layers is None else layers.unionByName(one)
    counted = layers.rollup("layer").agg(
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.grouping("layer").alias("_all"),
    )
    named = F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("layer"))
    return counted.select(
        named.alias("layer"),
        "total_expectations",
        "passed",
        "failed",
        F.coalesce(percent("passed", "total_expectations"), F.lit(0.0)).alias("success_rate"),
        "success",
    )
