"""Data-quality rules as data, checked in few passes.

All row rules of a table become one aggregate over one scan. A uniqueness rule and a reference
rule each count rows per key first, so a hot key is one row per map task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.operators.joins import orphan_count


class QualityGateError(RuntimeError):
    """A rule failed; `failures` holds the rows of the report."""

    def __init__(self, failures: list):
        self.failures = failures
        listed = "; ".join(f"{r['table']}.{r['check']}: {r['failing']} failing" for r in failures)
        super().__init__(f"{len(failures)} quality checks failed: {listed}")


@dataclass(frozen=True)
class RowRule:
    """Fails for each row where `broken` is true; a null outcome passes."""

    check: str
    table: str
    broken: Callable[[], Column]


@dataclass(frozen=True)
class UniqueRule:
    """Fails for each row beyond the first of its key; null is one key."""

    check: str
    table: str
    key: str


@dataclass(frozen=True)
class ReferenceRule:
    """Fails for each row whose key is null or missing from `parent`."""

    check: str
    table: str
    key: str
    parent: str


Rule = RowRule | UniqueRule | ReferenceRule


def not_null(table: str, column: str) -> RowRule:
    return RowRule(f"{column} not null", table, lambda: F.col(column).isNull())


def within(table: str, column: str, low: float, high: float, check: str | None = None) -> RowRule:
    name = check or f"{column} between {low} and {high}"
    return RowRule(name, table, lambda: ~F.col(column).between(low, high))


def positive(table: str, column: str) -> RowRule:
    return RowRule(f"{column} > 0", table, lambda: F.col(column) <= 0)


def less_than(table: str, column: str, other: str) -> RowRule:
    return RowRule(f"{column} < {other}", table, lambda: F.col(column) >= F.col(other))


def one_of(table: str, column: str, values: Sequence[str]) -> RowRule:
    return RowRule(f"{column} valid values", table, lambda: ~F.col(column).isin(list(values)))


def unique(table: str, key: str) -> UniqueRule:
    return UniqueRule(f"{key} unique", table, key)


def refers(table: str, key: str, parent: str) -> ReferenceRule:
    return ReferenceRule(f"{key} ref integrity", table, key, parent)


# The valid tiers and the standard rules.
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
STANDARD_RULES: tuple[Rule, ...] = (
    not_null("customers", "customer_id"),
    unique("customers", "customer_id"),
    not_null("customers", "email"),
    within("customers", "age", 18, 100),
    one_of("customers", "loyalty_tier", LOYALTY_TIERS),
    unique("items", "item_id"),
    positive("items", "unit_price"),
    less_than("items", "cost_price", "unit_price"),
    not_null("items", "category"),
    unique("txns", "transaction_id"),
    positive("txns", "total_amount"),
    positive("txns", "quantity"),
    within("txns", "discount_pct", 0, 1, check="discount_pct between 0-1"),
    refers("txns", "customer_id", "customers"),
    refers("txns", "item_id", "items"),
    refers("txns", "store_id", "stores"),
)


def _row_results(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """One scan and one aggregate for all row rules of a table, then one row per rule."""
    failing = [
        F.count(F.when(rule.broken(), True)).alias(f"failing_{i}") for i, rule in enumerate(rules)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *failing)
    results = F.array(*[
        F.struct(F.lit(rule.check).alias("check"), F.col(f"failing_{i}").alias("failing"))
        for i, rule in enumerate(rules)
    ])
    return counted.select("total", F.inline(results)).select(
        "check", F.lit(table).alias("table"), "failing", "total"
    )


def _unique_result(df: DataFrame, rule: UniqueRule) -> DataFrame:
    per_key = df.groupBy(rule.key).agg(F.count(F.lit(1)).alias("rows"))
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    return per_key.agg(
        (rows - F.count(F.lit(1))).alias("failing"), rows.alias("total")
    ).select(F.lit(rule.check).alias("check"), F.lit(rule.table).alias("table"), "failing", "total")


def _reference_result(df: DataFrame, parent: DataFrame, rule: ReferenceRule) -> DataFrame:
    return orphan_count(df, parent, rule.key).select(
        F.lit(rule.check).alias("check"), F.lit(rule.table).alias("table"), "failing", "total"
    )


def readable_lines(table: str, good: DataFrame, bad: DataFrame) -> DataFrame:
    """A row of the report: lines of a source that could not be read, of all its lines."""
    lines = [
        df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(broken).alias("broken"), "total")
        for broken, df in ((False, good), (True, bad))
    ]
    return with_status(lines[0].unionByName(lines[1]).agg(
        F.sum(F.when(F.col("broken"), F.col("total"))).alias("failing"), F.sum("total").alias("total")
    ).select(F.lit("lines readable").alias("check"), F.lit(table).alias("table"), "failing", "total"))


def with_status(results: DataFrame) -> DataFrame:
    """`check, table, failing, total` with the outcome and the share that passes."""
    passing = F.round((1 - F.col("failing") / F.col("total")) * 100, 1)
    return results.select(
        "check",
        "table",
        F.when(F.col("failing") == 0, "PASS").otherwise("FAIL").alias("status"),
        "failing",
        "total",
        F.when(F.col("total") > 0, passing).otherwise(100.0).alias("pass_pct"),
    )


def report(tables: dict[str, DataFrame], rules: Iterable[Rule] = STANDARD_RULES) -> DataFrame:
    """`(check, table, status, failing, total, pass_pct)`, one row per rule."""
    rules = list(rules)
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        row_rules = [r for r in rules if r.table == table and isinstance(r, RowRule)]
        if row_rules:
            parts.append(_row_results(tables[table], table, row_rules))
    for rule in rules:
        if isinstance(rule, UniqueRule):
            parts.append(_unique_result(tables[rule.table], rule))
        elif isinstance(rule, ReferenceRule):
            parts.append(_reference_result(tables[rule.table], tables[rule.parent], rule))
    return with_status(reduce(DataFrame.unionByName, parts))


def summary(results: DataFrame) -> DataFrame:
    """Number of checks per outcome."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == "FAIL")


def verdict(results: DataFrame) -> DataFrame:
    """One row: whether the gate blocks, and how many checks failed of how many."""
    failed = F.count_if(F.col("status") == "FAIL")
    return results.agg(
        (failed > 0).alias("blocked"),
        failed.alias("failed_checks"),
        F.count(F.lit(1)).alias("checks"),
    )


def enforce(results: DataFrame, blocking: bool = True) -> list:
    """Failed rows of the report (one per rule at most); raises on any unless told only to warn."""
    failed = failures(results).orderBy("table", "check").collect()
    if failed and blocking:
        raise QualityGateError(failed)
    return failed
