"""Row-level quality rules: evaluate them, or split a frame into passing and quarantined rows.

A row fails a rule when the predicate is FALSE or NULL. Splitting never looks at the failures array:
the passing half is a plain conjunction, which Catalyst can push into a typed Parquet scan, and the
array is built for the quarantined half only. Both halves are narrow, so no shuffle is involved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import FAILURES

FAILURES_COL = "_quality_failures"
SEVERITIES = ("error", "warning")


@dataclass(frozen=True)
class Rule:
    """One check as data; `passes` is SQL text or a function returning a Column."""

    name: str
    error_code: str
    severity: str
    description: str
    passes: str | Callable[[], Column]

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}, not {self.severity!r}")

    def predicate(self) -> Column:
        return F.expr(self.passes) if isinstance(self.passes, str) else self.passes()

    def fails(self) -> Column:
        return ~F.coalesce(self.predicate(), F.lit(False))

    def failure(self) -> Column:
        return F.struct(
            F.lit(self.error_code).alias("error_code"),
            F.lit(self.description).alias("error_msg"),
            F.lit(self.severity).alias("severity"),
        )


class QualityGate:
    def __init__(self, rules: Iterable[Rule]):
        self.rules = tuple(rules)

    def without(self, *error_codes: str) -> QualityGate:
        """The same gate with some checks lifted, as used when replaying quarantined rows."""
        return QualityGate(rule for rule in self.rules if rule.error_code not in error_codes)

    def failures(self) -> Column:
        """Failed rules in rule order; an empty typed array when all pass."""
        if not self.rules:
            return F.array().cast(FAILURES)
        flagged = [F.when(rule.fails(), rule.failure()) for rule in self.rules]
        return F.array_compact(F.array(*flagged))

    def passes(self) -> Column:
        """TRUE when no error rule fails; otherwise FALSE or NULL."""
        errors = [rule.predicate() for rule in self.rules if rule.severity == "error"]
        return reduce(lambda left, right: left & right, errors, F.lit(True))

    def evaluate(self, df: DataFrame) -> DataFrame:
        return df.withColumn(FAILURES_COL, self.failures())

    def _having(self, df: DataFrame, verdict: Column, computed: bool) -> DataFrame:
        if not computed:
            return df.filter(verdict)
        # The optimizer copies a filter below the projection that makes its inputs, which would run
        # every conversion once more per use. A term it may not move keeps the filter above.
        stays = F.monotonically_increasing_id() >= 0
        return df.withColumn("_verdict", verdict & stays).filter("_verdict").drop("_verdict")

    def passing(
        self, df: DataFrame, keep_warnings: bool = False, computed: bool = False
    ) -> DataFrame:
        """Rows that fail no error rule. Set `computed` when the checked columns are expensive
        expressions (parsed text) rather than stored columns: they are then evaluated once, but the
        rules are not pushed into a scan."""
        kept = self._having(df, F.coalesce(self.passes(), F.lit(False)) if computed else self.passes(),
                            computed)
        return self.evaluate(kept) if keep_warnings else kept

    def quarantined(self, df: DataFrame, computed: bool = False) -> DataFrame:
        return self.evaluate(
            self._having(df, ~F.coalesce(self.passes(), F.lit(False)), computed)
        )

    def split(self, df: DataFrame, computed: bool = False) -> tuple[DataFrame, DataFrame]:
        return self.passing(df, computed=computed), self.quarantined(df, computed)

    def tally(self, df: DataFrame) -> DataFrame:
        """Rows failing each rule, in one pass and one output row per rule, zero counts included."""
        if not self.rules:
            raise ValueError("a tally needs at least one rule")
        counts = df.agg(
            *(F.count_if(rule.fails()).alias(f"c{i}") for i, rule in enumerate(self.rules))
        )
        rows = F.array(
            *(
                F.struct(
                    F.lit(rule.error_code).alias("error_code"),
                    F.lit(rule.severity).alias("severity"),
                    F.col(f"c{i}").alias("failed_rows"),
                )
                for i, rule in enumerate(self.rules)
            )
        )
        return counts.select(F.inline(rows))


def failures_by_code(quarantined: DataFrame) -> DataFrame:
    """Per error code: rows that carry it, and rows where it is the first failure."""
    return (
        quarantined.select(F.posexplode(FAILURES_COL).alias("pos", "failure"))
        .groupBy(F.col("failure.error_code").alias("error_code"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("pos") == 0).alias("n_first"),
        )
    )
