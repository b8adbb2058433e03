"""Quarantine: metadata on entry, and replay of quarantined rows under today's rules.

Replay is one narrow pass. Each row gets an outcome, and every target table is a filter on it, so no
key join is needed to take promoted rows out or to carry metadata along.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.quality import FAILURES_COL, QualityGate

MAX_ATTEMPTS = 3
METADATA = (
    FAILURES_COL, "_error_code", "_error_msg", "_quarantined_ts", "quarantined_date",
    "_replay_attempts",
)

PROMOTED, RETRY, ARCHIVED, EXHAUSTED, WAITING = (
    "promoted", "retry", "archived", "exhausted", "waiting",
)


def moment(as_of: datetime | str | None) -> Column:
    """A fixed instant, or the query's own clock when none is given."""
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def with_metadata(
    failed: DataFrame, as_of: datetime | str | None = None, raw_col: str = "_raw_json"
) -> DataFrame:
    """Failed rows with first failure, entry time, a zero attempt counter and the raw record."""
    raw = F.col(raw_col) if raw_col in failed.columns else F.lit(None).cast("string")
    extra: dict[str, Column] = {
        "_quarantined_ts": moment(as_of),
        "quarantined_date": F.to_date(moment(as_of)),
        "_replay_attempts": F.lit(0),
        "_raw_json": raw,
    }
    if FAILURES_COL in failed.columns:
        first = F.get(FAILURES_COL, F.lit(0))
        extra["_error_code"] = first["error_code"]
        extra["_error_msg"] = first["error_msg"]
    return failed.withColumns(extra)


class Replay:
    """Outcome of re-checking a quarantine table.

    Rows below `max_attempts` (and, when a window is given, quarantined within it) are eligible: they
    are promoted when they pass now, else retried with one more attempt, or archived when that was
    the last one. Rows already at the limit are exhausted; rows outside the window wait untouched.
    Every input row has exactly one outcome.
    """

    def __init__(
        self,
        quarantine: DataFrame,
        gate: QualityGate,
        as_of: datetime | str | None = None,
        window_hours: int | None = None,
        max_attempts: int = MAX_ATTEMPTS,
    ):
        attempts = F.col("_replay_attempts")
        in_window = F.lit(True)
        if window_hours is not None:
            in_window = F.col("_quarantined_ts") >= moment(as_of) - F.make_dt_interval(
                hours=F.lit(window_hours)
            )
        outcome = (
            F.when(attempts >= max_attempts, EXHAUSTED)
            .when(~F.coalesce((attempts < max_attempts) & in_window, F.lit(False)), WAITING)
            .when(gate.passes(), PROMOTED)
            .when(attempts + 1 >= max_attempts, ARCHIVED)
            .otherwise(RETRY)
        )
        tried = F.col("_outcome").isin(RETRY, ARCHIVED)
        checked = quarantine.withColumn("_outcome", outcome)
        updates: dict[str, Column] = {
            "_replay_attempts": F.when(tried, attempts + 1).otherwise(attempts),
        }
        if FAILURES_COL in quarantine.columns:
            updates[FAILURES_COL] = F.when(tried, gate.failures()).otherwise(F.col(FAILURES_COL))
        self.rows = checked.withColumns(updates)
        if "_error_code" in quarantine.columns and FAILURES_COL in quarantine.columns:
            first = F.get(FAILURES_COL, F.lit(0))
            self.rows = self.rows.withColumns({
                "_error_code": F.when(tried, first["error_code"]).otherwise(F.col("_error_code")),
                "_error_msg": F.when(tried, first["error_msg"]).otherwise(F.col("_error_msg")),
            })

    def _having(self, *outcomes: str) -> DataFrame:
        return self.rows.filter(F.col("_outcome").isin(*outcomes)).drop("_outcome")

    def promoted(self) -> DataFrame:
        """Rows for the clean table, without quarantine columns."""
        return self._having(PROMOTED).drop(*METADATA)

    def still_failing(self) -> DataFrame:
        """All rows tried and failed again, with their new attempt count."""
        return self._having(RETRY, ARCHIVED)

    def remaining(self) -> DataFrame:
        """New content of the quarantine table: waiting rows and rows with attempts left."""
        return self._having(WAITING, RETRY)

    def archive(self) -> DataFrame:
        """Rows that leave the quarantine for good without being promoted."""
        return self._having(ARCHIVED, EXHAUSTED)

    def metrics(self) -> DataFrame:
        """One row of run counters, by a job of its own; `observed` gets them from a pass over the rows."""
        return self.rows.agg(*_counters())

    def observed(self) -> Observation:
        """Count the outcomes in the next job that reads all `rows`, such as the one that stores them."""
        counted = Observation()
        self.rows = self.rows.observe(counted, *_counters())
        return counted


def _counters() -> list[Column]:
    of = lambda *names: F.count_if(F.col("_outcome").isin(*names))
    return [
        of(PROMOTED, RETRY, ARCHIVED).alias("eligible"), of(PROMOTED).alias("promoted"),
        of(RETRY, ARCHIVED).alias("still_failing"), of(ARCHIVED, EXHAUSTED).alias("archived"),
        of(WAITING).alias("waiting"),
    ]
