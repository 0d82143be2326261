"""Feature and label projections, stamps, date filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.config import TRAILING_DAYS
from actionspark.functions import rules
from actionspark.functions.numeric import as_column
from actionspark.sources.schemas import FEATURES


def features(raw: DataFrame, run_ts, keep: Sequence[str] = ()) -> DataFrame:
    """The twelve feature columns in their fixed order and ``updated_at``; one projection, no shuffle."""
    derived = {
        "gender_ix": rules.gender_ix(),
        "avg_purchase_value": rules.avg_purchase_value(),
        "is_high_spender": rules.is_high_spender(),
        "age_bucket": rules.age_bucket(),
        "updated_at": as_column(run_ts),
    }
    return raw.select(
        *keep,
        *[derived[c].alias(c) if c in derived else F.col(c) for c in FEATURES.fieldNames()]
    )


def labels(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return raw.select(*keep, "customer_id", rules.action_label().alias("action_label"), "best_action")


def stamp(df: DataFrame, run_ts, log_date, version: str | Column) -> DataFrame:
    """Adds what identifies a run; the clock is the caller's, so a rerun gives the same rows."""
    version = version if isinstance(version, Column) else F.lit(version)
    return df.withColumns(
        {
            "log_date": as_column(log_date).cast("date"),
            "model_version": version.cast("string"),
            "inference_timestamp": as_column(run_ts),
        }
    )


def trailing(df: DataFrame, date_col: str, as_of=None, days: int = TRAILING_DAYS) -> DataFrame:
    """Rows from ``days`` days before ``as_of`` (by default the newest date) on. Both ends of the range count and there
    is no upper bound, so seven days back means eight calendar days. The bound has the column's type, and the
    newest date's is a subquery by itself: either reaches the scan."""
    kind = df.schema[date_col].dataType

    def bound(newest: Column) -> Column:
        return F.date_sub(newest.cast("date"), days).cast(kind)

    start = df.agg(bound(F.max(date_col))).scalar() if as_of is None else bound(as_column(as_of))
    return df.filter(F.col(date_col) >= start)


def present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def on_date(df: DataFrame, date_col: str, day) -> DataFrame:
    return df.filter(F.col(date_col) == as_column(day).cast("date"))
