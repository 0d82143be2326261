"""Engine settings. Passed explicitly to whatever needs them; nothing reads the environment."""

from __future__ import annotations

from dataclasses import dataclass

# Feature lists in the order of the design matrix.
NUMERIC_FEATURES = (
    "age",
    "gender_ix",
    "income",
    "num_purchases_last_month",
    "purchase_amount_last_month",
    "avg_purchase_value",
    "browsing_minutes_last_week",
    "is_high_spender",
)
CATEGORICAL_FEATURES = ("region", "top_category", "age_bucket")

# Class codes of the label.
ACTION_CODES = (("Email", 0), ("SMS", 1), ("Push", 2))

# Thresholds of the label rule and of the features derived from it.
YOUNG_BELOW = 28
MID_UP_TO = 50
HIGH_SPEND_ABOVE = 600
FREQUENT_BUYER_FROM = 6
HEAVY_BROWSER_ABOVE = 200

# Alert level of the null rate in percent, trailing window in days.
NULL_RATE_ALERT_PCT = 5
TRAILING_DAYS = 7


@dataclass(frozen=True)
class EngineConfig:
    """Where the tables live and how the model is fitted.

    ``root`` must be on storage every executor can reach. ``fit_partitions`` is the parallelism of the fit (None: the
    session's shuffle partitions), ``fit_rows`` about how many labelled rows it takes at most (None: all), ``max_bins``
    how many thresholds it tries per number. ``max_depth`` 30 is the deepest tree the library builds. Of the tables that a
    job rewrites, ``keep_versions`` versions stay readable.
    """

    root: str
    numeric_features: tuple[str, ...] = NUMERIC_FEATURES
    categorical_features: tuple[str, ...] = CATEGORICAL_FEATURES
    model_name: str = "action_model"
    seed: int = 42
    test_fraction: float = 0.25
    trees: int = 200
    max_depth: int = 30
    fit_partitions: int | None = None
    fit_rows: int | None = 2_000_000
    max_bins: int = 256
    baseline_rows: int = 1000
    keep_versions: int = 3

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric_features + self.categorical_features
