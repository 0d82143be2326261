"""Scalar rules as Column expressions; every one stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actionspark.config import (
    ACTION_CODES,
    FREQUENT_BUYER_FROM,
    HEAVY_BROWSER_ABOVE,
    HIGH_SPEND_ABOVE,
    MID_UP_TO,
    YOUNG_BELOW,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def best_action(
    age: str | Column = "age",
    spend: str | Column = "purchase_amount_last_month",
    purchases: str | Column = "num_purchases_last_month",
    browse: str | Column = "browsing_minutes_last_week",
) -> Column:
    """Label rule. A NULL input makes its comparison fail, so the row falls to the next branch."""
    age, spend, purchases, browse = (_col(c) for c in (age, spend, purchases, browse))
    valuable = (spend > HIGH_SPEND_ABOVE) | (purchases >= FREQUENT_BUYER_FROM)
    reachable_now = (browse > HEAVY_BROWSER_ABOVE) | (age < YOUNG_BELOW)
    return (
        F.when(valuable, "Email")
        .when(reachable_now, "Push")
        .when(age.between(YOUNG_BELOW, MID_UP_TO), "SMS")
        .otherwise("Email")
    )


def gender_ix(gender: str | Column = "gender") -> Column:
    return F.when(_col(gender) == "M", 1).otherwise(0)


def age_bucket(age: str | Column = "age", young: int = YOUNG_BELOW, mid: int = MID_UP_TO) -> Column:
    age = _col(age)
    return F.when(age < young, "young").when(age.between(young, mid), "mid").otherwise("senior")


def avg_purchase_value(
    amount: str | Column = "purchase_amount_last_month",
    purchases: str | Column = "num_purchases_last_month",
) -> Column:
    amount, purchases = _col(amount), _col(purchases)
    return F.when(purchases > 0, amount / purchases).otherwise(F.lit(0.0))


def is_high_spender(
    amount: str | Column = "purchase_amount_last_month", threshold: float = HIGH_SPEND_ABOVE
) -> Column:
    return (_col(amount) > threshold).cast("int")


def action_label(action: str | Column = "best_action") -> Column:
    """Email 0, SMS 1, anything else (NULL too) the last code."""
    action = _col(action)
    *named, (_, last) = ACTION_CODES
    out = F.when(F.lit(False), F.lit(last))
    for name, code in named:
        out = out.when(action == name, code)
    return out.otherwise(last)


def action_name(code: str | Column) -> Column:
    """Inverse of :func:`action_label`; a code outside the label set fails the job, NULL stays NULL."""
    code = _col(code)
    out = F.when(code.isNull(), F.lit(None).cast("string"))
    for name, value in ACTION_CODES:
        out = out.when(code == value, name)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown action code: "), code.cast("string"))))


def shallow_tree_label(
    age: str | Column = "age", purchases: str | Column = "num_purchases_last_month"
) -> Column:
    """A fixed depth-3 tree over two features: a scorer that SQL can state, hence checkable end to end."""
    age, purchases = _col(age), _col(purchases)
    return F.when(purchases >= 5, 0).when(age < YOUNG_BELOW, 2).when(age <= MID_UP_TO, 1).otherwise(0)
