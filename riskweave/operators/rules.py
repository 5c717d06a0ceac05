"""Weighted rules: score, flags, label."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import or_false


@dataclass(frozen=True)
class Rule:
    flag: str
    weight: int
    fires: Callable[[], Column]


# Thresholds, weights and the order in which flags are listed.
FAILED_LOGINS_ABOVE = 3
AMOUNT_ZSCORE_ABOVE = 3
ALERT_FROM_SCORE = 5

RULES = (
    Rule("FAILED_LOGIN", 1, lambda: F.col("failed_logins_24h") > FAILED_LOGINS_ABOVE),
    Rule("GEO_MISMATCH", 2, lambda: F.col("geo_mismatch")),
    Rule("HIGH_RISK_MERCHANT", 2, lambda: F.col("is_high_risk_merchant")),
    Rule("CUSTOMER_RISK", 2, lambda: F.col("customer_risk_level").isin("High", "Medium")),
    Rule(
        "PAST_FRAUD",
        2,
        lambda: or_false(F.col("customer_has_fraud_history"))
        | or_false(F.col("customer_past_fraud_count") > 0),
    ),
    Rule("ODD_HOURS", 1, lambda: F.col("odd_hours")),
    Rule("WEEKEND_LOGIN", 1, lambda: F.col("weekend_login")),
    Rule("NIGHT_LOGIN", 1, lambda: F.col("night_login")),
    # Rounded: means added up in another order must not move a score of exactly 3.
    Rule("AMOUNT_OUTLIER", 2, lambda: F.abs(F.round("amount_zscore", 6)) > AMOUNT_ZSCORE_ABOVE),
)


def reweighted(weights: dict[str, int], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules with other weights for some flags."""
    unknown = set(weights) - {rule.flag for rule in rules}
    if unknown:
        raise ValueError(f"no such rules: {sorted(unknown)}")
    return tuple(replace(r, weight=weights.get(r.flag, r.weight)) for r in rules)


def apply_rules(
    enriched: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    alert_from: int = ALERT_FROM_SCORE,
) -> DataFrame:
    """Add ``risk_score``, ``flags`` and ``label``; an unknown condition does not fire."""
    fired = [(rule, or_false(rule.fires())) for rule in rules]
    score = sum(
        (F.when(condition, rule.weight).otherwise(0) for rule, condition in fired), F.lit(0)
    )
    flags = F.concat_ws(",", *[F.when(condition, rule.flag) for rule, condition in fired])
    scored = enriched.select("*", score.alias("risk_score"), flags.alias("flags"))
    return scored.withColumn("label", (F.col("risk_score") >= alert_from).cast("int"))
