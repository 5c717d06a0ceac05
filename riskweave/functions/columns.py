"""Derived columns: every function maps columns to a column, JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bands as (upper bound, label) with the label above the last bound.
TRANSACTION_DAY_BANDS = (
    (7, "Night (12AM-6AM)"),
    (12, "Morning (7AM-11AM)"),
    (18, "Afternoon (12PM-5PM)"),
)
TRANSACTION_EVENING = "Evening (6PM-11PM)"
LOGIN_DAY_BANDS = (
    (6, "Night (12AM-6AM)"),
    (12, "Morning (6AM-12PM)"),
    (18, "Afternoon (12PM-6PM)"),
)
LOGIN_EVENING = "Evening (6PM-12AM)"
LOGIN_NIGHT = "Night (12AM-6AM)"
AGE_BANDS = (
    (25, "Under 25"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
)
OLDEST_AGE_BAND = "65+"
UNKNOWN = "Unknown"
HIGH_RISK_CATEGORY_FROM = 0.5
MEDIUM_RISK_CATEGORY_FROM = 0.2
HIGH_RISK_MERCHANT_FROM = 0.7
HIGH_VALUE_ABOVE = 150
FRAUD_HISTORY_AMOUNT_ABOVE = 500
HOME_TOLERANCE_DEGREES = 0.01
RISK_LEVEL_CODES = {"Low": 0, "Medium": 1, "High": 2}
# Risk score of each merchant category.
CATEGORY_RISK = {
    "Groceries": 0.1,
    "Retail": 0.2,
    "Travel": 0.15,
    "Online": 0.25,
    "Gambling": 0.8,
    "Crypto": 0.7,
}
# Fixed value: what a null part contributes to a hashed surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def cleaned(value: Column, default: str | None = None) -> Column:
    """Spaces trimmed; nulls replaced first if a default is given."""
    return F.trim(value if default is None else F.coalesce(value, F.lit(default)))


def below(value: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose upper bound exceeds ``value``.

    Values past the last bound, and nulls, get ``otherwise``.
    """
    chain = F
    for bound, label in bands:
        chain = chain.when(value < bound, label)
    return chain.otherwise(otherwise)


def transaction_time_of_day(ts: Column) -> Column:
    return below(F.hour(ts), TRANSACTION_DAY_BANDS, TRANSACTION_EVENING)


def login_time_of_day(ts: Column) -> Column:
    return below(F.hour(ts), LOGIN_DAY_BANDS, LOGIN_EVENING)


def age_tier(age: Column) -> Column:
    return F.when(age.isNull(), UNKNOWN).otherwise(below(age, AGE_BANDS, OLDEST_AGE_BAND))


def customer_risk_level(fraud_count: Column) -> Column:
    return F.when(fraud_count > 5, "High").when(fraud_count > 2, "Medium").otherwise("Low")


def merchant_risk_category(score: Column) -> Column:
    """A null score is neither high nor medium, hence low."""
    return (
        F.when(score >= HIGH_RISK_CATEGORY_FROM, "High Risk")
        .when(score >= MEDIUM_RISK_CATEGORY_FROM, "Medium Risk")
        .otherwise("Low Risk")
    )


def amount_tier(amount: Column) -> Column:
    """A missing amount falls through to the highest tier."""
    return F.when(amount <= 100, "Low").when(amount <= 150, "Mid").otherwise("High")


def is_high_value(amount: Column) -> Column:
    """Unlike the tier, a missing amount is not of high value."""
    return or_false(amount > HIGH_VALUE_ABOVE)


def elevated_fraud_risk(
    risk_level: Column, has_history: Column, high_value: Column, amount: Column
) -> Column:
    risky_and_high = (risk_level == "High") & high_value
    history_and_large = has_history & (amount > FRAUD_HISTORY_AMOUNT_ABOVE)
    return or_false(risky_and_high) | or_false(history_and_large)


def degrees_between(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Straight-line distance in degrees; null as soon as a coordinate is."""
    return F.sqrt(F.pow(lat_a - lat_b, F.lit(2.0)) + F.pow(lon_a - lon_b, F.lit(2.0)))


def geo_mismatch(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """True unless both differences are small: a missing place is a mismatch."""
    near = (F.abs(lat_a - lat_b) < HOME_TOLERANCE_DEGREES) & (
        F.abs(lon_a - lon_b) < HOME_TOLERANCE_DEGREES
    )
    return ~or_false(near)


def account_age_day_part(created: Column, as_of: Column) -> Column:
    """Day component (0-30) of the years-months-days age at ``as_of``.

    Where the day of the month has not been reached yet, the missing days are
    borrowed from the month of the earlier date. Dates after ``as_of`` give the
    mirrored, negative component.
    """
    earlier, later = F.least(created, as_of), F.greatest(created, as_of)
    gap = F.dayofmonth(later) - F.dayofmonth(earlier)
    borrowed = F.when(gap < 0, gap + F.dayofmonth(F.last_day(earlier))).otherwise(gap)
    return F.when(created > as_of, -borrowed).otherwise(borrowed).cast("bigint")


def account_age_total_days(created: Column, as_of: Column) -> Column:
    return F.date_diff(as_of, created).cast("bigint")


def sunday_based_weekday(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def is_weekend(ts: Column) -> Column:
    return F.coalesce(F.dayofweek(ts).isin(1, 7), F.lit(False))


def surrogate_key(*parts: Column) -> Column:
    """MD5 of the parts as text, dash-separated, nulls as a fixed token."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def lookup(key: Column, mapping: Mapping[str, object]) -> Column:
    """Value of ``key`` in a fixed mapping, null where it has none."""
    chain = F
    for name, value in mapping.items():
        chain = chain.when(key == name, F.lit(value))
    return chain.otherwise(F.lit(None))


def category_risk(category: Column) -> Column:
    return lookup(category, CATEGORY_RISK)


def risk_level_code(level: Column) -> Column:
    return lookup(level, RISK_LEVEL_CODES)


def as_flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return or_false(condition).cast("int")


def or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
