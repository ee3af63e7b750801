"""Consistency, mobility and trend indices of one processed event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.bands import analytic_tier, is_weekend
from scoreloom.functions.numeric import clamp01, has_error, number, pick, text

# The thresholds, weights and band names in the columns below are those the results are defined by.


def _size() -> Column:
    return F.abs(number("score_change"))


def confidence_step(high: float, low: float, default: float = 0.0) -> Column:
    """The adjustment most indices make for confidence above 0.9 or below 0.7."""
    c = number("confidence")
    return pick((c > 0.9, high), (c < 0.7, low), default=default)


def consistency() -> Column:
    size, kind = _size(), text("event_type")
    return clamp01(
        F.lit(0.5)
        + pick((size <= 10, 0.3), (size <= 50, 0.2), (size <= 100, 0.1))
        + pick((kind == "financial", 0.1), (kind == "social", -0.1), (kind == "legal", -0.2),
               (kind == "civic", 0.15))
        + confidence_step(0.1, -0.1))


def location_mobility(ts: str = "ts") -> Column:
    hour, kind = F.hour(ts), text("event_type")
    card_use = text("transaction_type").isin("atm_withdrawal", "card_payment")
    return clamp01(
        F.lit(0.3)
        + pick((hour.between(7, 9), 0.3), (hour.between(17, 19), 0.3), (hour.between(12, 14), 0.2),
               ((hour >= 22) | (hour <= 6), -0.1))
        + pick((is_weekend(ts), 0.2))
        + pick((kind == "transportation", 0.4), ((kind == "financial") & card_use, 0.3),
               (kind == "social", 0.2), (kind == "civic", 0.1)))


def with_trend_inputs(df: DataFrame) -> DataFrame:
    """Compute the tier once, so that the two trend indices share it."""
    return df.withColumn("analytic_tier", analytic_tier(number("new_score")))


def trend_velocity(ts: str = "ts", tier: Column | None = None) -> Column:
    kind, money, hour = text("event_type"), text("transaction_type"), F.hour(ts)
    tier = analytic_tier(number("new_score")) if tier is None else tier
    financial = pick((money.isin("bankruptcy", "default"), 2.0),
                     (money.isin("large_transfer", "major_purchase"), 1.3),
                     (money == "regular_payment", 0.7), default=1.0)
    velocity = (
        _size() / F.lit(100.0)
        * confidence_step(1.2, 0.8, default=1.0)
        * pick((kind == "legal", 1.5), (kind == "financial", financial), (kind == "civic", 1.1),
               (kind == "social", 0.9),
               ((kind == "system") & (text("event_subtype") == "new_citizen"), 0.5), default=1.0)
        * pick((hour.between(9, 17), 1.1), ((hour >= 22) | (hour <= 6), 0.8), default=1.0)
        * pick((tier == "excellent", 0.8), (tier.isin("very_good", "good"), 0.9),
               (tier.isin("poor", "very_poor"), 1.3), default=1.0))
    return F.least(velocity, F.lit(5.0))


def trend_stability(ts: str = "ts", tier: Column | None = None) -> Column:
    size, kind, money = _size(), text("event_type"), text("transaction_type")
    tier = analytic_tier(number("new_score")) if tier is None else tier
    financial = pick((money.isin("regular_payment", "salary_deposit", "bill_payment"), 0.15),
                     (money == "savings_deposit", 0.1),
                     (money.isin("large_withdrawal", "cash_advance"), -0.2),
                     (money.isin("loan_default", "bankruptcy"), -0.4))
    return clamp01(
        F.lit(0.7)
        + pick((size <= 10, 0.2), (size <= 25, 0.1), (size <= 50, -0.1), (size <= 100, -0.2), default=-0.3)
        + confidence_step(0.15, -0.15)
        + pick((tier == "excellent", 0.2), (tier == "very_good", 0.15), (tier == "good", 0.1),
               (tier == "fair", -0.05), (tier == "poor", -0.15), default=-0.25)
        + pick((kind == "civic", 0.1), (kind == "financial", financial), (kind == "legal", -0.3),
               (kind == "social", pick((number("score_change") > 0, 0.05), default=-0.1)),
               ((kind == "system") & (text("event_subtype") == "data_correction"), -0.1))
        + pick((is_weekend(ts), -0.05))
        + (consistency() - F.lit(0.5)) * F.lit(0.3)
        + pick((has_error(), -0.2)))
