"""Risk, alert, fraud and quality columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.functions.bands import analytic_tier
from scoreloom.functions.behaviour import confidence_step
from scoreloom.functions.numeric import clamp01, has_error, number, pick, text

# The thresholds, weights and band names in the columns below are those the results are defined by.


def _size() -> Column:
    return F.abs(number("score_change"))


def risk_category() -> Column:
    change = number("score_change")
    return pick((change < -50, "high_risk"), (change < -20, "medium_risk"), default="low_risk")


def risk_level() -> Column:
    return analytic_tier(number("new_score"))


def alert_level() -> Column:
    return pick((_size() >= 100, "critical"), (_size() >= 50, "warning"), default="normal")


def default_probability() -> Column:
    return (F.lit(1000.0) - number("new_score")) / F.lit(1000.0)


def risk_score() -> Column:
    return (default_probability() + _size() / F.lit(100.0)) / F.lit(2.0)


def early_warning() -> Column:
    change = number("score_change")
    return pick((change < -75, 1.0), (change < -25, 0.5))


def mitigation() -> Column:
    score, change, kind, money = (number("new_score"), number("score_change"), text("event_type"),
                                  text("transaction_type"))
    return clamp01(
        F.lit(0.5)
        + pick((score >= 800, 0.3), (score >= 600, 0.2), (score >= 400, 0.1), default=-0.1)
        + pick((change > 0, 0.15), (change < -50, -0.2))
        + confidence_step(0.1, -0.1)
        + pick((kind == "civic", 0.2),
               (kind == "financial", pick((money.isin("loan_payment", "bill_payment"), 0.15),
                                          (money == "savings_deposit", 0.1))),
               (kind == "legal", -0.3), (kind == "social", 0.05)))


def fraud_score(ts: str = "ts") -> Column:
    kind, money, c, hour = text("event_type"), text("transaction_type"), number("confidence"), F.hour(ts)
    financial = pick((money.isin("large_transfer", "cash_advance"), 0.2),
                     ((money == "atm_withdrawal") & (number("amount") > 1000), 0.15),
                     (money == "online_purchase", 0.05))
    return clamp01(
        F.lit(0.05)
        + pick((_size() >= 200, 0.4), (_size() >= 100, 0.2))
        + pick((c < 0.5, 0.3), (c < 0.7, 0.1))
        + pick((kind == "financial", financial), (kind == "identity", 0.25),
               ((kind == "system") & (text("event_subtype") == "data_correction"), 0.15))
        + pick((hour.between(2, 5), 0.1))
        + pick(((text("country") == "") | (text("city") == ""), 0.1))
        + pick((has_error(), 0.2)))


def anomaly() -> Column:
    return pick((_size() >= 200, 0.9), (_size() >= 100, 0.5), default=0.1)


def predictive_risk(days: int) -> Column:
    return risk_score() * F.lit(1.0 - (days / 365.0 * 0.2))


def volatility() -> Column:
    return _size() / F.lit(50.0)


def latency_ms() -> Column:
    """Whole milliseconds between event and processing, truncated toward zero."""
    return F.timestamp_diff("MILLISECOND", F.col("ts"), F.col("processed_at"))


def latency_us() -> Column:
    return F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("processed_at"))


def data_quality() -> Column:
    empty = F.coalesce(F.col("payload"), F.lit("")).isin("", "{}", "null")
    return (F.lit(100.0) + pick((number("confidence") < 0.8, -20.0)) + pick((has_error(), -50.0))
            + pick((empty, -10.0)))


def efficiency() -> Column:
    return pick((latency_ms() < 100, 100.0), (latency_ms() < 500, 80.0), default=60.0)
