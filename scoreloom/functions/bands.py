"""Bands, labels and simple ratios of a score or a score change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.functions.numeric import number, pick, text
from scoreloom.model import ScoreConfig

# The thresholds, weights and band names in the columns below are those the results are defined by.


def sign_label(change: Column, up: str, down: str, flat: str) -> Column:
    return pick((change > 0, up), (change < 0, down), default=flat)


def behaviour_pattern() -> Column:
    return sign_label(number("score_change"), "positive_behavior", "negative_behavior", "neutral_behavior")


def change_direction() -> Column:
    return sign_label(number("score_change"), "increase", "decrease", "unchanged")


def time_of_day(ts: str = "ts") -> Column:
    h = F.hour(ts)
    return pick((h.between(6, 11), "morning"), (h.between(12, 17), "afternoon"),
                (h.between(18, 21), "evening"), default="night")


def weekday_name(ts: str = "ts") -> Column:
    return F.date_format(ts, "EEEE")


def month_name(ts: str = "ts") -> Column:
    return F.date_format(ts, "MMMM")


def is_weekend(ts: str = "ts") -> Column:
    return F.dayofweek(ts).isin(1, 7)


def analytic_tier(score: Column) -> Column:
    """The six-band analytic tier; the other vocabulary is :func:`config_tier`."""
    return pick((score >= 900, "excellent"), (score >= 800, "very_good"), (score >= 700, "good"),
                (score >= 600, "fair"), (score >= 500, "poor"), default="very_poor")


def config_tier(score: Column, config: ScoreConfig = ScoreConfig()) -> Column:
    """Configured tier, both ends inclusive; a score in a gap between bands is ``unknown``.

    Where bands overlap, the one with the lowest minimum wins.
    """
    cases = [(score.between(t.low, t.high), t.name) for t in sorted(config.tiers, key=lambda t: t.low)]
    return pick(*cases, default="unknown")


def closed_tier(score: Column) -> Column:
    """Gap-free twin of the configured tier, used when a subject is created."""
    return pick((score >= 800, "excellent"), (score >= 600, "good"), (score >= 400, "average"),
                (score >= 200, "poor"), default="very_poor")


def percentile_estimate(score: Column) -> Column:
    return score / F.lit(1000.0) * F.lit(100.0)


def z_estimate(change: Column) -> Column:
    return change / F.lit(50.0)


def hour_bucket(ts: str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH")


def week_label(ts: str = "ts") -> Column:
    """Calendar year with ISO week number; the mismatch around new year is part of the format."""
    return F.format_string("%04d-W%02d", F.year(ts), F.weekofyear(ts))


def trend_category() -> Column:
    size = F.abs(number("score_change"))
    return pick((size >= 100, "significant_change"), (size >= 50, "moderate_change"), default="minor_change")


def trend_direction() -> Column:
    return F.signum(number("score_change"))


def trend_magnitude() -> Column:
    return F.abs(number("score_change"))


def geographic_segment() -> Column:
    return F.concat(text("country"), F.lit("_"), text("region"))


def data_segment() -> Column:
    return F.concat(text("event_type"), F.lit("_"), analytic_tier(number("new_score")))


def subject_segment() -> Column:
    return F.concat(F.lit("segment_"), analytic_tier(number("new_score")))


def age_group(age: Column) -> Column:
    return pick((age < 18, "under-18"), (age <= 25, "18-25"), (age <= 35, "26-35"), (age <= 45, "36-45"),
                (age <= 55, "46-55"), (age <= 65, "56-65"), default="66+")
