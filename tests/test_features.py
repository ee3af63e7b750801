"""Feature columns at every limit, with values worked out by hand."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from scoreloom.functions import bands, behaviour, geography, risk
from scoreloom.functions.numeric import number, on_grid
from scoreloom.functions.scoring import impact_factor, rule_score

NOON_MONDAY = dt.datetime(2024, 1, 8, 11, 0)  # not a commute, lunch or night hour, not a weekend
BASE = {"event_id": 1, "subject_id": "s", "ts": NOON_MONDAY, "processed_at": NOON_MONDAY, "event_type": "system",
        "event_subtype": "", "score_change": 0.0, "new_score": 650.0, "confidence": 0.8, "transaction_type": "",
        "transport_type": "", "amount": 0.0, "city": "Smallton", "region": "EAST", "country": "Kenya",
        "latitude": 0.0, "longitude": 0.0, "processing_error": "", "payload": '{"a":1}', "subject_type": "regular",
        "relationship_type": "", "is_positive": True, "intensity": 0.0, "age": 30}
SCHEMA = ("event_id int, subject_id string, ts timestamp, processed_at timestamp, event_type string, "
          "event_subtype string, score_change double, new_score double, confidence double, transaction_type string, "
          "transport_type string, amount double, city string, region string, country string, latitude double, "
          "longitude double, processing_error string, payload string, subject_type string, relationship_type string, "
          "is_positive boolean, intensity double, age int")


def check(spark, column, cases):
    """cases: list of (overrides, expected)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = [tuple({**BASE, **over}[n] for n in names) + (i,) for i, (over, _) in enumerate(cases)]
    df = geography.with_place_classes(spark.createDataFrame(rows, SCHEMA + ", i int"))
    got = [r["x"] for r in df.withColumn("x", column).orderBy("i").select("x").collect()]
    for (over, want), value in zip(cases, got):
        if isinstance(want, float):
            assert math.isclose(value, want, abs_tol=1e-9), (over, value, want)
        else:
            assert value == want, (over, value, want)


def change(*pairs):
    return [({"score_change": float(c)}, want) for c, want in pairs]


def score(*pairs):
    return [({"new_score": float(s)}, want) for s, want in pairs]


def at(*pairs):
    return [({"ts": dt.datetime(2024, 1, 8, h, 0)}, want) for h, want in pairs]


CASES = {
    "pattern": (bands.behaviour_pattern, change((1, "positive_behavior"), (-1, "negative_behavior"),
                                                (0, "neutral_behavior"))),
    "time_of_day": (bands.time_of_day, at((5, "night"), (6, "morning"), (11, "morning"), (12, "afternoon"),
                                          (17, "afternoon"), (18, "evening"), (21, "evening"), (22, "night"))),
    "names": (lambda: F.concat_ws("/", bands.weekday_name(), bands.month_name()), [({}, "Monday/January")]),
    "analytic_tier": (lambda: bands.analytic_tier(number("new_score")), score(
        (900, "excellent"), (899.9, "very_good"), (800, "very_good"), (700, "good"), (600, "fair"), (500, "poor"),
        (499.9, "very_poor"))),
    "config_tier": (lambda: bands.config_tier(number("new_score")), score(
        (0, "very_poor"), (199, "very_poor"), (199.5, "unknown"), (200, "poor"), (399, "poor"), (399.5, "unknown"),
        (400, "average"), (599, "average"), (599.5, "unknown"), (600, "good"), (799, "good"), (799.5, "unknown"),
        (800, "excellent"), (1000, "excellent"))),
    "closed_tier": (lambda: bands.closed_tier(number("new_score")), score(
        (799.5, "good"), (800, "excellent"), (600, "good"), (599.9, "average"), (400, "average"), (200, "poor"),
        (199.9, "very_poor"))),
    "direction": (bands.change_direction, change((1, "increase"), (-1, "decrease"), (0, "unchanged"))),
    "percentile": (lambda: bands.percentile_estimate(number("new_score")), score((650, 65.0), (1000, 100.0))),
    "z": (lambda: bands.z_estimate(number("score_change")), change((-75, -1.5))),
    "hour_bucket": (bands.hour_bucket, at((9, "2024-01-08_09"))),
    "week": (bands.week_label, [({}, "2024-W02"), ({"ts": dt.datetime(2027, 1, 1)}, "2027-W53"),
                                ({"ts": dt.datetime(2024, 12, 30)}, "2024-W01")]),
    "trend_category": (bands.trend_category, change((100, "significant_change"), (-100, "significant_change"),
                                                    (99.9, "moderate_change"), (-50, "moderate_change"),
                                                    (49.9, "minor_change"))),
    "trend_direction": (bands.trend_direction, change((3, 1.0), (-3, -1.0), (0, 0.0))),
    "age_group": (lambda: bands.age_group(F.col("age")), [({"age": a}, g) for a, g in (
        (17, "under-18"), (18, "18-25"), (25, "18-25"), (26, "26-35"), (65, "56-65"), (66, "66+"))]),
    "consistency": (behaviour.consistency, [
        ({"score_change": 10.0}, 0.8), ({"score_change": -10.1}, 0.7), ({"score_change": 50.0}, 0.7),
        ({"score_change": 100.0}, 0.6), ({"score_change": 100.1}, 0.5),
        ({"event_type": "financial"}, 0.9), ({"event_type": "social"}, 0.7), ({"event_type": "legal"}, 0.6),
        ({"event_type": "civic", "confidence": 0.95}, 1.0), ({"confidence": 0.9}, 0.8), ({"confidence": 0.69}, 0.7),
        ({"confidence": 0.7}, 0.8)]),
    "location_mobility": (behaviour.location_mobility, [
        ({}, 0.3), *at((7, 0.6), (9, 0.6), (10, 0.3), (12, 0.5), (14, 0.5), (17, 0.6), (19, 0.6), (22, 0.2), (6, 0.2)),
        ({"ts": dt.datetime(2024, 1, 7, 11)}, 0.5), ({"event_type": "transportation"}, 0.7),
        ({"event_type": "financial", "transaction_type": "card_payment"}, 0.6), ({"event_type": "financial"}, 0.3),
        ({"event_type": "social"}, 0.5), ({"event_type": "civic"}, 0.4),
        ({"event_type": "transportation", "ts": dt.datetime(2024, 1, 6, 8)}, 1.0)]),
    "velocity": (behaviour.trend_velocity, [
        ({"score_change": 100.0}, 1.1), ({"score_change": 100.0, "confidence": 0.95}, 1.2 * 1.1),
        ({"score_change": 100.0, "confidence": 0.5}, 0.8 * 1.1), ({"score_change": -100.0, "event_type": "legal"}, 1.65),
        ({"score_change": 100.0, "event_type": "financial", "transaction_type": "default"}, 2.2),
        ({"score_change": 100.0, "event_type": "financial", "transaction_type": "major_purchase"}, 1.43),
        ({"score_change": 100.0, "event_type": "financial", "transaction_type": "regular_payment"}, 0.77),
        ({"score_change": 100.0, "event_type": "civic"}, 1.21), ({"score_change": 100.0, "event_type": "social"}, 0.99),
        ({"score_change": 100.0, "event_subtype": "new_citizen"}, 0.55),
        ({"score_change": 100.0, "ts": dt.datetime(2024, 1, 8, 6)}, 0.8),
        ({"score_change": 100.0, "ts": dt.datetime(2024, 1, 8, 20)}, 1.0),
        ({"score_change": 100.0, "new_score": 900.0}, 0.88), ({"score_change": 100.0, "new_score": 700.0}, 0.99),
        ({"score_change": 100.0, "new_score": 10.0}, 1.43), ({"score_change": -900.0, "event_type": "legal"}, 5.0)]),
    "stability": (behaviour.trend_stability, [
        ({}, 0.7 + 0.2 - 0.05 + 0.09), ({"score_change": 25.0}, 0.7 + 0.1 - 0.05 + 0.06),
        ({"score_change": 50.0}, 0.7 - 0.1 - 0.05 + 0.06), ({"score_change": 100.0}, 0.7 - 0.2 - 0.05 + 0.03),
        ({"score_change": 101.0}, 0.7 - 0.3 - 0.05), ({"processing_error": "x"}, 0.7 + 0.2 - 0.05 + 0.09 - 0.2),
        ({"new_score": 950.0}, 1.0), ({"event_subtype": "data_correction"}, 0.7 + 0.2 - 0.05 - 0.1 + 0.09),
        ({"event_type": "social", "score_change": 5.0}, 0.7 + 0.2 - 0.05 + 0.05 + 0.06),
        ({"event_type": "social"}, 0.7 + 0.2 - 0.05 - 0.1 + 0.06),
        ({"event_type": "financial", "transaction_type": "bankruptcy"}, 0.7 + 0.2 - 0.05 - 0.4 + 0.12),
        ({"event_type": "legal", "score_change": -200.0, "new_score": 10.0, "confidence": 0.1}, 0.0)]),
    "geo_tier": (geography.geographic_tier, [({"city": "East London"}, "tier_1"), ({"city": "MILAN"}, "tier_2"),
                                             ({"country": "France"}, "tier_3"), ({}, "tier_4")]),
    "urban": (geography.urban_class, [
        ({"city": "New York"}, "urban"), ({"city": "Maple Farm"}, "rural"), ({"city": "Oak Grove"}, "suburban"),
        ({"latitude": 1.0, "longitude": 1.0}, "urban"), ({"latitude": 1.0}, "suburban"), ({"city": ""}, "suburban"),
        ({"city": "Hill City"}, "urban")]),
    "geo_mobility": (geography.geographic_mobility, [
        ({}, 0.2), ({"event_type": "transportation"}, 0.8), ({"event_type": "transportation", "transport_type": "flight"}, 1.0),
        ({"event_type": "transportation", "transport_type": "taxi"}, 0.9), ({"transport_type": "flight"}, 0.2),
        ({"event_type": "financial", "transaction_type": "atm_withdrawal"}, 0.5),
        ({"event_type": "financial", "transaction_type": "online_purchase"}, 0.1),
        ({"event_type": "social"}, 0.4), ({"event_type": "civic"}, 0.35), *at((7, 0.4), (19, 0.4), (20, 0.2))]),
    "distance": (geography.distance_from_centre, [
        ({}, 100.0), ({"latitude": 1.0, "longitude": 2.0}, 50.0), ({"latitude": 1.0}, 100.0), ({"country": "France"}, 150.0),
        ({"country": "Germany", "latitude": 52.1657, "longitude": 12.4515}, 111.32 * 3.0)]),
    "density": (geography.population_density, [
        ({}, 280.0), ({"city": "Tokyo", "country": "Japan"}, 24000.0), ({"city": "Ghent", "country": "Belgium"}, 420.0),
        ({"city": "Toronto", "country": "Canada"}, 8000 * 0.7 * 0.3),
        ({"city": "Maple Farm", "country": "United States"}, 1200 * 0.2 * 0.8)]),
    "economy": (geography.economic_index, [
        ({}, 50.0), ({"region": "Central East"}, 60.0), ({"city": "New York", "country": "United States", "region": "Capital"}, 100.0),
        ({"city": "Milan", "country": "Italy"}, 73.0), ({"city": "Lake", "country": "India"}, 50.0)]),
    "risk_category": (risk.risk_category, change((-50.1, "high_risk"), (-50, "medium_risk"), (-20.1, "medium_risk"),
                                                 (-20, "low_risk"))),
    "alert": (risk.alert_level, change((-100, "critical"), (50, "warning"), (49, "normal"))),
    "risk_score": (risk.risk_score, [({"score_change": -50.0, "new_score": 400.0}, (0.6 + 0.5) / 2)]),
    "default_probability": (risk.default_probability, score((250, 0.75))),
    "early_warning": (risk.early_warning, change((-75.1, 1.0), (-75, 0.5), (-25.1, 0.5), (-25, 0.0))),
    "mitigation": (risk.mitigation, [
        ({}, 0.7), ({"new_score": 800.0}, 0.8), ({"new_score": 400.0}, 0.6), ({"new_score": 399.0}, 0.4),
        ({"score_change": 1.0}, 0.85), ({"score_change": -51.0}, 0.5), ({"confidence": 0.95}, 0.8),
        ({"event_type": "civic"}, 0.9), ({"event_type": "financial", "transaction_type": "loan_payment"}, 0.85),
        ({"event_type": "financial", "transaction_type": "savings_deposit"}, 0.8), ({"event_type": "legal"}, 0.4),
        ({"event_type": "social"}, 0.75),
        ({"event_type": "legal", "new_score": 1.0, "score_change": -60.0, "confidence": 0.1}, 0.0)]),
    "fraud": (risk.fraud_score, [
        ({}, 0.05), ({"score_change": -200.0}, 0.45), ({"score_change": 100.0}, 0.25), ({"confidence": 0.49}, 0.35),
        ({"confidence": 0.5}, 0.15), ({"event_type": "financial", "transaction_type": "cash_advance"}, 0.25),
        ({"event_type": "financial", "transaction_type": "atm_withdrawal", "amount": 1000.0}, 0.05),
        ({"event_type": "financial", "transaction_type": "atm_withdrawal", "amount": 1000.1}, 0.2),
        ({"event_type": "financial", "transaction_type": "online_purchase"}, 0.1), ({"event_type": "identity"}, 0.3),
        ({"event_subtype": "data_correction"}, 0.2), *at((2, 0.15), (5, 0.15), (6, 0.05)),
        ({"city": ""}, 0.15), ({"country": ""}, 0.15), ({"processing_error": "x"}, 0.25),
        ({"event_type": "identity", "score_change": -250.0, "confidence": 0.1, "processing_error": "x"}, 1.0)]),
    "anomaly": (risk.anomaly, change((-200, 0.9), (100, 0.5), (99, 0.1))),
    "predictive": (lambda: risk.predictive_risk(90), [({"new_score": 0.0}, 0.5 * (1 - 90 / 365 * 0.2))]),
    "volatility": (risk.volatility, change((-75, 1.5))),
    "quality": (risk.data_quality, [({}, 100.0), ({"confidence": 0.79}, 80.0), ({"processing_error": "x"}, 50.0),
                                    ({"payload": "{}"}, 90.0),
                                    ({"payload": None, "confidence": 0.1, "processing_error": "x"}, 20.0)]),
    "efficiency": (risk.efficiency, [({"processed_at": NOON_MONDAY + dt.timedelta(milliseconds=m)}, e) for m, e in (
        (99, 100.0), (100, 80.0), (499, 80.0), (500, 60.0))]),
    "latency": (risk.latency_ms, [({"processed_at": NOON_MONDAY - dt.timedelta(microseconds=999900)}, -999),
                                  ({"processed_at": NOON_MONDAY + dt.timedelta(microseconds=1999)}, 1)]),
    "rule_score": (lambda: rule_score(F.lit(20.0), F.lit(1.2)), [({}, 19.2), ({"subject_type": "vip"}, 21.12)]),
    "impact": (impact_factor, [
        ({"relationship_type": "family_event", "intensity": 0.5}, 0.15),
        ({"relationship_type": "workplace_event", "intensity": 0.5, "is_positive": False}, 0.07),
        ({"relationship_type": "community_event", "intensity": 1.0}, 0.15), ({"intensity": 1.0}, 0.1)]),
    "grid": (lambda: on_grid(F.col("new_score")), [({"new_score": 0.1 + 0.2}, 0.3), ({"new_score": 1.0000005}, 1.000001)]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_feature(spark, name):
    build, cases = CASES[name]
    check(spark, build(), cases)


def test_missing_values_read_as_zero_values(spark):
    empty = spark.createDataFrame([(None,) * 24], SCHEMA).withColumn("ts", F.lit(NOON_MONDAY))
    row = empty.select(behaviour.consistency().alias("a"), risk.fraud_score().alias("b"),
                       geography.urban_class().alias("c"), bands.geographic_segment().alias("d")).first()
    assert math.isclose(row.a, 0.7) and math.isclose(row.b, 0.45) and row.c == "suburban" and row.d == "_"
