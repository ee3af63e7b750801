"""Configuration, rules and table schemas."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# The wire layout. The payload stays JSON text: its keys differ per event type.
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("subject_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_subtype", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("location", LOCATION),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("payload", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("event_name", T.StringType()),
])

# The binary-record layout (millisecond times, camelCase, fixed payload record, no country).
RECORD_EVENT = T.StructType([
    T.StructField("eventId", T.StringType()),
    T.StructField("subjectId", T.StringType()),
    T.StructField("eventType", T.StringType()),
    T.StructField("eventSubtype", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("sourceSystem", T.StringType()),
    T.StructField("severity", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("location", T.StructType([
        T.StructField("region", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ])),
    T.StructField("payload", T.StructType([
        T.StructField("amount", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ])),
])

PROFILE = T.StructType([
    T.StructField("subject_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("last_score_at", T.TimestampType()),
])

CONDITION = T.StructType([
    T.StructField("field", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("kind", T.StringType()),   # string, number, bool or nested
    T.StructField("text", T.StringType()),
    T.StructField("number", T.DoubleType()),
    T.StructField("flag", T.BooleanType()),
])

MULTIPLIER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("factor", T.DoubleType()),
    T.StructField("flag", T.StringType()),
])

RULE = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("logic", T.StringType()),
    T.StructField("conditions", T.ArrayType(CONDITION)),
    T.StructField("points", T.DoubleType()),
    T.StructField("multiplier", T.DoubleType()),
    T.StructField("cooldown_seconds", T.LongType()),
    T.StructField("max_in_period", T.IntegerType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("status", T.StringType()),
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("valid_to", T.TimestampType()),
    T.StructField("multipliers", T.ArrayType(MULTIPLIER)),
    T.StructField("custom_logic", T.StringType()),
])


@dataclass(frozen=True)
class Tier:
    name: str
    low: float
    high: float


@dataclass(frozen=True)
class Decay:
    """Points lost per whole day, down to a floor. Off unless ``enabled``."""

    enabled: bool = False
    points_per_day: float = 0.1
    floor: float = 0.0


# Score bounds, baseline and the five configured bands (both ends inclusive).
@dataclass(frozen=True)
class ScoreConfig:
    config_id: str = "default"
    baseline: float = 500.0
    low: float = 0.0
    high: float = 1000.0
    tiers: tuple[Tier, ...] = (
        Tier("very_poor", 0.0, 199.0),
        Tier("poor", 200.0, 399.0),
        Tier("average", 400.0, 599.0),
        Tier("good", 600.0, 799.0),
        Tier("excellent", 800.0, 1000.0),
    )
    decay: Decay = Decay()
    rule_ids: tuple[str, ...] | None = None
    include_tags: tuple[str, ...] = ()
    exclude_tags: tuple[str, ...] = ()


@dataclass(frozen=True)
class Condition:
    field: str
    operator: str
    value: Any

    def row(self) -> tuple:
        value = self.value
        if isinstance(value, bool):
            return (self.field, self.operator, "bool", None, None, value)
        if isinstance(value, (int, float)):
            return (self.field, self.operator, "number", None, float(value), None)
        if isinstance(value, dict):
            return (self.field, self.operator, "nested", None, None, None)
        return (self.field, self.operator, "string", str(value), None, None)


@dataclass(frozen=True)
class Multiplier:
    name: str
    factor: float
    flag: str


_OPERATOR_ALIASES = {"$eq": "EQUALS", "$gt": "GREATER_THAN"}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    event_type: str
    points: float
    multiplier: float = 1.0
    conditions: tuple[Condition, ...] = ()
    logic: str = "AND"
    name: str = ""
    cooldown_seconds: int | None = None
    max_in_period: int | None = None
    multipliers: tuple[Multiplier, ...] = ()
    tags: tuple[str, ...] = ()
    custom_logic: str | None = None
    status: str = "active"
    valid_from: dt.datetime = dt.datetime(2000, 1, 1)
    valid_to: dt.datetime | None = None

    @staticmethod
    def conditions_from_map(conditions: dict[str, Any]) -> tuple[Condition, ...]:
        """Turn ``{"amount": {"$gt": 0}, "event_subtype": "x"}`` into a condition list."""
        out: list[Condition] = []
        for key, expected in conditions.items():
            if isinstance(expected, dict):
                out += [Condition(key, _OPERATOR_ALIASES.get(op, op), v) for op, v in expected.items()]
            else:
                out.append(Condition(key, "EQUALS", expected))
        return tuple(out)

    def row(self, ord_: int) -> tuple:
        return (ord_, self.rule_id, self.name, self.event_type, self.logic,
                [c.row() for c in self.conditions], float(self.points), float(self.multiplier),
                self.cooldown_seconds, self.max_in_period, list(self.tags), self.status,
                self.valid_from, self.valid_to, [(m.name, float(m.factor), m.flag) for m in self.multipliers],
                self.custom_logic)


def _rule(rule_id, event_type, conditions, points, multiplier=1.0, **more) -> Rule:
    return Rule(rule_id, event_type, points, multiplier, Rule.conditions_from_map(conditions), **more)


# The six seeded rules.
SEED_RULES: tuple[Rule, ...] = (
    _rule("financial_positive", "financial",
          {"event_subtype": "payment_completed", "amount": {"$gt": 0}}, 10.0, tags=("finance", "reward")),
    _rule("financial_negative", "financial", {"event_subtype": "payment_failed"}, -15.0,
          tags=("finance", "penalty")),
    _rule("social_positive", "social", {"event_subtype": "volunteering"}, 20.0, 1.2, tags=("reward",)),
    _rule("legal_violation", "legal", {"event_subtype": "violation"}, -50.0, 1.5, tags=("penalty", "critical")),
    _rule("relationship_positive", "relationship", {"is_positive": True}, 5.0, tags=("reward",)),
    _rule("relationship_negative", "relationship", {"is_positive": False}, -8.0, tags=("penalty",)),
)

# Two more rules of our own, large enough to reach the high change bands.
STRESS_RULES: tuple[Rule, ...] = (
    _rule("stress_severe", "legal", {"severity_num": {"$gt": 0.8}}, -75.0, tags=("critical",)),
    _rule("stress_identity", "identity", {}, -220.0, tags=("critical",)),
)

ALL_RULES: tuple[Rule, ...] = SEED_RULES + STRESS_RULES

# Configuration as a table: one row per configuration, and one row per tier.
CONFIG_COLUMNS = ("config_id string, baseline double, low double, high double, decay_enabled boolean, "
                  "decay_points_per_day double, decay_floor double, rule_ids array<string>, include_tags array<string>, "
                  "exclude_tags array<string>")
TIER_COLUMNS = "config_id string, tier string, low double, high double"
