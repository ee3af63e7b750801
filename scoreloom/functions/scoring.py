"""Points of one rule and the share of a change that reaches neighbours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.functions.numeric import number, pick, text

# Bonus for one profile type, and base share per kind of relationship event.
VIP_TYPE, VIP_FACTOR = "vip", 1.1
IMPACT_BASE = {"family_event": 0.3, "workplace_event": 0.2, "community_event": 0.15}
IMPACT_OTHER, IMPACT_NEGATIVE = 0.1, 0.7


def rule_score(points: Column, multiplier: Column) -> Column:
    vip = pick((text("subject_type") == VIP_TYPE, VIP_FACTOR), default=1.0)
    return points * (multiplier * vip * number("confidence"))


def impact_factor() -> Column:
    kind = text("relationship_type")
    base = pick(*[(kind == k, v) for k, v in IMPACT_BASE.items()], default=IMPACT_OTHER)
    positive = F.coalesce(F.col("is_positive"), F.lit(False))
    return base * number("intensity") * pick((positive, 1.0), default=IMPACT_NEGATIVE)
