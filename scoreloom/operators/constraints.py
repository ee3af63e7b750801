"""Constraint checks: required keys, types, allowed values (C7), and required event fields (A3)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED_EVENT_FIELDS = ("event_id", "subject_id", "event_type")


@dataclass(frozen=True)
class Constraint:
    """``kind`` is required, enum, min, max or matches; ``arg`` is what it needs."""

    field: str
    kind: str
    arg: object = None

    def broken(self) -> Column:
        col = F.col(self.field)
        if self.kind == "required":
            return col.isNull() | (col.cast("string") == "")
        tests = {"enum": lambda: ~col.isin(*self.arg), "min": lambda: col < F.lit(self.arg),
                 "max": lambda: col > F.lit(self.arg), "matches": lambda: ~col.cast("string").rlike(str(self.arg))}
        return F.coalesce(tests[self.kind](), F.lit(False))

    def label(self) -> str:
        return f"{self.field}:{self.kind}"


# What a valid profile, rule and configuration must satisfy.
PROFILE_CONSTRAINTS = (
    Constraint("subject_id", "required"), Constraint("age", "required"), Constraint("age", "min", 0),
    Constraint("score", "required"), Constraint("status", "enum", ("active", "inactive", "suspended")),
)
RULE_CONSTRAINTS = (
    Constraint("rule_id", "required"), Constraint("points", "required"), Constraint("event_type", "required"),
    Constraint("status", "enum", ("active", "inactive", "deprecated")), Constraint("valid_from", "required"),
)
CONFIG_CONSTRAINTS = (
    Constraint("baseline", "required"), Constraint("low", "required"), Constraint("high", "required"),
)


def violations(df: DataFrame, key: str, constraints: Sequence[Constraint]) -> DataFrame:
    """One row per broken constraint, from one pass over the rows."""
    marks = F.array_compact(F.array(*[F.when(c.broken(), F.lit(c.label())) for c in constraints]))
    return df.select(F.col(key).alias("key"), F.explode(marks).alias("violation"))


def missing_field() -> Column:
    bad = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in REQUIRED_EVENT_FIELDS]
    return F.concat_ws(",", *bad)


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with all required fields, and the rest with the names of what is missing."""
    marked = events.withColumn("missing", missing_field())
    return marked.filter("missing = ''").drop("missing"), marked.filter("missing <> ''")
