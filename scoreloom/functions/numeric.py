"""Small numeric helpers shared by the feature columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 1e6
TIE = 1e-5  # a value within 1e-11 below a half goes up, so last-digit noise cannot decide a tie


def on_grid(x: Column) -> Column:
    """Put a double on the engine's 1e-6 grid.

    Scores and changes live on this grid, so the order in which doubles are added up
    (per day, per chunk, per micro-batch) never shows in a result or moves a row across a band limit.
    """
    return F.floor(x * F.lit(GRID) + F.lit(0.5 + TIE)) / F.lit(GRID)


def clamp(x: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.least(F.greatest(x, low), high)


def clamp01(x: Column) -> Column:
    return clamp(x, 0.0, 1.0)


def text(name: str) -> Column:
    """A string column with missing values read as ''."""
    return F.coalesce(F.col(name), F.lit(""))


def number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def pick(*cases: tuple[Column, object], default: object = 0.0) -> Column:
    """First matching case wins; ``pick((cond, value), ..., default=value)``."""
    out = F
    for cond, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def lookup(key: Column, table: dict[str, float], default: float | None = None) -> Column:
    """Value of ``key`` in a small fixed table."""
    cells = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    found = F.element_at(F.create_map(*cells), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def has_error() -> Column:
    return text("processing_error") != ""
