"""Column helpers shared by operators and models. Every helper stays inside codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "in_period",
    "safe_ratio",
    "flag",
    "pad_code",
    "day_of_week",
    "is_weekend",
    "is_trading_day",
    "month_start",
    "roll",
    "by_threshold",
    "moment",
    "money",
    "struct_rows",
]


def in_period(at: Column, lo: Column, hi: Column) -> Column:
    """``at`` lies in the closed period [lo, hi]; a NULL ``hi`` means still open."""
    return (at >= lo) & (hi.isNull() | (at <= hi))


def safe_ratio(num: Column, den: Column) -> Column:
    """Quotient as DOUBLE; a zero or NULL divisor gives NULL, never 0 and never an error."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def flag(*conditions: Column) -> Column:
    """TRUE when any condition holds; a NULL comparison counts as not held."""
    out = F.lit(False)
    for cond in reversed(conditions):
        out = F.when(cond, F.lit(True)).otherwise(out)
    return out


def pad_code(prefix: str, key: Column, width: int) -> Column:
    """``prefix`` plus the zero-padded key. Keys longer than ``width`` are kept whole."""
    text = key.cast("string")
    padded = F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    return F.concat(F.lit(prefix), padded)


def day_of_week(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return day_of_week(day).isin(0, 6)


def is_trading_day(day: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(day) < 5


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def roll(key: Column, multiplier: int, offset: int, size: int = 100) -> Column:
    """Repeatable draw in [0, size) from an integer key."""
    return F.pmod(key * F.lit(multiplier) + F.lit(offset), F.lit(size))


def by_threshold(draw: Column, steps: list[tuple[int, str]], default: str) -> Column:
    """First label whose upper bound exceeds the draw. The draw is evaluated once per row
    and shared by all branches, so the shares add up as listed."""
    out = F.lit(default)
    for bound, label in reversed(steps):
        out = F.when(draw < bound, F.lit(label)).otherwise(out)
    return out


def moment(value: dt.datetime) -> Column:
    """TIMESTAMP_NTZ literal: the same wall-clock time whatever zone the session runs in."""
    return F.expr(f"timestamp_ntz'{value.isoformat(sep=' ')}'")


def money(value: Column, precision: int = 20, scale: int = 2) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def struct_rows(names: list[str], *rows: tuple) -> Column:
    """Array of like-named structs, to explode one row into several."""
    return F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, row)]) for row in rows])
