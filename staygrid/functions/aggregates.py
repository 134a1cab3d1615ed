"""The aggregate functions of an hour's values, as expressions over some of a group's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _highest(v: Column, at: Column) -> Column:
    return F.coalesce(F.max(F.when(~F.isnan(v), v)), F.max(v))  # not-a-number only if nothing else is there


#: name -> expression of the value and its event time; rows to leave out have both null.
_FUNCTIONS: dict[str, Callable[[Column, Column], Column]] = {
    "mean": lambda v, at: F.avg(v),
    "median": lambda v, at: F.median(v),
    "sum": lambda v, at: F.sum(v),
    "min": lambda v, at: F.min(v),
    "max": _highest,
    "first": lambda v, at: F.min_by(v, F.when(at.isNotNull(), F.struct(at, v))),
    "last": lambda v, at: F.max_by(v, F.when(at.isNotNull(), F.struct(at, v))),
}
NAMES = tuple(_FUNCTIONS)


def check(name: str, concept: str = "") -> str:
    """The aggregate's name in lower case; ValueError if there is none."""
    if name.lower() not in _FUNCTIONS:
        raise ValueError(f"unsupported aggregation {name!r} for {concept!r}; there are {', '.join(NAMES)}")
    return name.lower()


def aggregate(name: str, value: str = "numeric_value", at: str = "at", only: Column | None = None) -> Column:
    """The aggregate of `value` over a group's rows, or those where `only` holds.

    `first` and `last` go by event time and, at one time, by value. A sum over rows that are all
    null is 0; over no rows every aggregate is null.
    """
    rows = F.lit(True) if only is None else only
    v, t = F.when(rows, F.col(value)), F.when(rows, F.col(at))
    out = _FUNCTIONS[check(name)](v, t)
    if name.lower() == "sum":
        out = F.when(F.count(F.when(rows, F.lit(1))) > 0, F.coalesce(out, F.lit(0.0)))
    return out


def in_range(value: str = "numeric_value", low: float | None = None, high: float | None = None) -> Column:
    """True for values that aren't null and lie within the bounds given, bounds included."""
    out = F.col(value).isNotNull()
    if low is not None:
        out = out & (F.col(value) >= F.lit(float(low)))
    if high is not None:
        out = out & (F.col(value) <= F.lit(float(high)))
    return out
