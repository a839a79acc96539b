"""Update cadence: frequency label -> days, and the due test."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._compat import as_col

# Days between refreshes per frequency label (case-sensitive);
# anything else, null or empty included, waits DEFAULT_DAYS.
FREQUENCY_DAYS = {
    "Daily": 1,
    "Weekly": 7,
    "Bi-weekly": 14,
    "Monthly": 30,
    "Quarterly": 90,
    "Semi-annual": 180,
    "Annual": 365,
    "Occasional": 180,
}
DEFAULT_DAYS = 180

MICROS_PER_DAY = 86_400_000_000


def frequency_days(freq, mapping: dict[str, int] | None = None, default: int = DEFAULT_DAYS) -> Column:
    """CASE over the mapping; extra labels (e.g. frequency codes) can be passed in."""
    f = as_col(freq)
    table = dict(FREQUENCY_DAYS)
    table.update(mapping or {})
    expr = None
    for label, days in table.items():
        expr = F.when(f == F.lit(label), F.lit(days)) if expr is None else expr.when(f == F.lit(label), F.lit(days))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def timestamp_literal(ts, like_ntz: bool = False) -> Column:
    """A timestamp literal built from text, so that no Python-side time zone
    conversion happens. `like_ntz` matches TIMESTAMP_NTZ columns."""
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, dt.datetime):
        ts = ts.isoformat(sep=" ")
    return F.lit(str(ts)).cast("timestamp_ntz" if like_ntz else "timestamp")


def days_between(last, now) -> Column:
    """Whole elapsed 24-hour days from `last` to `now`, floored (a negative
    fraction counts as -1, like Python's timedelta.days)."""
    diff = F.timestamp_diff("MICROSECOND", as_col(last), as_col(now))
    whole = diff - F.pmod(diff, F.lit(MICROS_PER_DAY))
    return (whole / F.lit(MICROS_PER_DAY)).cast("bigint")


def is_due(freq, last, now, mapping: dict[str, int] | None = None) -> Column:
    """True when at least the frequency interval has passed (boundary
    inclusive); null when `last` is null."""
    return days_between(last, now) >= frequency_days(freq, mapping)
