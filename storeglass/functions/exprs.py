"""Column helpers shared by the jobs."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, functions as F

# Statuses that count as a sale. The summary views know two, the reports a third one.
SOLD = ("shipped", "delivered")
SOLD_OR_COMPLETED = ("shipped", "delivered", "completed")
VOID = ("cancelled", "failed")

# The three weight tables (rating of an item, popularity of an item, engagement of a user).
RATING_WEIGHTS = {"view": 1.0, "cart": 3.0, "like": 4.0, "purchase": 5.0}
POPULARITY_WEIGHTS = {"view": 1.0, "purchase": 5.0, "like": 3.0}
ENGAGEMENT_WEIGHTS = {"view": 1.0, "like": 2.0, "cart": 3.0, "purchase": 5.0, "search": 1.0}

# Event type -> action of the behaviour log.
ACTIONS = {"view": "view", "cart": "cart_add", "purchase": "purchase", "like": "review", "search": "search"}


def moment(value) -> datetime:
    """A Python datetime from a datetime, a date or ISO text."""
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def days_before(value, days: int) -> datetime:
    return moment(value) - timedelta(days=days)


def months_before(value, months: int) -> datetime:
    """Calendar months back; the day is cut to the length of the month, as interval arithmetic does."""
    at = moment(value)
    index = at.year * 12 + at.month - 1 - months
    year, month = divmod(index, 12)
    day = min(at.day, calendar.monthrange(year, month + 1)[1])
    return at.replace(year=year, month=month + 1, day=day)


def at(value) -> Column:
    """Literal point in time. Folded before planning, so comparisons with it reach the parquet scan."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def span(column, start=None, end=None) -> Column:
    """Half-open range start <= column < end; either side may be missing."""
    column = F.col(column) if isinstance(column, str) else column
    parts = []
    if start is not None:
        parts.append(column >= at(start))
    if end is not None:
        parts.append(column < at(end))
    return reduce(Column.__and__, parts, F.lit(True)) if len(parts) != 1 else parts[0]


def in_month(column, year: int, month: int) -> Column:
    """Month test as a range: unlike year()/month() calls it is pushed to the scan."""
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    return span(column, datetime(year, month, 1), datetime(*following, 1))


def in_year(column, year: int) -> Column:
    return span(column, datetime(year, 1, 1), datetime(year + 1, 1, 1))


def month_of(column) -> Column:
    return F.trunc(F.to_date(column), "MM")


def seconds_between(start, end) -> Column:
    """Elapsed seconds with fractions."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0)


def exact_round(value, digits: int) -> Column:
    """Half-up rounding on a decimal, so that binary noise of a double cannot tip a tie."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("decimal(28,8)"), digits).cast("double")


def growth_rate(value, previous) -> Column:
    """Change against the previous value in percent; 0 without a positive previous value."""
    return F.when(previous > 0, (value - previous) / previous * 100).otherwise(F.lit(0.0))


def percent_of_sum(part, other) -> Column:
    """part in percent of part + other; null when both are 0."""
    return 100.0 * F.col(part) / F.nullif(F.col(part) + F.col(other), F.lit(0))


def chance(probability: float, seed: int) -> Column:
    """Random predicate: true for about this share of the rows, the same ones for the same seed and partitions."""
    return F.rand(seed) < probability


def distinct_count(column, approx: bool = False) -> Column:
    """Exact number of distinct values, or a sketch of it that needs no second shuffle."""
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def weight_of(column, weights: dict[str, float], default: float) -> Column:
    """Value -> weight with a default."""
    column = F.col(column) if isinstance(column, str) else column
    out = None
    for key, weight in weights.items():
        out = F.when(column == key, F.lit(float(weight))) if out is None else out.when(column == key, F.lit(float(weight)))
    return F.lit(float(default)) if out is None else out.otherwise(F.lit(float(default)))


def translate(column, mapping: dict[str, str]) -> Column:
    """Value -> value; unknown values stay as they are."""
    column = F.col(column) if isinstance(column, str) else column
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), column)


def all_of(*conditions) -> Column:
    """AND of those conditions that are given."""
    given = [c for c in conditions if c is not None]
    return reduce(Column.__and__, given) if given else F.lit(True)


def shorten(column, length: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.length(column) > length, F.concat(F.substring(column, 1, length), F.lit("..."))).otherwise(column)


def padded_id(prefix: str, column, width: int = 6) -> Column:
    return F.format_string(f"{prefix}_%0{width}d", F.col(column) if isinstance(column, str) else column)
