"""Date helpers: truncation, offsets, labels and the lateness cascade."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from .. import constants as K
from ._util import as_col

# A date is a 32-bit day number.  Sums that would not fit in one have no date;
# labels of such offsets come from the day count (``lateness_of_days``).
LAST_DAY_NUMBER = 2**31 - 1


def add_days(as_of, days) -> Column:
    """as_of + round-half-even(days) as a date; NULL when days is NULL, or when
    the sum lies outside the date type (some 5.8 million years away)."""
    d, start = F.bround(as_col(days)), as_col(as_of).cast("date")
    fits = F.abs(d + F.unix_date(start)) <= LAST_DAY_NUMBER
    return F.when(fits, F.date_from_unix_date((d + F.unix_date(start)).try_cast("int")))


def month_label(c) -> Column:
    """Date → 'July 2021', the year in plain digits however far away."""
    c = as_col(c)
    return F.concat(F.date_format(c, "MMMM"), F.lit(" "), F.year(c).cast("string"))


def date_text(c) -> Column:
    """Date → 'YYYY-MM-DD', also for years that client date types cannot hold."""
    c = as_col(c)
    return F.format_string("%d-%02d-%02d", F.year(c), F.month(c), F.day(c))


def lateness_edges(goal) -> list:
    """Arm edges: the goal date and the dates 1..6 and 12 months after it."""
    if isinstance(goal, (_dt.date, str)):
        goal = F.lit(goal).cast("date")
    return [goal] + [F.add_months(goal, m) for m in K.LATENESS_EDGE_MONTHS]


def lateness_label(d, goal=K.GOAL_DATE, labels=K.LATENESS_LABELS) -> Column:
    """Nine-arm cascade, first match wins, no default (a date that equals the
    12-month edge matches no arm and is NULL, as in the tracked program)."""
    return _lateness(as_col(d), lateness_edges(goal), labels)


def lateness_of_days(days, as_of, goal=K.GOAL_DATE, labels=K.LATENESS_LABELS) -> Column:
    """The label of ``as_of + days``, from the day count alone, so that an offset
    beyond every calendar still has one."""
    d = F.bround(as_col(days))
    return _lateness(d, [F.datediff(e, as_col(as_of)) for e in lateness_edges(goal)], labels)


def _lateness(d: Column, edges: list, labels) -> Column:
    g, e1, e2, e3, e4, e5, e6, e12 = edges
    arms = [
        ((d > g) & (d < e1), labels[0]),
        ((d >= e1) & (d < e2), labels[1]),
        ((d >= e2) & (d < e3), labels[2]),
        ((d >= e3) & (d < e4), labels[3]),
        ((d >= e4) & (d < e5), labels[4]),
        ((d >= e5) & (d < e6), labels[5]),
        ((d >= e6) & (d < e12), labels[6]),
        (d > e12, labels[7]),
        (d <= g, labels[8]),
    ]
    return bucket_cascade(arms)


def bucket_cascade(arms) -> Column:
    """``[(predicate, value), ...]`` → first matching value, else NULL."""
    out = None
    for pred, val in arms:
        out = F.when(pred, val) if out is None else out.when(pred, val)
    return out
