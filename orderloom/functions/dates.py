"""Day keys (yyyymmdd), month keys (yyyymm), month counters and clock shifts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

Months = Iterable[int] | None


# --- expressions -----------------------------------------------------------

def month_key(ts: Column | str) -> Column:
    ts = col(ts)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def day_key(ts: Column | str) -> Column:
    ts = col(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("int")


def month_of_day_key(c: Column | str) -> Column:
    return F.floor(col(c) / 100).cast("int")


def day_from_key(c: Column | str) -> Column:
    """Midnight of a day key; missing for a key that is no day."""
    return clock_from_key(c, None)


def clock_from_key(day: Column | str, time: Column | str | None) -> Column:
    """Wall clock of a day key and an hhmmss number; missing where they name no moment."""
    d = col(day).cast("int")
    zero = F.lit(0)
    if time is None:
        hms = (zero, zero, zero)
    else:
        t = F.lpad(col(time).cast("string"), 6, "0").try_cast("int")
        hms = (F.floor(t / 10000).cast("int"), F.floor(t / 100).cast("int") % 100, t % 100)
    return F.try_make_timestamp_ntz(
        F.floor(d / 10000).cast("int"), F.floor(d / 100).cast("int") % 100, d % 100, *hms
    )


def ymm2ym(c: Column | str) -> Column:
    """Month counter (year * 12 + month) to month key."""
    before = col(c) - 1
    return (F.floor(before / 12) * 100 + before % 12 + 1).cast("int")


def ym2ymm(c: Column | str) -> Column:
    """Month key to month counter."""
    c = col(c)
    return (F.floor(c / 100) * 12 + c % 100).cast("int")


def shift_zone(ts: Column | str, source: str, target: str) -> Column:
    """Wall clock of one zone as wall clock of another.

    The hour that the source clock shows twice in autumn is read as standard time: there
    the next hour is two hours away on the target clock, so the later reading is taken.
    """
    ts = col(ts)
    hour = F.expr("interval 1 hour")

    def convert(x: Column) -> Column:
        return F.convert_timezone(F.lit(source), F.lit(target), x)

    here = convert(ts)
    return F.when(convert(ts + hour) - here == F.expr("interval 2 hour"), here + hour).otherwise(here)


# --- month lists -----------------------------------------------------------

def as_months(months: Months | int) -> tuple[int, ...] | None:
    """Sorted distinct month keys, or None for every month."""
    if months is None:
        return None
    if isinstance(months, int):
        months = (months,)
    result = tuple(sorted({int(m) for m in months}))
    for m in result:
        if not 1 <= m % 100 <= 12:
            raise ValueError(f"not a month key: {m}")
    return result


def next_month(ym: int) -> int:
    return ym + 1 if ym % 100 < 12 else ym + 89


def previous_month(ym: int) -> int:
    return ym - 1 if ym % 100 > 1 else ym - 89


def month_from_counter(ymm: int) -> int:
    return (ymm - 1) // 12 * 100 + (ymm - 1) % 12 + 1


def counter_from_month(ym: int) -> int:
    return ym // 100 * 12 + ym % 100


def month_range(first: int, last: int) -> tuple[int, ...]:
    """Every month key from first to last."""
    return tuple(
        month_from_counter(n) for n in range(counter_from_month(first), counter_from_month(last) + 1)
    )


def _runs(months: tuple[int, ...]) -> list[tuple[int, int]]:
    """Months as runs without gaps: (first, month after the last)."""
    runs: list[tuple[int, int]] = []
    for m in months:
        if runs and runs[-1][1] == m:
            runs[-1] = (runs[-1][0], next_month(m))
        else:
            runs.append((m, next_month(m)))
    return runs


def _first_day(ym: int, slack_days: int = 0) -> dt.datetime:
    return dt.datetime(ym // 100, ym % 100, 1) + dt.timedelta(days=slack_days)


def sql_ts(moment: dt.datetime) -> str:
    """Wall-clock literal as SQL text."""
    return f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'"


def _ntz(moment: dt.datetime) -> Column:
    return F.expr(sql_ts(moment))


def day_start(day: dt.date) -> Column:
    """The first moment of a day as a literal."""
    return _ntz(dt.datetime(day.year, day.month, day.day))


def month_start(ym: int, slack_days: int = 0) -> Column:
    """The first moment of a month as a literal, moved by some days."""
    return _ntz(_first_day(ym, slack_days))


def in_months(ts: Column | str, months: Months | int, slack_days: int = 0) -> Column:
    """Timestamp lies in one of the months, as ranges that reach the file scan.

    ``slack_days`` widens every range on both ends, for a coarse test before an exact one. None takes every month, and
    like any list no row without a timestamp.
    """
    months = as_months(months)
    ts = col(ts)
    if months is None:
        return ts.isNotNull()
    test = F.lit(False)
    for first, after in _runs(months):
        test = test | (
            (ts >= _ntz(_first_day(first, -slack_days))) & (ts < _ntz(_first_day(after, slack_days)))
        )
    return test


def key_in_months(day: Column | str, months: Months | int) -> Column:
    """Day key lies in one of the months: ranges that reach the file scan, then the exact test.

    A list gives what its months give one by one: a key between two neighbouring months (day 0, day 50) belongs to
    neither. None takes every key whose month is 1 to 12 and whose day is 1 to 31.
    """
    months = as_months(months)
    day = col(day)
    is_day = (day % 100).between(1, 31)
    if months is None:
        return day.isNotNull() & is_day & (month_of_day_key(day) % 100).between(1, 12)
    test = F.lit(False)
    for first, after in _runs(months):
        test = test | ((day >= first * 100 + 1) & (day <= previous_month(after) * 100 + 31))
    return test & is_day & month_of_day_key(day).isin(*months)


def month_in(ym: Column | str, months: Months | int) -> Column:
    """Month key is one of the months, as a range that reaches the file scan and the exact test; None: any real month."""
    months = as_months(months)
    ym = col(ym)
    if months is None:
        return ym.isNotNull() & (ym % 100).between(1, 12)
    return ym.between(months[0], months[-1]) & ym.isin(*months) if months else F.lit(False)
