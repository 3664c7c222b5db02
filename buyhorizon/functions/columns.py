"""Scalar column helpers (all built-in expressions, no Python UDF)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def null_sentinel(df: DataFrame, cols: Iterable[str], sentinel: int = -1) -> DataFrame:
    """change_null: the sentinel value becomes SQL null."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in cols})


def with_date_parts(df: DataFrame, date_col: str, suffix: str = "") -> DataFrame:
    """scan_dated: year, month and day of the date column."""
    return df.withColumns({
        f"year{suffix}": F.year(date_col),
        f"month{suffix}": F.month(date_col),
        f"day{suffix}": F.dayofmonth(date_col),
    })


def midnight(d) -> Column:
    """A date (python or column) as a timestamp without zone at 00:00."""
    if isinstance(d, (dt.date, str)):
        return F.lit(str(d)[:10]).cast("date").cast("timestamp_ntz")
    return d.cast("date").cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """A timestamp without zone as microseconds since 1970, whatever the session's zone."""
    return (F.unix_date(F.to_date(ts)).cast("bigint") * MICROS_PER_DAY + F.hour(ts) * F.lit(3_600_000_000) + F.minute(ts) * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))


def day_gap(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, floored (pandas ``.dt.days``)."""
    gap = micros(later) - micros(earlier)
    return F.floor((gap - F.pmod(gap, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("bigint")


def in_date_ranges(ts: Column, ranges) -> Column:
    """Membership of the calendar day of ``ts`` in a set of closed day ranges."""
    d = F.to_date(ts)
    cond = F.lit(False)
    for a, b in ranges:
        cond = cond | (d.between(F.lit(a), F.lit(b)) if a != b else (d == F.lit(a)))
    return F.coalesce(cond, F.lit(False))


def ratio(num: Column, den: Column) -> Column:
    """Division with null for a zero or missing denominator (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def is_null_flag(c: Column) -> Column:
    return c.isNotNull().cast("int")
