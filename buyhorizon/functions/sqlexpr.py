"""Spark SQL expression text for the generated aggregations.

The feature families compile to hundreds of aggregate expressions. Building
them as Column objects costs one driver-to-JVM call per function node; as
SQL text each aggregation is parsed once.
"""

from __future__ import annotations

import datetime as dt

MICROS_PER_DAY = 86_400_000_000


def lit_date(d: dt.date) -> str:
    return f"DATE'{d.isoformat()}'"


def midnight_of(d) -> str:
    if isinstance(d, dt.date):
        return f"CAST({lit_date(d)} AS TIMESTAMP_NTZ)"
    return f"CAST(CAST({d} AS DATE) AS TIMESTAMP_NTZ)"


def micros(ts: str) -> str:
    """A timestamp without zone as microseconds since 1970, whatever the session's zone:
    from its date and time fields (timestampdiff would first cast it into the session's zone)."""
    return (f"(unix_date(to_date({ts})) * {MICROS_PER_DAY} + hour({ts}) * 3600000000 + minute({ts}) * 60000000 "
            f"+ CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT))")


def day_gap(later: str, earlier: str) -> str:
    """Whole days from ``earlier`` to ``later``, floored."""
    gap = f"({micros(later)} - {micros(earlier)})"
    return f"(({gap} - pmod({gap}, {MICROS_PER_DAY})) div {MICROS_PER_DAY})"


def in_date_ranges(ts: str, ranges) -> str:
    parts = []
    for a, b in ranges:
        parts.append(f"(to_date({ts}) = {lit_date(a)})" if a == b
                     else f"(to_date({ts}) BETWEEN {lit_date(a)} AND {lit_date(b)})")
    return f"coalesce({' OR '.join(parts) or 'false'}, false)"


def and_(*ps: str) -> str:
    ps = [p for p in ps if p and p != "true"]
    return "true" if not ps else " AND ".join(f"({p})" for p in ps)


def ratio(a: str, b: str) -> str:
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def capped_ratio(a: str, b: str, cap: float = 1.0) -> str:
    """a/b capped; a zero denominator (an infinite ratio) gives the cap."""
    return (f"CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN ({b}) = 0 THEN CASE WHEN ({a}) = 0 THEN CAST(NULL AS DOUBLE) ELSE {cap} END "
            f"ELSE least(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE), {cap}) END")
