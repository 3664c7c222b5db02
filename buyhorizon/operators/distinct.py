"""Many exact distinct counts under different predicates, skew-safe.

``count(DISTINCT x) FILTER (p_i)`` for dozens of (x, p_i) pairs makes
Catalyst add an Expand that copies every row once per distinct group. Here
each row is expanded once per distinct *value column* instead, and carries a
bit mask of the predicates it satisfies:

1. rows in long form: (vid, value), one per value column;
2. group by (keys, vid, value) with ``bit_or(mask)``: the shuffle key holds
   the value, so one hot user is spread over many tasks, and the map-side
   partial aggregate collapses repeats before the shuffle;
3. group by keys with ``count_if(vid = k AND mask & bit <> 0)`` per request:
   algebraic, partially aggregated, so a hot user costs one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 62


@dataclass
class DistinctRequest:
    out: str          # output column name
    value_key: str    # identifies the value expression (same key = same value)
    value: str        # value expression (SQL), cast to bigint
    pred: str | tuple[str, ...]  # row predicate (SQL), or the conjuncts of it


def conditions(r: DistinctRequest) -> list[str]:
    """The conjuncts of a request's predicate."""
    return [p for p in ((r.pred,) if isinstance(r.pred, str) else r.pred) if p and p != "true"]


def value_keys(requests: list[DistinctRequest]) -> dict[str, str]:
    """The distinct values the requests count, by key; their order numbers them."""
    return {r.value_key: r.value for r in requests}


def long_rows(df: DataFrame, requests: list[DistinctRequest], columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` once per value, with ``_vid`` and ``_v``."""
    values = ", ".join(f"named_struct('_vid', {i}, '_v', CAST({v} AS BIGINT))" for i, v in enumerate(value_keys(requests).values()))
    return df.selectExpr(*columns, f"inline(array({values}))").where("_v IS NOT NULL")


def masked_counts(rows: DataFrame, keys: list[str], requests: list[DistinctRequest]) -> DataFrame:
    """Stages 2 and 3 over long rows that still have the predicates' columns. A row has one
    value; each condition is evaluated once a row, for all its requests; masks hold ``MAX_BITS`` each."""
    vids = {k: i for i, k in enumerate(value_keys(requests))}
    number: dict[str, int] = {}
    bits = []
    for r in requests:
        n = number[r.value_key] = number.get(r.value_key, -1) + 1
        bits.append((r, vids[r.value_key], n // MAX_BITS, 1 << (n % MAX_BITS)))
    masks = [f"_m{c}" for c in range(1 + max(c for _, _, c, _ in bits))]
    made = []
    for c, mask in enumerate(masks):
        # the bits of each value, less those that ask for a condition that does not hold: many requests share few conditions
        asked = lambda p: ", ".join(str(sum(bit for r, v, own, bit in bits if v == vid and own == c and (p is None or p in conditions(r)))) + "L" for vid in vids.values())
        every = dict.fromkeys(p for r, _, own, _ in bits if own == c for p in conditions(r))
        made.append(" & ".join([f"array({asked(None)})[_vid]", *[f"if({p}, -1L, ~(array({asked(p)})[_vid]))" for p in every]]) + f" AS {mask}")
    held = rows.selectExpr(*keys, "_vid", "_v", *made).where(" OR ".join(f"{m} <> 0" for m in masks))
    dedup = held.groupBy(*keys, "_vid", "_v").agg(*[F.bit_or(m).alias(m) for m in masks])
    return _agg_sql(dedup, keys, [f"count_if(_vid = {v} AND (_m{c} & {bit}) <> 0) AS {r.out}" for r, v, c, bit in bits])


def multi_distinct_counts(df: DataFrame, keys: list[str], requests: list[DistinctRequest]) -> DataFrame:
    """One row per key group with one count column per request (absent groups
    have no row; callers decide between null and 0)."""
    return masked_counts(long_rows(df, requests, df.columns), keys, requests)


def _agg_sql(df: DataFrame, keys: list[str], aggs: list[str]) -> DataFrame:
    """GROUP BY keys with aggregate expressions given as SQL text."""
    k = ", ".join(keys)
    return df.sparkSession.sql(f"SELECT {k}, {', '.join(aggs)} FROM {{t}} GROUP BY {k}", t=df)
