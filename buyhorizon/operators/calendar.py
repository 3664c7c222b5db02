"""Slip calendar: anchors, the range assignment of facts to slips, the spine.

A slip is one training sample date. For slip ``s`` the anchor is
``anchor0 - s * (label_window + 1)`` days; features read the closed day window
``[anchor - w, anchor - 1]`` and labels read ``[anchor, anchor + label_window]``.

Facts are assigned to slips without a join: the anchor list is a parameter
(a handful of dates), so each fact row carries the literal list, keeps the
anchors whose window holds its timestamp and is exploded. This is a narrow,
codegen'd Generate; no shuffle and nothing broadcast that grows with data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqlexpr as X
from ..spec import FeatureSpec


def slip_calendar(spec: FeatureSpec, anchor: dt.date, slips=None, window: int | None = None) -> list[dict]:
    """get_data_slip for every slip: sample and label bounds (both ends closed)."""
    w = window or spec.max_window
    out = []
    for s, a in spec.anchors(anchor, slips):
        out.append({
            "slip": s, "anchor": a,
            "sample_start": a - dt.timedelta(days=w), "sample_end": a - dt.timedelta(days=1),
            "label_start": a, "label_end": a + dt.timedelta(days=spec.label_window),
        })
    return out


def anchors_array(anchors: list[tuple[int, dt.date]]):
    return F.array(*[F.struct(F.lit(s).cast("int").alias("slip"), F.lit(a).cast("date").alias("anchor"))
                     for s, a in anchors])


def anchors_sql(anchors: list[tuple[int, dt.date]]) -> str:
    return "array(" + ", ".join(f"named_struct('slip', {int(s)}, 'anchor', {X.lit_date(a)})"
                                for s, a in anchors) + ")"


def explode_to_slips(df: DataFrame, ts_col: str, anchors: list[tuple[int, dt.date]],
                     lo_days: int, hi_days: int) -> DataFrame:
    """Pair each row with every slip whose window [anchor+lo, anchor+hi] (days,
    compared at midnight, closed) holds ``ts_col``. Adds ``slip``, ``anchor``
    and ``anchor_ts``. A row falls in at most len(anchors) slips."""
    first = min(a for _, a in anchors) + dt.timedelta(days=lo_days)
    last = max(a for _, a in anchors) + dt.timedelta(days=hi_days)
    # outer bound first: a plain range predicate Catalyst pushes to the scan
    pre = df.where(f"{ts_col} >= {X.midnight_of(first)} AND {ts_col} <= {X.midnight_of(last)}")
    hit = (f"x -> {ts_col} >= CAST(date_add(x.anchor, {lo_days}) AS TIMESTAMP_NTZ) "
           f"AND {ts_col} <= CAST(date_add(x.anchor, {hi_days}) AS TIMESTAMP_NTZ)")
    cols = [c for c in pre.columns if c not in ("slip", "anchor", "anchor_ts")]
    return (pre.selectExpr(*cols, f"explode(filter({anchors_sql(anchors)}, {hit})) AS _s")
               .selectExpr(*cols, "_s.slip AS slip", "_s.anchor AS anchor",
                           "CAST(_s.anchor AS TIMESTAMP_NTZ) AS anchor_ts"))


def sample_facts(df: DataFrame, ts_col: str, spec: FeatureSpec, anchor: dt.date, window: int, slips=None) -> DataFrame:
    """Facts in the feature window of each slip (filter_window_*)."""
    return explode_to_slips(df, ts_col, spec.anchors(anchor, slips), -window, -1)


def sample_spine(users: DataFrame, spec: FeatureSpec, anchor: dt.date, slips=None) -> DataFrame:
    """Every user once per slip (users x anchors by explode, no join)."""
    return (users.withColumn("_slip", F.explode(anchors_array(spec.anchors(anchor, slips))))
                 .withColumns({"slip": F.col("_slip.slip"), "anchor": F.col("_slip.anchor")})
                 .drop("_slip"))
