"""Parameters of the pipeline.

Every date, category, window and threshold the jobs use lives here, so the
same code runs on the competition calendar and on the fixture calendar.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

D = dt.date

DateRange = tuple[dt.date, dt.date]


@dataclass(frozen=True)
class FeatureSpec:
    # anchors: features read dates before the anchor, labels the month after
    train_anchor: dt.date = D(2001, 5, 1)
    valid_anchor: dt.date = D(2001, 6, 1)
    test_anchor: dt.date = D(2001, 7, 1)
    windows: tuple[int, ...] = (30, 60, 90, 180)
    label_window: int = 30
    # recency features skip the shortest window; last-event features use the longest
    recency_skip_window: int = 30
    long_window: int = 180
    slips: tuple[int, ...] = (0, 2, 3, 4)
    # target categories; the slice names are derived from them
    target_cates: tuple[int, ...] = (30, 101)
    look_type: int = 1
    star_type: int = 2
    poor_score: int = 3
    # promo calendar used by the feature families (closed day ranges)
    promo_days: tuple[DateRange, ...] = (
        (D(2001, 4, 1), D(2001, 4, 20)),
        (D(2000, 9, 11), D(2000, 9, 11)),
        (D(2000, 10, 12), D(2000, 10, 12)),
    )
    # cleaning parameters
    cleaning_promo_days: tuple[DateRange, ...] = ((D(1998, 1, 1), D(2001, 8, 1)),)
    few_orders_min: int = 1
    few_orders_max: int = 6
    # analyses and scoring
    repurchase_start: dt.datetime = dt.datetime(2000, 7, 1)
    repurchase_end: dt.datetime = dt.datetime(2001, 8, 1)
    truth_start: dt.date = D(2001, 7, 1)
    truth_end: dt.date = D(2001, 7, 31)
    top_k: int = 500
    day_offset: float = -0.51
    no_buy_day: int = 100
    # calendar chart
    calendar_start: dt.date = D(2000, 1, 1)
    calendar_end: dt.date = D(2000, 12, 31)
    calendar_bins: int = 20
    calendar_order_range: tuple[float, float] = (200.0, 6000.0)
    calendar_action_range: tuple[float, float] = (11000.0, 200000.0)

    @property
    def max_window(self) -> int:
        return max(self.windows)

    def anchors(self, anchor: dt.date | list[tuple[int, dt.date]], slips=None) -> list[tuple[int, dt.date]]:
        """(slip, anchor date) pairs: each slip steps back label_window + 1 days. Stated pairs are taken as they are."""
        if isinstance(anchor, list):
            return anchor
        step = self.label_window + 1
        return [(s, anchor - dt.timedelta(days=s * step)) for s in (self.slips if slips is None else slips)]

    def with_(self, **kw) -> "FeatureSpec":
        return replace(self, **kw)


FIXTURE_SPEC = FeatureSpec()
