"""The feature catalogue, declared as data.

Each row expands to one column per (window, slice, type, aggregate); the
full name is ``{family}_{window}slip_`` + the pattern. Names, slices and
window selections are fixed values: they must equal the reference's columns.

Window selectors: ``all`` = every window, ``recency`` = every window except
``spec.recency_skip_window``, ``long`` = only ``spec.long_window``.
Slice sets: ``5`` all/30_101/30/101/other, ``4`` all/30_101/30/101,
``3`` all/30_101/other, ``2`` all/30_101, ``targets`` 30_101/30/101/other,
``classes`` 30_101/30/101, ``1`` all (names come from the target categories of the spec).
"""

from __future__ import annotations

from dataclasses import dataclass

FAMILY_SOURCE = {"OC": "order", "CC": "comment", "AC": "action"}
SOURCE_TS = {"order": "o_date", "comment": "comment_create_tm", "action": "a_date"}


@dataclass(frozen=True)
class FeatureRow:
    key: str
    family: str
    kind: str
    col: str | None
    aggs: tuple
    slices: str
    pattern: str
    windows: str = "all"
    types: tuple = (None,)
    attrs: tuple = ()


R = FeatureRow
MMMS = ("min", "max", "mean", "std")

# Feature names, slices and windows of the three families.
CATALOGUE: tuple[FeatureRow, ...] = (
    # orders
    R("oc_orders_nunique", "OC", "nunique", "o_id", ("nunique",), "5", "{col}_{s}_nunique"),
    R("oc_orders_count", "OC", "agg", "o_id", ("count",), "5", "{col}_{s}_count"),
    R("oc_orders_share_count", "OC", "share_count", "o_id", (), "targets", "{col}_rate_count_{s}", "long"),
    R("oc_orders_share_nunique", "OC", "share_nunique", "o_id", (), "targets", "{col}_rate_nunique_{s}", "long"),
    R("oc_area_nunique", "OC", "nunique", "o_area", ("nunique",), "2", "{col}_{s}_nunique"),
    R("oc_quantity_sum", "OC", "agg", "o_sku_num", ("sum",), "5", "{col}_{s}_sum"),
    R("oc_quantity_mean", "OC", "agg", "o_sku_num", ("mean",), "3", "{col}_{s}_mean"),
    R("oc_days_nunique", "OC", "nunique", "o_date", ("nunique",), "5", "{col}_{s}_nunique"),
    R("oc_recency", "OC", "gap", "o_date", ("min", "mean", "std"), "2", "mess_{s}_{col}_{agg}", "recency"),
    R("oc_months_nunique", "OC", "nunique", "month_order", ("nunique",), "2", "{col}_{s}_nunique"),
    R("oc_category_nunique", "OC", "nunique", "cate", ("nunique",), "3", "{col}_{s}_nunique"),
    R("oc_last_order", "OC", "last", "o_date", (), "2", "{attr}_{s}_", "long",
      attrs=("price", "cate", "para_1", "para_2", "para_3", "o_area", "o_sku_num")),
    R("oc_last_on_promo", "OC", "last_promo", "o_date", (), "2", "{col}_sale_{s}_", "long"),
    R("oc_comment_delay", "OC", "delay", "comment_create_tm", MMMS, "2", "o_date_comment_create_tm_{s}_{agg}"),
    R("oc_max_quantity_recency", "OC", "max_measure", "o_sku_num", (), "2", "mess_max_sku_{s}_min"),
    R("oc_weekend_share", "OC", "weekend", "o_date", (), "2", "rate_weekend_{s}_o_date_weekday"),
    R("oc_day_of_month", "OC", "agg", "day_order", MMMS, "4", "{col}_{s}_{agg}"),
    R("oc_promo_share", "OC", "promo_nunique", "o_id", (), "4", "{col}_{s}_rate"),
    # comments
    R("cc_score", "CC", "agg", "score_level", ("count", "sum", "mean"), "2", "{col}_{s}_{agg}"),
    R("cc_recency", "CC", "gap", "comment_create_tm", ("min", "mean", "std"), "2", "mess_{s}_{col}_{agg}", "recency"),
    R("cc_last_comment", "CC", "last", "comment_create_tm", (), "2", "{attr}_{s}_", "long",
      attrs=("score_level", "price", "cate", "para_1", "para_2", "para_3")),
    R("cc_poor_share", "CC", "poor", "score_level", (), "1", "rate_poor_{s}_{col}"),
    R("cc_day_of_month", "CC", "agg", "day_comment", MMMS, "4", "{col}_{s}_{agg}"),
    # actions
    R("ac_days_nunique", "AC", "nunique", "a_date", ("nunique",), "2", "{col}_{s}_nunique"),
    R("ac_skus_nunique", "AC", "nunique", "sku_id", ("nunique",), "2", "{col}_{s}_nunique"),
    R("ac_volume", "AC", "agg", "a_num", ("sum", "mean"), "2", "{col}_{s}_{agg}"),
    R("ac_look_volume", "AC", "agg", "a_num", ("sum",), "2", "{col}_look_{s}_{agg}", types=("look",)),
    R("ac_star_volume", "AC", "agg", "a_num", ("sum",), "2", "{col}_star_{s}_{agg}", types=("star",)),
    R("ac_category_nunique", "AC", "nunique", "cate", ("nunique",), "2", "{col}_{s}_nunique"),
    R("ac_recency", "AC", "gap", "a_date", ("min", "mean", "std", "max"), "2", "mess_{s}_{col}_{agg}", "recency"),
    R("ac_look_recency", "AC", "gap", "a_date", ("min", "mean", "std"), "2", "look_mess_{s}_{col}_{agg}", "recency",
      types=("look",)),
    R("ac_star_recency", "AC", "gap", "a_date", ("min", "mean", "std"), "2", "star_mess_{s}_{col}_{agg}", "recency",
      types=("star",)),
    R("ac_last_action", "AC", "last", "a_date", (), "2", "{attr}_{s}_", "long",
      attrs=("a_num", "a_type", "price", "cate", "para_1", "para_2", "para_3")),
    R("ac_last_on_promo", "AC", "last_promo", "a_date", (), "2", "{col}_sale_{s}_", "long"),
    R("ac_look_conversion", "AC", "conversion", "o_id", (), "2", "look_order_{s}", types=("look",)),
    R("ac_star_conversion", "AC", "conversion", "o_id", (), "2", "star_order_{s}", types=("star",)),
    R("ac_max_action_recency", "AC", "max_measure", "a_num", (), "2", "mess_max_action_{s}_min"),
    R("ac_day_of_month", "AC", "agg", "day", MMMS, "4", "{col}_{s}_{agg}"),
    R("ac_look_day_of_month", "AC", "agg", "day", MMMS, "2", "{col}_{s}_look_{agg}", types=("look",)),
    R("ac_star_day_of_month", "AC", "agg", "day", MMMS, "2", "{col}_{s}_star_{agg}", types=("star",)),
    R("ac_promo_share", "AC", "promo_sum", "a_num", (), "4", "{col}_{s}_rate"),
    R("ac_look_promo_share", "AC", "promo_sum", "a_num", (), "4", "{col}_{s}_look_rate", types=("look",)),
    R("ac_star_promo_share", "AC", "promo_sum", "a_num", (), "4", "{col}_{s}_star_rate", types=("star",)),
)

# Features the reference defines but leaves switched off; not part of the 744.
VARIANTS: dict[str, tuple[FeatureRow, ...]] = {
    "ac_category_share": (
        R("ac_category_share", "AC", "share_count", "a_date", (), "classes", "{col}_rate_count_{s}", "long"),
        R("ac_category_share", "AC", "share_count", "a_date", (), "classes", "{col}_rate_count_{s}_look", "long", types=("look",)),
        R("ac_category_share", "AC", "share_count", "a_date", (), "classes", "{col}_rate_count_{s}_star", "long", types=("star",)),
    ),
}

BY_KEY = {r.key: r for r in CATALOGUE}
FAMILY_KEYS = {f: [r.key for r in CATALOGUE if r.family == f] for f in FAMILY_SOURCE}
