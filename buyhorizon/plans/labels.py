"""Labels per (slip, user): purchases of target categories in the label window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_gap
from ..functions.slices import slice_names
from ..operators.calendar import explode_to_slips, sample_facts
from ..sources.fixtures import Tables
from ..spec import FeatureSpec
from .facts import label_orders

KEYS = ["slip", "user_id"]


def label_names(spec: FeatureSpec) -> tuple[str, str]:
    t = slice_names(spec, "2")[1]
    return f"label_{t}_BuyNums", f"label_{t}_IntervalDay"


def _target_label_orders(t: Tables, spec: FeatureSpec, anchor: dt.date, slips=None) -> DataFrame:
    anchors = spec.anchors(anchor, slips)
    return explode_to_slips(label_orders(t, spec, anchors), "o_date", anchors, 0, spec.label_window)


def label_aggregates(t: Tables, spec: FeatureSpec, anchor: dt.date, slips=None) -> DataFrame:
    """(slip, user_id, buy count, first day) for users with target orders.

    One exact distinct: Catalyst plans it without Expand, shuffling on
    (slip, user_id, o_id) first, so a hot user is spread over tasks."""
    buy, day = label_names(spec)
    lab = _target_label_orders(t, spec, anchor, slips)
    return lab.groupBy(*KEYS).agg(
        F.count_distinct("o_id").cast("bigint").alias(buy),
        day_gap(F.min("o_date"), F.min("anchor_ts")).alias(day),
    )


def attach_labels(spine: DataFrame, t: Tables, spec: FeatureSpec, anchor: dt.date,
                  is_training: bool = True, slips=None) -> DataFrame:
    """label_buy_count (missing -> 0), label_first_day (missing -> no_buy_day),
    or both -1 for inference (label_inference)."""
    buy, day = label_names(spec)
    if not is_training:
        return spine.withColumns({buy: F.lit(-1).cast("bigint"), day: F.lit(-1).cast("bigint")})
    agg = label_aggregates(t, spec, anchor, slips)
    return (spine.join(agg, KEYS, "left")
                 .withColumns({buy: F.coalesce(F.col(buy), F.lit(0).cast("bigint")),
                               day: F.coalesce(F.col(day), F.lit(spec.no_buy_day).cast("bigint"))}))


# ---- label variant of the second labelling module (status U) ----------------

def label_gap_variant(t: Tables, spec: FeatureSpec, anchor: dt.date, window: int = 30, slips=None) -> DataFrame:
    """Positives need a target order in the label window AND an action in the
    sample window; the day label is first order - last action (floored days).
    Other users get 0 / no_buy_day. The last action time is kept."""
    buy, day = label_names(spec)
    anchors = spec.anchors(anchor, slips)
    first = (_target_label_orders(t, spec, anchor, slips).groupBy(*KEYS)
             .agg(F.count_distinct("o_id").cast("bigint").alias(buy), F.min("o_date").alias("_first")))
    last_act = (sample_facts(t.action, "a_date", spec, anchor, window, slips)
                .groupBy(*KEYS).agg(F.max("a_date").alias("Sample_30_101_LastTime")))
    spine = t.user.select("user_id").withColumn(
        "_s", F.explode(F.array(*[F.struct(F.lit(s).alias("slip"), F.lit(a).alias("anchor")) for s, a in anchors])))
    spine = spine.select("user_id", F.col("_s.slip").alias("slip"))
    pos = (spine.join(first, KEYS, "inner").join(last_act, KEYS, "inner")
                .withColumn(day, day_gap(F.col("_first"), F.col("Sample_30_101_LastTime"))).drop("_first"))
    neg = (spine.join(pos.select(*KEYS), KEYS, "left_anti")
                .withColumns({buy: F.lit(0).cast("bigint"), day: F.lit(spec.no_buy_day).cast("bigint")}))
    return pos.unionByName(neg, allowMissingColumns=True)


def label_balance(labelled: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Positives, negatives and negatives per positive, per slip."""
    buy, _ = label_names(spec)
    return (labelled.groupBy("slip")
            .agg(F.count_if(F.col(buy) > 0).alias("positives"), F.count_if(F.col(buy) == 0).alias("negatives"))
            .withColumn("ratio", F.try_divide(F.col("negatives").cast("double"), F.col("positives"))))


def label_gap_inference(users: DataFrame, actions: DataFrame, spec: FeatureSpec, anchor: dt.date,
                        window: int = 30) -> DataFrame:
    buy, day = label_names(spec)
    last_act = (sample_facts(actions, "a_date", spec, anchor, window, [0])
                .groupBy("user_id").agg(F.max("a_date").alias("Sample_30_101_LastTime")))
    return (users.select("user_id").join(last_act, "user_id", "left")
                 .withColumns({buy: F.lit(-1).cast("bigint"), day: F.lit(-1).cast("bigint")}))
