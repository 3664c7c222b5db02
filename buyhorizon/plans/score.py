"""Ranking, submission and the competition score (S1, S2, S)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_gap, midnight
from ..functions.slices import slice_names, slice_pred
from ..operators.enrich import join_order_sku
from ..operators.ranking import first_per_user, global_rank, rank_weight
from ..sources.fixtures import Tables
from ..spec import FeatureSpec
from .labels import label_names


def rank_order(spec: FeatureSpec):
    buy, _ = label_names(spec)
    return [F.col(buy).desc(), F.col("user_id").asc()]


def predict_date(df: DataFrame, spec: FeatureSpec, anchor: dt.date) -> DataFrame:
    """anchor + int(day + offset) days, truncated toward zero."""
    _, day = label_names(spec)
    shift = (F.col(day) + F.lit(spec.day_offset)).cast("int")
    return df.withColumn("pred_date", F.date_add(F.lit(anchor), shift))


def rank_users(pred: DataFrame, spec: FeatureSpec) -> DataFrame:
    return pred.orderBy(*rank_order(spec))


def topk_users(pred: DataFrame, spec: FeatureSpec, anchor: dt.date, k: int | None = None) -> DataFrame:
    """The first K users by predicted count (TakeOrdered: K rows per task)."""
    return predict_date(pred, spec, anchor).orderBy(*rank_order(spec)).limit(k or spec.top_k)


def truth_first_order(t: Tables, spec: FeatureSpec, start: dt.date | None = None,
                      end: dt.date | None = None) -> DataFrame:
    """First target-category order date of each buyer in the truth period."""
    start, end = start or spec.truth_start, end or spec.truth_end
    target = slice_names(spec, "2")[1]
    o = join_order_sku(t.order, t.sku).where(
        F.to_date("o_date").between(F.lit(start), F.lit(end)) & slice_pred(spec, target))
    return first_per_user(o, ["o_date"], ["o_date"])


def ranked_predictions(pred: DataFrame, spec: FeatureSpec, anchor: dt.date) -> DataFrame:
    """The full list: user, both predictions, predicted date and position in rank order."""
    buy, day = label_names(spec)
    ranked = global_rank(predict_date(pred, spec, anchor), rank_order(spec), "position")
    return ranked.select("position", "user_id", buy, day, "pred_date")


def submission_pairs(submission: DataFrame, truth: DataFrame) -> DataFrame:
    """A written submission (position, user_id, pred_date) with weight, hit flag and both days of month."""
    weighted = submission.withColumn("wi", 1.0 / (1.0 + F.log(F.col("position").cast("double"))))
    real = truth.select("user_id", F.dayofmonth("o_date").alias("real_day"), F.lit(1).alias("oi"))
    return weighted.join(real, "user_id", "left").withColumn("pred_day", F.dayofmonth("pred_date")).fillna(0, ["oi", "real_day"])


def score_submission(submission: DataFrame, truth: DataFrame) -> DataFrame:
    """The score of a submission read back from its file."""
    return _score_of(submission_pairs(submission, truth), truth)


def scored_pairs(topk: DataFrame, truth: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Submission rows with weight, hit flag and both days of month."""
    ranked = rank_weight(topk, rank_order(spec))
    real = truth.select("user_id", F.dayofmonth("o_date").alias("real_day"), F.lit(1).alias("oi"))
    return (ranked.join(real, "user_id", "left")
                  .withColumn("pred_day", F.dayofmonth("pred_date"))
                  .fillna(0, ["oi", "real_day"]))


def score(topk: DataFrame, truth: DataFrame, spec: FeatureSpec) -> DataFrame:
    """S1 = sum(hit*w)/sum(w); S2 = sum over hits 10/(10+(pred_day-real_day)^2)
    / number of true buyers; S = 0.4*S1 + 0.6*S2. One row; a part whose
    denominator is empty is null."""
    return _score_of(scored_pairs(topk, truth, spec), truth)


def _score_of(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    return pairs.sparkSession.sql(
        """SELECT s1, s2, 0.4 * s1 + 0.6 * s2 AS s FROM (
             SELECT try_divide(sum(oi * wi), sum(wi)) AS s1,
                    try_divide(coalesce(sum(CASE WHEN oi = 1 THEN 10.0 / (10.0 + pow(pred_day - real_day, 2)) END), 0),
                               (SELECT count(*) FROM {truth})) AS s2
             FROM {pairs})""", pairs=pairs, truth=truth)


def baseline_predictions(t: Tables, spec: FeatureSpec, anchor: dt.date) -> DataFrame:
    """Hand-made predictions from the orders (used before any model exists):
    count = distinct target orders in the 180 days before the anchor; day =
    days since the last target order, modulo 31, plus 0.3; users without
    target orders: 0 and 15.0."""
    buy, day = label_names(spec)
    target = slice_names(spec, "2")[1]
    lo = anchor - dt.timedelta(days=180)
    hi = anchor - dt.timedelta(days=1)
    o = join_order_sku(t.order, t.sku).where(
        (F.col("o_date") >= midnight(lo)) & (F.col("o_date") <= midnight(hi)) & slice_pred(spec, target))
    agg = o.groupBy("user_id").agg(F.count_distinct("o_id").alias("_n"), F.max("o_date").alias("_last"))
    return (t.user.select("user_id").join(agg, "user_id", "left")
            .select("user_id",
                    F.coalesce(F.col("_n"), F.lit(0)).cast("double").alias(buy),
                    F.coalesce(F.pmod(day_gap(midnight(anchor), F.col("_last")), F.lit(31)).cast("double") + 0.3,
                               F.lit(15.0)).alias(day)))
