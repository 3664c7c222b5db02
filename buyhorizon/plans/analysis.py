"""Exploratory analyses: the tables behind the reference's charts and prints."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_gap
from ..functions.slices import slice_names, slice_pred
from ..operators.enrich import join_order_sku
from ..operators.ranking import second_purchase
from ..sources.fixtures import Tables
from ..spec import FeatureSpec
from .cleaning import apply_cleaning, clean_few_orders_no_action, clean_promo_only, clean_users_total


def target_orders_in(t: Tables, spec: FeatureSpec, start: dt.datetime, end: dt.datetime,
                     removed: DataFrame | None = None) -> DataFrame:
    o = t.order if removed is None else apply_cleaning(t.order, removed)
    target = slice_names(spec, "2")[1]
    o = join_order_sku(o, t.sku).where(slice_pred(spec, target))
    return o.where((F.col("o_date") >= F.lit(start)) & (F.col("o_date") <= F.lit(end))) \
            .select("user_id", "o_date", "o_id")


def repurchase_pairs(t: Tables, spec: FeatureSpec) -> DataFrame:
    """(user_id, o_date_first, o_date_second, time_tag) for users with a second
    purchase (rule Q) in the repurchase window, after cleaning."""
    rows = target_orders_in(t, spec, spec.repurchase_start, spec.repurchase_end, clean_users_total(t, spec))
    first, second = second_purchase(rows, ["user_id", "o_date", "o_id"], ["o_date", "o_id"])
    return (first.select("user_id", F.col("o_date").alias("o_date_first"))
                 .join(second.select("user_id", F.col("o_date").alias("o_date_second")), "user_id")
                 .withColumn("time_tag", day_gap(F.col("o_date_second"), F.col("o_date_first"))))


def repurchase_gap_histogram(t: Tables, spec: FeatureSpec) -> DataFrame:
    """Users per day gap, as a share of ALL users in the user table."""
    hist = repurchase_pairs(t, spec).groupBy("time_tag").agg(F.count(F.lit(1)).alias("users"))
    # the denominator is a scalar subquery (one value), not a join
    return hist.sparkSession.sql(
        "SELECT time_tag, users / (SELECT count(*) FROM {u}) AS user_count FROM {h}", h=hist, u=t.user)


def daily_action_volume(t: Tables, spec: FeatureSpec) -> DataFrame:
    """Sum of action counts per day after removing the few-order users."""
    a = apply_cleaning(t.action, clean_few_orders_no_action(t, spec))
    return a.groupBy(F.to_date("a_date").alias("a_date")).agg(F.sum("a_num").alias("a_num_sum"))


def daily_order_count(t: Tables, spec: FeatureSpec) -> DataFrame:
    """Distinct orders per day after removing the cleaned users."""
    o = apply_cleaning(t.order, clean_users_total(t, spec))
    return o.groupBy(F.to_date("o_date").alias("o_date")).agg(F.count_distinct("o_id").alias("o_id_nunique"))


def calendar_bins(daily: DataFrame, date_col: str, value_col: str, start: dt.date, end: dt.date,
                  lo: float, hi: float, bins: int) -> DataFrame:
    """Every day of [start, end] with its value and one of ``bins`` equal bins
    over [lo, hi] (values outside clamp to the end bins; no value -> no bin)."""
    spark = daily.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(date_col))
    j = days.join(daily.where(F.col(date_col).between(F.lit(start), F.lit(end))), date_col, "left")
    b = F.width_bucket(F.col(value_col).cast("double"), F.lit(lo), F.lit(hi), F.lit(bins))
    return j.withColumn("bin", F.when(F.col(value_col).isNotNull(), F.least(F.greatest(b, F.lit(1)), F.lit(bins))))


def cohort_counts(t: Tables, spec: FeatureSpec) -> DataFrame:
    """Size of each cohort the reference prints."""
    few = clean_few_orders_no_action(t, spec)
    pairs = repurchase_pairs(t, spec)
    rows = target_orders_in(t, spec, spec.repurchase_start, spec.repurchase_end, clean_users_total(t, spec))
    tagged = (rows.select("user_id").distinct().withColumn("cohort", F.lit("first_buyers"))
              .unionByName(pairs.select("user_id").withColumn("cohort", F.lit("repeat_buyers")))
              .unionByName(few.select("user_id", F.concat(F.lit("no_action_orders_"), F.col("o_id").cast("string"))
                                      .alias("cohort")))
              .unionByName(few.select("user_id").withColumn("cohort", F.lit("no_action_few_orders")))
              .unionByName(clean_promo_only(t, spec).withColumn("cohort", F.lit("promo_only")))
              .unionByName(clean_users_total(t, spec).withColumn("cohort", F.lit("removed_total"))))
    return tagged.groupBy("cohort").agg(F.count(F.lit(1)).alias("users"))


def monthly_buyers(t: Tables) -> DataFrame:
    """Distinct buyers per calendar month number (all years together)."""
    return t.order.groupBy(F.month("o_date").alias("month")).agg(F.count_distinct("user_id").alias("buyers"))


def buyers_in_months(t: Tables, months) -> DataFrame:
    return (t.order.where(F.month("o_date").isin(list(months)))
                   .agg(F.count_distinct("user_id").alias("buyers")))
