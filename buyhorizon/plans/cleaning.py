"""User cleaning: users removed from training and test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import in_date_ranges
from ..functions.slices import slice_names, slice_pred
from ..operators.enrich import join_order_sku
from ..sources.fixtures import Tables
from ..spec import FeatureSpec


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select("user_id").distinct()


def users_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Users of ``a`` not in ``b`` (set difference as an anti join)."""
    return distinct_users(a).join(distinct_users(b), "user_id", "left_anti")


def buyers_without_actions(t: Tables) -> DataFrame:
    return users_difference(t.order, t.action)


def order_counts_of(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct orders per user for the given users (semi join)."""
    return (orders.join(users, "user_id", "left_semi")
                  .groupBy("user_id").agg(F.count_distinct("o_id").alias("o_id")))


def clean_few_orders_no_action(t: Tables, spec: FeatureSpec) -> DataFrame:
    """Buyers without any action whose distinct order count is in range."""
    counts = order_counts_of(t.order, buyers_without_actions(t))
    return counts.where(F.col("o_id").between(spec.few_orders_min, spec.few_orders_max))


def union_user_sets(*sets: DataFrame) -> DataFrame:
    out = sets[0].select("user_id")
    for s in sets[1:]:
        out = out.unionByName(s.select("user_id"))
    return out


def promo_only_users(orders: DataFrame, ranges) -> DataFrame:
    """Users who bought on promo days and never on other days."""
    promo = in_date_ranges(F.col("o_date"), ranges)
    return (orders.groupBy("user_id").agg(F.bool_and(promo).alias("_only"))
                  .where("_only").select("user_id"))


def clean_promo_only(t: Tables, spec: FeatureSpec) -> DataFrame:
    return promo_only_users(t.order, spec.cleaning_promo_days)


def clean_users_total(t: Tables, spec: FeatureSpec) -> DataFrame:
    """Full outer union of both sets (each user once)."""
    return union_user_sets(clean_few_orders_no_action(t, spec), clean_promo_only(t, spec)).distinct()


def apply_cleaning(df: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop the removed users' rows. The removed set is broadcast only when
    Spark's size estimate is under the broadcast threshold."""
    return df.join(removed.select("user_id"), "user_id", "left_anti")


# ---- commented-out variants (status C) ---------------------------------------

def clean_no_recent_orders(t: Tables, spec: FeatureSpec, start: dt.date, end: dt.date) -> DataFrame:
    """Users without a target-category order in [start, end]."""
    target = slice_names(spec, "2")[1]
    recent = (join_order_sku(t.order, t.sku)
              .where(F.to_date("o_date").between(F.lit(start), F.lit(end)) & slice_pred(spec, target)))
    return users_difference(t.user, recent)


def clean_lookers(t: Tables, spec: FeatureSpec, min_rate: float, max_orders: int) -> DataFrame:
    """Users whose looks per distinct order reach ``min_rate`` with few orders."""
    looks = (t.action.where(F.col("a_type") == spec.look_type)
             .groupBy("user_id").agg(F.sum("a_num").alias("a_num")))
    orders = t.order.groupBy("user_id").agg(F.count_distinct("o_id").alias("o_id"))
    j = orders.join(looks, "user_id", "left").withColumn("rate", F.try_divide(F.col("a_num").cast("double"), F.col("o_id")))
    return j.where((F.col("rate") >= min_rate) & (F.col("o_id") <= max_orders)).select("user_id")


def clean_single_day(t: Tables, day: dt.date) -> DataFrame:
    return promo_only_users(t.order, ((day, day),))
