"""Hand-written cases, one per semantic rule (FIXTURES §4)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from buyhorizon.operators.calendar import sample_spine
from buyhorizon.operators.ranking import first_per_user, global_rank, rows_except_singleton
from buyhorizon.plans.features import build_features
from buyhorizon.plans.score import predict_date, score
from buyhorizon.plans.training import facts_of, onehot_users
from buyhorizon.sources import schemas
from buyhorizon.sources.fixtures import Tables
from buyhorizon.spec import FIXTURE_SPEC

ANCHOR = dt.date(2001, 7, 1)
SPEC = FIXTURE_SPEC.with_(train_anchor=ANCHOR, slips=(0,))
TS = dt.datetime


def tables(spark, users=(1,), sku=(), order=(), comment=(), action=()):
    return Tables(
        user=spark.createDataFrame([(u, 1, 0, 1) for u in users], schemas.USER),
        sku=spark.createDataFrame(list(sku), schemas.SKU),
        order=spark.createDataFrame(list(order), schemas.ORDER),
        comment=spark.createDataFrame(list(comment), schemas.COMMENT),
        action=spark.createDataFrame(list(action), schemas.ACTION),
    )


def features(spark, t, keys):
    spine = sample_spine(t.user.select("user_id"), SPEC, ANCHOR, [0])
    df = build_features(facts_of(t), spine, SPEC, ANCHOR, keys=keys, slips=[0])
    return {r["user_id"]: r.asDict() for r in df.collect()}


SKU30 = (10, 5.0, 30, 1, 2, 3)
SKU1 = (11, 7.0, 1, 1, 2, 3)


def test_user_without_rows_gets_nulls_not_zero(spark):
    t = tables(spark, users=(1, 2), sku=[SKU30], order=[(1, 10, 100, TS(2001, 6, 10), 1, 2)])
    f = features(spark, t, ["oc_orders_count", "oc_quantity_sum", "oc_orders_nunique"])
    assert f[1]["OC_30slip_o_id_all_count"] == 1
    assert all(v is None for k, v in f[2].items() if k.startswith("OC_"))


def test_single_row_spread_is_null(spark):
    t = tables(spark, sku=[SKU30], order=[(1, 10, 100, TS(2001, 6, 10), 1, 2)])
    f = features(spark, t, ["oc_day_of_month"])[1]
    assert f["OC_30slip_day_order_all_std"] is None
    assert f["OC_30slip_day_order_all_mean"] == 10


def test_all_null_scores_count_zero_sum_zero_mean_null(spark):
    t = tables(spark, sku=[SKU30], order=[(1, 10, 100, TS(2001, 6, 1), 1, 2), (1, 10, 101, TS(2001, 6, 2), 1, 2)],
               comment=[(1, 100, TS(2001, 6, 5), None), (1, 101, TS(2001, 6, 6), None)])
    f = features(spark, t, ["cc_score"])[1]
    assert f["CC_30slip_score_level_all_count"] == 0
    assert f["CC_30slip_score_level_all_sum"] == 0
    assert f["CC_30slip_score_level_all_mean"] is None


def test_unmatched_product_counts_in_all_and_other(spark):
    t = tables(spark, sku=[SKU30], order=[(1, 999, 100, TS(2001, 6, 10), 1, 2)])
    f = features(spark, t, ["oc_orders_count"])[1]
    assert f["OC_30slip_o_id_all_count"] == 1
    assert f["OC_30slip_o_id_other_count"] == 1
    assert f["OC_30slip_o_id_30_101_count"] is None


def test_comment_on_last_day_afternoon_is_excluded(spark):
    t = tables(spark, sku=[SKU30], order=[(1, 10, 100, TS(2001, 6, 1), 1, 2), (1, 10, 101, TS(2001, 6, 2), 1, 2)],
               comment=[(1, 100, TS(2001, 6, 30, 15, 0), 1), (1, 101, TS(2001, 6, 30, 0, 0), 2)])
    f = features(spark, t, ["cc_score"])[1]
    assert f["CC_30slip_score_level_all_count"] == 1
    assert f["CC_30slip_score_level_all_sum"] == 2


def test_gap_with_time_of_day_floors(spark):
    t = tables(spark, sku=[SKU30], order=[(1, 10, 100, TS(2001, 6, 1), 1, 2)],
               comment=[(1, 100, TS(2001, 6, 29, 15, 0), 1)])
    f = features(spark, t, ["cc_recency"])[1]
    # 2001-06-29 15:00 -> anchor 2001-07-01: 1 day 9 hours -> 1
    assert f["CC_60slip_mess_all_comment_create_tm_min"] == 1


def test_conversion_cap_zero_looks_and_missing_looks(spark):
    o = [(1, 10, 100, TS(2001, 6, 1), 1, 1), (1, 10, 101, TS(2001, 6, 2), 1, 1), (1, 10, 102, TS(2001, 6, 3), 1, 1),
         (2, 10, 200, TS(2001, 6, 1), 1, 1), (3, 10, 300, TS(2001, 6, 1), 1, 1)]
    a = [(1, 10, TS(2001, 6, 1), 1, 1), (1, 10, TS(2001, 6, 2), 1, 1),   # 3 orders / 2 looks -> 1.0
         (2, 10, TS(2001, 6, 1), 0, 1),                                   # a_num summed 0 -> 1.0
         (3, 10, TS(2001, 6, 1), 1, 2)]                                   # no look rows -> null
    t = tables(spark, users=(1, 2, 3), sku=[SKU30], order=o, action=a)
    f = features(spark, t, ["ac_look_conversion"])
    assert f[1]["AC_30slip_look_order_all"] == 1.0
    assert f[2]["AC_30slip_look_order_all"] == 1.0
    assert f[3]["AC_30slip_look_order_all"] is None


def test_share_without_category_rows_is_null(spark):
    t = tables(spark, sku=[SKU1], order=[(1, 11, 100, TS(2001, 6, 10), 1, 2)])
    f = features(spark, t, ["oc_orders_share_count"])[1]
    assert f["OC_180slip_o_id_rate_count_30_101"] is None
    assert f["OC_180slip_o_id_rate_count_other"] == 1.0


def test_equal_max_quantity_takes_earlier_day(spark):
    t = tables(spark, sku=[SKU30], order=[(1, 10, 100, TS(2001, 6, 3), 1, 5), (1, 10, 101, TS(2001, 6, 9), 1, 5),
                                          (1, 10, 102, TS(2001, 6, 20), 1, 2)])
    f = features(spark, t, ["oc_max_quantity_recency"])[1]
    assert f["OC_30slip_mess_max_sku_all_min"] == 28


def test_singleton_difference(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (1, "c")], "user_id long, v string")
    first = first_per_user(rows, ["v"], ["v"])
    out = rows_except_singleton(rows, first, ["user_id", "v"]).collect()
    assert [r["v"] for r in out] == ["c"]


def test_predicted_day_truncates(spark):
    df = spark.createDataFrame([(1, 0.3), (2, 1.0), (3, 5.6)], "user_id long, label_30_101_IntervalDay double")
    got = {r["user_id"]: r["pred_date"] for r in predict_date(df, SPEC, ANCHOR).collect()}
    assert got == {1: ANCHOR, 2: ANCHOR, 3: ANCHOR + dt.timedelta(days=5)}


def test_missing_age_has_no_dummy(spark):
    u = spark.createDataFrame([(1, None, 1, 2)], schemas.USER)
    vocab = {"sex": [0, 1], "user_lv_cd": [1, 2], "age": [1, 2, 3]}
    r = onehot_users(u, vocab).collect()[0].asDict()
    assert all(r[f"age_{v}"] == 0 for v in vocab["age"])
    assert r["sex_1"] == 1 and r["user_lv_cd_2"] == 1


def test_score_by_hand(spark):
    top = spark.createDataFrame([(1, 3.0, dt.date(2001, 7, 5)), (2, 2.0, dt.date(2001, 7, 9)), (3, 1.0, dt.date(2001, 7, 1))],
                                "user_id long, label_30_101_BuyNums double, pred_date date")
    truth = spark.createDataFrame([(1, TS(2001, 7, 6)), (4, TS(2001, 7, 2))], "user_id long, o_date timestamp_ntz")
    r = score(top, truth, SPEC).collect()[0]
    w = [1 / (1 + math.log(i)) for i in (1, 2, 3)]
    s1 = w[0] / sum(w)
    s2 = (10 / (10 + 1)) / 2
    assert r["s1"] == pytest.approx(s1)
    assert r["s2"] == pytest.approx(s2)
    assert r["s"] == pytest.approx(0.4 * s1 + 0.6 * s2)


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"), F.col("id"))
    got = global_rank(df.repartition(7), [F.col("k").desc(), F.col("id")], "r").collect()
    ranks = sorted((r["r"], r["k"]) for r in got)
    assert [r for r, _ in ranks] == list(range(1, 501))
    assert [k for _, k in ranks] == sorted((k for _, k in ranks), reverse=True)
