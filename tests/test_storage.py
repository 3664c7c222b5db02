"""The shared folder, zone-free results, submissions, medians, codes, and edge cases of the score."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from buyhorizon import session as S
from buyhorizon.operators.ranking import exact_median
from buyhorizon.plans import score as SC
from buyhorizon.plans.training import onehot_users, onehot_vocab, unknown_codes
from buyhorizon.sources import io as IO
from buyhorizon.spec import FIXTURE_SPEC as SPEC

SF = "/root/testdata/sf0.001"


def test_the_folder_is_resolved_once(spark):
    first = S.checkpoint_dir(spark)
    assert {S.checkpoint_dir(spark) for _ in range(200)} == {first}


class _Session:
    """A session of a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_dir(_Session())


def test_distinct_days_do_not_depend_on_the_session_zone(spark):
    from buyhorizon.registry import QUERIES
    keys = ["oc_days_nunique", "ac_days_nunique", "max_measure_per_user", "oc_last_order", "oc_comment_delay", "cc_recency", "time_gap", "label_gap_variant"]
    before = {k: sorted(map(str, QUERIES[k](spark, SF).collect())) for k in keys}
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert {k: sorted(map(str, QUERIES[k](spark, SF).collect())) for k in keys} == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_two_actions_around_a_skipped_hour_are_two_moments(spark):
    from buyhorizon.functions import columns as C
    from buyhorizon.functions import sqlexpr as X
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2001, 4, 1, 2, 30),), (dt.datetime(2001, 4, 1, 3, 30),)], "a_date timestamp_ntz")
        assert df.select(F.expr(X.micros("a_date"))).distinct().count() == 2
        assert df.select(C.micros(F.col("a_date"))).exceptAll(df.select(F.expr(X.micros("a_date")))).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_submission_keeps_positions_and_scores_like_the_list(spark, tmp_path):
    pred = spark.createDataFrame([(i, float(i % 3), 4.0 + i) for i in range(20)], "user_id long, label_30_101_BuyNums double, label_30_101_IntervalDay double")
    ranked = SC.ranked_predictions(pred, SPEC, SPEC.test_anchor)
    IO.sink_submission(ranked, str(tmp_path / "s"), 7)
    back = IO.scan_prediction(spark, str(tmp_path / "s"))
    want = ranked.orderBy("position").limit(7).select("position", "user_id", "pred_date").collect()
    assert back.orderBy("position").collect() == want and [r.position for r in want] == list(range(1, 8))
    truth = spark.createDataFrame([(2, dt.datetime(2001, 7, 6)), (99, dt.datetime(2001, 7, 2))], "user_id long, o_date timestamp_ntz")
    top = SC.topk_users(pred, SPEC, SPEC.test_anchor, 7)
    assert SC.score_submission(back, truth).first() == SC.score(top, truth, SPEC).first()


def test_score_without_true_buyers_is_null_not_an_error(spark):
    top = spark.createDataFrame([(1, 3.0, dt.date(2001, 7, 5))], "user_id long, label_30_101_BuyNums double, pred_date date")
    r = SC.score(top, spark.createDataFrame([], "user_id long, o_date timestamp_ntz"), SPEC).first()
    assert r.s1 == 0 and r.s2 is None and r.s is None


def test_exact_median(spark):
    rows = [(k, v) for k in range(6) for v in [(7 * i * (k + 1)) % 11 for i in range(k * 3 + 1)]] + [(99, None), (0, None)]
    got = {r.k: r.m for r in exact_median(spark.createDataFrame(rows, "k int, v int"), "k", "v", "m").collect()}
    assert got == {k: statistics.median(v for a, v in rows if a == k and v is not None) for k in range(6)}


def test_codes_are_fitted_and_unknown_ones_show(spark):
    schema = "user_id long, sex int, user_lv_cd int, age int"
    train = spark.createDataFrame([(1, 0, 3, None), (2, 2, 9, 4)], schema)
    vocab = onehot_vocab(train)
    assert vocab == {"sex": [0, 2], "user_lv_cd": [3, 9], "age": [4]}
    test = spark.createDataFrame([(3, 1, 9, 4), (4, 1, None, 5)], schema)
    assert onehot_users(test, vocab).columns == ["user_id", "sex_0", "sex_2", "user_lv_cd_3", "user_lv_cd_9", "age_4"]
    assert {tuple(r) for r in unknown_codes(test, vocab).collect()} == {("sex", 1, 2), ("age", 5, 1)}


def test_fractions_of_a_second_survive_csv(spark, tmp_path):
    row = (1, 2, dt.datetime(2001, 5, 1, 3, 4, 5, 678901), 1, 1)
    IO.write_csv(spark.createDataFrame([row], IO.schemas.ACTION), str(tmp_path / "a"))
    assert IO.scan_dated(spark, str(tmp_path / "a"), "action").first().a_date == row[2]


def test_intermediates_are_removed_at_the_end_of_a_job(spark):
    import os
    df = S.stored(spark.range(3), "to-drop")
    made = df.inputFiles()[0].removeprefix("file://")
    kept, S._MADE[:] = S._MADE[:-1], S._MADE[-1:]
    try:
        assert os.path.exists(made)
        S.drop_scratch(spark)
        assert not os.path.exists(made) and not S._MADE
    finally:
        S._MADE[:] = kept
