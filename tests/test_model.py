"""The model layer on small tables: one out-of-fold prediction per row, repeatability, early stopping, tuning."""

import random

import pytest
from pyspark.sql import functions as F

from buyhorizon import session as S
from buyhorizon.plans import model as ML

PARAMS = ML.BoostParams(max_depth=2, num_boost_round=30, min_data_in_leaf=5, learning_rate=0.3)


@pytest.fixture(autouse=True)
def store(tmp_path, monkeypatch):
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "store"))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    data = []
    for i in range(240):
        x = [rng.random() for _ in range(3)]
        data.append((i % 2, i, int(3 * x[0] + rng.random() * 0.3), *x))
    df = S.stored(spark.createDataFrame(data, "slip int, user_id long, y int, a double, b double, c double"), "model-table")
    bins = ML.Bins(["a", "b", "c"]).fit(df, PARAMS.max_bin)
    return bins, S.stored(bins.binned(df, ["slip", "user_id", "y"]), "model-rows")


def test_out_of_fold_covers_every_row_once_and_is_repeatable(table, tmp_path, monkeypatch):
    bins, rows = table
    a = ML.StackedBaggedGBT("y", bins, PARAMS, stacking_num=3).out_of_fold(rows).select("slip", "user_id", "fold", "stack_pred").collect()
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "other"))
    b = ML.StackedBaggedGBT("y", bins, PARAMS, stacking_num=3).out_of_fold(rows).select("slip", "user_id", "fold", "stack_pred").collect()
    assert sorted(r.user_id for r in a) == list(range(240))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert {r.fold for r in a} == {0, 1, 2}


def test_out_of_fold_predictions_come_from_the_other_folds(table):
    bins, rows = table
    m = ML.StackedBaggedGBT("y", bins, PARAMS, stacking_num=3)
    got = m.out_of_fold(rows)
    for f, model in enumerate(m.stack_models):
        own = ML.scored(got.where(F.col("fold") == f).drop("stack_pred"), [model], "again").select("user_id", "again")
        assert got.join(own, "user_id").where("abs(stack_pred - again) > 1e-12").count() == 0
        assert model.name == f"fold-{f}" and model.base == pytest.approx(got.where(F.col("fold") != f).agg(F.avg("y")).first()[0])


def test_stack_and_bags_learn_stop_early_and_average(table):
    bins, rows = table
    m = ML.StackedBaggedGBT("y", bins, PARAMS, stacking_num=2, bagging_num=2, metric="l2").fit(rows)
    spread = rows.agg(F.var_pop("y")).first()[0]
    assert len(m.scores) == 2 and all(s < 0.5 * spread for s in m.scores)
    noise = rows.withColumn("y", F.pmod(F.xxhash64("user_id"), F.lit(2)))
    short = ML.replace(PARAMS, early_stopping_rounds=5)
    stopped = ML.StackedBaggedGBT("y", bins, short, stacking_num=2, bagging_num=1).fit(noise)
    assert max(len(x.trees) for x in stopped.stack_models + stopped.bag_models) < PARAMS.num_boost_round  # noise: held-out error stops it
    out = m.predict(rows.drop("y"), "p").select("user_id", "p").collect()
    assert len(out) == 240
    each = m.each_bag(rows.drop("y")).select("user_id", ((F.col("bag_0") + F.col("bag_1")) / 2).alias("p")).collect()
    assert {r.user_id: pytest.approx(r.p) for r in each} == {r.user_id: r.p for r in out}
    imp = m.importances().collect()
    assert {(r.fold, r.feature) for r in imp} == {(f, c) for f in (0, 1) for c in "abc"}
    assert all(max((r for r in imp if r.fold == f), key=lambda r: r.gain).feature == "a" for f in (0, 1))
    splits = [sum(f >= 0 for t in x.trees for f in t.feature) for x in m.stack_models]
    assert [sum(r.importance for r in imp if r.fold == f) for f in (0, 1)] == splits


def test_binary_variant_gives_probabilities(table):
    bins, rows = table
    m = ML.StackedBaggedGBT("y", bins, PARAMS, stacking_num=2, bagging_num=1, binary=True).fit(rows)
    out = m.predict(rows, "p").select("y", "p").collect()
    assert all(0 <= r.p <= 1 for r in out)
    assert m.scores[0] > 0.9


def test_grid_merges_points_of_one_fit(table):
    bins, rows = table
    p = [ML.distinct_point(ML.BoostParams(num_leaves=n, max_depth=d)).num_leaves for n, d in ((20, 3), (20, 7), (190, 7), (64, -1))]
    assert p == [8, 20, 128, 64]
    assert ML.distinct_point(ML.BoostParams(bagging_fraction=0.6, bagging_freq=0)) == ML.distinct_point(ML.BoostParams(bagging_fraction=1.0, bagging_freq=5))
    points = [{"max_depth": d} for d in (1, 2, 1)]
    got = ML.grid_search_cv(rows, bins, F.col("y"), PARAMS, points, folds=2)
    assert [p for p, _ in got] == points and got[0] == got[2] and got[1][1] != got[0][1]


def test_meta_edges_cut_where_the_rows_are(spark):
    df = spark.createDataFrame([(0.0,)] * 500 + [(i / 100,) for i in range(500)], "p double")
    edges = ML.meta_edges(df, "p", 32)
    assert 20 <= len(edges) <= 30 and edges == sorted(set(edges)) and edges[0] < 0.01
    assert ML.meta_edges(df.where("p = 0"), "p", 32) == [] and ML.meta_edges(df.where("false"), "p", 32) == []


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 2), (0.1, 0)], "prediction double, y int")
    assert ML.metric_auc(df, "y") == pytest.approx(3 / 4)
    assert ML.metric_l2(df, "y") == pytest.approx((0.01 + 0.64 + 1.69 + 0.01) / 4)


def test_rounds_go_on_through_a_rise_until_patience_ends():
    errors = [5.0, 4.0, 4.1, 3.0, 3.2, 3.1, 3.05, 2.0]
    assert ML.best_round(errors, 1) == (2, True)
    assert ML.best_round(errors, 3) == (4, True)
    assert ML.best_round(errors, 4) == (8, False)


def test_later_grids_have_the_reference_values():
    from buyhorizon import registry as R
    points = R._more_points()
    leaves = {(p["num_leaves"], p["max_depth"]) for t, name, p in points if t == "first_day" and name.startswith("num_leaves")}
    assert leaves == {(n, d) for n in range(20, 100, 5) for d in (3, 4, 5, 6, 7)}
    shares = (0.6, 0.7, 0.8, 0.9, 1.0)
    for target in ("count", "first_day"):
        drawn = {(p["bagging_fraction"], p["feature_fraction"], p["bagging_freq"]) for t, _, p in points if t == target and "bagging_fraction" in p}
        assert drawn == {(a, b, k) for a in shares for b in shares for k in (0, 5, 10, 15)}


def test_auc_of_many_distinct_scores_is_the_rank_sum(spark):
    rng = random.Random(8)
    data = [(rng.random() ** 3, int(rng.random() < 0.3)) for _ in range(5000)]
    data = [(p + 0.1 * y, y) for p, y in data]
    ranks = {p: i + 1 for i, p in enumerate(sorted(p for p, _ in data))}
    n = sum(y for _, y in data)
    auc = (sum(ranks[p] for p, y in data if y) - n * (n + 1) / 2) / (n * (len(data) - n))
    assert ML.metric_auc(spark.createDataFrame(data, "prediction double, y int"), "y") == pytest.approx(auc, abs=1e-9)
