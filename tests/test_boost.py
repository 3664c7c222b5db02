"""Boosted-tree fits: against brute force, over one and many blocks, resumed, stored, and stopped."""

import random
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from buyhorizon import session as S
from buyhorizon.operators import trees as T
from buyhorizon.operators.trees import BoostParams
from buyhorizon.plans import boost as B

PLAIN = BoostParams(num_boost_round=12, early_stopping_rounds=50, min_data_in_leaf=3, num_leaves=6, max_depth=3)


@pytest.fixture(autouse=True)
def store(tmp_path, monkeypatch):
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "store"))
    return tmp_path / "store"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x = [rng.choice([0, 0, 0, 1, 2, 5]), rng.gauss(0, 1), None if rng.random() < 0.3 else rng.randrange(40), 7.0, None]
        rows.append((i % 2, i, float(x[0] + (x[2] or 0) / 10 + rng.gauss(0, 0.5)), *[None if v is None else float(v) for v in x]))
    return S.stored(spark.createDataFrame(rows, "slip int, user_id long, y double, a double, b double, c double, d double, e double"), "boost-table")


@pytest.fixture(scope="module")
def binned(table):
    bins = B.Bins(list("abcde")).fit(table, 16)
    return bins, S.stored(bins.binned(table, ["slip", "user_id", "y"]), "boost-rows")


def fold(k=4, f=0):
    return F.when(F.col("user_id") % k == f, 2).otherwise(1)


def fits(p=PLAIN, names=("one",), k=4):
    return [[B.Fit(n, p, F.col("y"), fold(k, i % k))] for i, n in enumerate(names)]


def same(a: B.Model, b: B.Model) -> bool:
    return a.base == b.base and a.losses == b.losses and [t.__dict__ for t in a.trees] == [t.__dict__ for t in b.trees]


def test_edges():
    assert B.edges_of(np.array([1.0, 2.0, 5.0]), np.array([1, 1, 1]), 5) == [1.0, 2.0]
    heavy = B.edges_of(np.arange(100.0), np.array([900] + [1] * 99), 8)
    assert heavy[0] == 0.0 and len(heavy) == 7 and all(a < b for a, b in zip(heavy, heavy[1:], strict=False))


def test_bins_hold_what_edges_say(table, binned):
    bins, rows = binned
    assert bins.edges[3] == [] and bins.edges[4] == []  # one value, and none
    got = {r.user_id: list(r.bins) for r in rows.collect()}
    for r in table.collect():
        want = [0 if r[c] is None else 1 + sum(r[c] > e for e in bins.edges[i]) for i, c in enumerate("abcde")]
        assert got[r.user_id] == want


def brute_tree(bins, g, p, sizes):
    """The same tree by trying every split of every leaf, level by level."""
    def value(rows):
        return -g[rows].sum() / (len(rows) + p.lambda_l2) * p.learning_rate

    def gain(rows):
        best = (1e-10, None, None)
        score = lambda r: g[r].sum() ** 2 / (len(r) + p.lambda_l2)
        for f in range(bins.shape[1]):
            for b in range(sizes[f] - 1):
                left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                if min(len(left), len(right)) >= max(p.min_data_in_leaf, p.min_child_weight):
                    x = score(left) + score(right) - score(rows)
                    if x > best[0] + 1e-9:
                        best = (x, f, b)
        return best

    leaves, out, level = 1, {}, [(0, np.arange(len(g)))]
    nodes, splits = [None], {}
    out[0] = value(level[0][1])
    for _ in range(p.max_depth):
        found = [(gain(rows), n, rows) for n, rows in level if len(rows) >= 2 * p.min_data_in_leaf]
        found = sorted([x for x in found if x[0][1] is not None], key=lambda x: -x[0][0])[:p.num_leaves - leaves]
        level = []
        for (_, f, b), n, rows in sorted(found, key=lambda x: x[1]):
            a = len(nodes)
            nodes += [None, None]
            splits[n] = (f, b, a, a + 1)
            for child, own in ((a, rows[bins[rows, f] <= b]), (a + 1, rows[bins[rows, f] > b])):
                out[child] = value(own)
                level.append((child, own))
        leaves += len(found)
    return splits, out


def test_a_tree_equals_brute_force():
    rng = np.random.default_rng(3)
    for trial in range(15):
        sizes = np.array([5, 2, 9, 2, 3])
        bins = np.stack([rng.integers(0, s, 120) * (rng.random(120) < 0.6) for s in sizes], axis=1).astype(np.uint8)
        y = rng.standard_normal(120) + bins[:, 2]
        p = BoostParams(feature_fraction=1.0, bagging_freq=0, min_data_in_leaf=4, num_leaves=7, max_depth=4, lambda_l2=float(trial % 3))
        scale = T.scale_of(p, 120, 20.0)
        block = T.Block(bins, np.arange(120), y, np.zeros(120, bool), T.Cells(sizes))
        margin = np.full(120, y.mean())
        g = np.rint((margin - y) * scale) / scale
        (made,) = T.rounds_of_one_block(block, p, margin, scale, 0, 1)
        splits, values = brute_tree(bins.astype(int), g, p, sizes)
        tree = made.tree
        assert {n: (tree.feature[n], tree.bin[n], tree.left[n], tree.right[n]) for n in range(len(tree.feature)) if tree.feature[n] >= 0} == splits
        assert np.allclose([tree.value[n] for n in sorted(values)], [values[n] for n in sorted(values)], atol=1e-9)
        assert np.allclose(margin, y.mean() + tree.predicted(bins))


def test_bundles_hold_every_bin_and_sums_are_those_of_the_rows(monkeypatch):
    rng = np.random.default_rng(8)
    sizes, n = np.array([5, 2, 9, 33, 3, 12, 2, 40]), 6000
    kind = rng.integers(0, 40, n)
    bins = np.stack([np.where(rng.random(n) < 0.2, rng.integers(0, s, n), kind % s) * (kind % 3 > 0) for s in sizes], axis=1).astype(np.uint8)
    cells, weights = T.Cells(sizes), [rng.integers(-1000, 1000, n).astype(float), rng.integers(0, 9, n).astype(float)]
    nodes = [np.sort(rng.choice(n, k, replace=False)) for k in (5000, 400, 25, 1)]
    monkeypatch.setattr(T, "PART_PATTERNS", 40)
    made = list(T.bundles(bins.T, sizes))
    assert [b.first for b in made] == list(np.cumsum([0, *[b.patterns.shape[1] for b in made]])[:-1]) and 1 < len(made) < len(sizes)
    assert (np.concatenate([b.patterns[b.codes] for b in made], axis=1) == bins).all()
    want = np.array([[np.concatenate([np.bincount(bins[r, f], None if w is None else w[r], s) for f, s in enumerate(sizes)]) for r in nodes] for w in (*weights, None)])
    for kept, entries, stripe in ((1 << 27, 1 << 19, 1 << 16), (0, 1 << 19, 1 << 16), (1 << 27, 60, 900), (0, 60, 900)):
        for name, value in (("KEPT_CELLS", kept), ("ENTRIES", entries), ("STRIPE", stripe)):
            monkeypatch.setattr(T, name, value)
        block = T.Block(bins, np.arange(n), np.zeros(n), np.zeros(n, bool), cells)
        for many, all_ in ((0, 0), (0, 1 << 60), (300, 0), (1 << 60, 0)):  # by parts, by patterns, both with rows, by rows
            block.many, block.all = many, all_
            assert (block.sums(nodes, weights) == want).all()
            assert (block.sums(nodes[:1], weights, want[-1, 0]) == want[:, :1]).all()
        assert all((block.goes_left(nodes[1], f, 1) == (bins[nodes[1], f] <= 1)).all() for f in range(len(sizes)))


def test_binary_gradients_are_slopes_of_the_loss():
    p = BoostParams(binary=True)
    y, margin, step = np.array([0.0, 1.0, 3.0, 0.0]), np.array([0.3, -1.2, 2.0, -4.0]), 1e-4
    g, h = T.gradients(p, y, margin, 2.0 ** 40)
    up, down = (T.losses(p, y, margin + d).astype(float) for d in (0.05, -0.05))
    assert np.allclose(g / 2 ** 40, (up - down) / 2 ** 20 / 0.1, rtol=1e-2, atol=1e-4)
    assert (h > 0).all() and step


def test_many_blocks_give_the_same_models(binned, monkeypatch, tmp_path):
    bins, rows = binned
    p = replace(PLAIN, num_boost_round=4)
    one = B.fit_groups(rows, bins, fits(p, ("x", "y")))
    monkeypatch.setattr(T, "BLOCK_ROWS", 90)
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "other"))
    many = B.fit_groups(rows, bins, fits(p, ("x", "y")))
    assert many.spark.read.parquet(*[f"{many.chunks[0]}"]).count() == 2
    assert all(same(one.models[n], many.models[n]) for n in ("x", "y"))
    monkeypatch.setattr(B, "CHUNK", 3)  # spread-out fits go on, too
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "third"))
    assert same(B.fit_groups(rows, bins, fits(p, ("x",))).models["x"], one.models["x"])


@pytest.mark.parametrize("binary", [False, True])
def test_fits_over_many_blocks_are_few_jobs_and_the_same(spark, binned, monkeypatch, tmp_path, binary):
    bins, rows = binned
    p = replace(PLAIN, num_boost_round=7, bagging_freq=2, max_depth=-1, binary=binary)
    groups = [*fits(p, ("x", "y")), [f[0] for f in fits(p, ("u", "v"))]]
    one = B.fit_groups(rows, bins, groups)
    monkeypatch.setattr(T, "BLOCK_ROWS", 90)
    monkeypatch.setattr(T, "ENTRIES", 50)  # sums in several parts
    monkeypatch.setattr(B, "CHUNK", 4)
    for name, most in (("task", 400), ("barrier", 100)):  # all rows in a task, and some features a task
        monkeypatch.setattr(T, "TASK_ROWS", most)
        monkeypatch.setattr(S, "store_root", lambda spark, name=name: str(tmp_path / name))
        spark.sparkContext.setJobGroup(name, name)
        many = B.fit_groups(rows, bins, groups)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert many.made == 2 and all(same(one.models[n], many.models[n]) for n in "xyuv") and many.errors == one.errors
        assert jobs < 60  # not one a level: 7 rounds of 4 fits have about 28 x 4 levels


def test_a_continued_fit_is_one_long_fit(binned, monkeypatch, tmp_path):
    bins, rows = binned
    long = B.fit_groups(rows, bins, fits(names=("x", "y", "z")))
    assert long.made == 1
    monkeypatch.setattr(B, "CHUNK", 5)
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "other"))
    short = B.fit_groups(rows, bins, fits(names=("x", "y", "z")))
    assert short.made == 3 and all(same(long.models[n], short.models[n]) for n in "xyz")


def test_a_lost_fit_is_taken_up_where_it_was(binned, monkeypatch, tmp_path):
    bins, rows = binned
    whole = B.fit_groups(rows, bins, fits())
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "other"))
    monkeypatch.setattr(B, "CHUNK", 4)
    calls, real = [], B._together

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(B, "_together", failing)
    with pytest.raises(RuntimeError, match="lost"):
        B.fit_groups(rows, bins, fits())
    later = B.fit_groups(rows, bins, fits())
    assert later.made == 1 and same(later.models["one"], whole.models["one"])  # two chunks were stored: no tree twice


def test_finished_fits_are_read_again_unless_data_or_parameters_differ(binned):
    bins, rows = binned
    assert B.fit_groups(rows, bins, fits()).made == 1
    assert B.fit_groups(rows, bins, fits()).made == 0
    assert B.fit_groups(rows, bins, fits(replace(PLAIN, lambda_l2=3.0))).made == 1
    assert B.fit_groups(rows.withColumn("y", F.when(F.col("user_id") == 7, 0.0).otherwise(F.col("y"))), bins, fits()).made == 1
    assert B.fit_groups(rows.where("user_id <> 7"), bins, fits()).made == 1
    assert B.fit_groups(rows, bins, fits(k=5)).made == 1


def test_patience_ends_a_fit_and_the_least_error_stays(binned):
    bins, rows = binned
    p = replace(PLAIN, num_boost_round=400, early_stopping_rounds=6, learning_rate=0.4)
    made = B.fit_groups(rows, bins, fits(p))
    model = made.models["one"]
    stored = [r for c in made.chunks for r in made.spark.read.parquet(c).first().rounds]
    losses = [r.loss for r in stored]
    least = min(range(len(losses)), key=lambda i: losses[i])
    assert len(model.trees) == least + 1 and len(losses) == least + 1 + 6 < 400
    held = rows.where("user_id % 4 = 0")
    error = B.scored(held, [model], "p").agg(F.avg((F.col("p") - F.col("y")) ** 2)).first()[0]
    assert error == pytest.approx(model.losses[-1], rel=1e-4)
    assert error < 0.6 * held.agg(F.var_pop("y")).first()[0]


def test_a_group_stops_on_its_mean(binned):
    bins, rows = binned
    p = replace(PLAIN, num_boost_round=60, early_stopping_rounds=5, learning_rate=0.4)
    made = B.fit_groups(rows, bins, [[B.Fit(f"g-{f}", p, F.col("y"), fold(3, f)) for f in range(3)]])
    errors = made.errors["g-0"]
    assert errors[-1] == min(errors) and {len(m.trees) for m in made.models.values()} == {len(errors)}
    assert errors[-1] == pytest.approx(sum(m.losses[-1] for m in made.models.values()) / 3)


def test_node_table_against_its_files(binned):
    bins, rows = binned
    made = B.fit_groups(rows, bins, fits(names=("fold-0", "fold-1")))
    got = {(r.fit, r.feature): r["count"] for r in made.nodes().where("feature >= 0").groupBy("fit", "feature").count().collect()}
    files = [f"{c.removeprefix('file:')}/*.parquet" for c in made.chunks]
    sql = """SELECT member, unnest(r.feature) AS feature FROM (SELECT member, unnest(rounds) AS r FROM read_parquet(?))
             WHERE r.round < CASE member WHEN 0 THEN ? ELSE ? END"""
    best = [len(made.models[f"fold-{i}"].trees) for i in (0, 1)]
    want = duckdb.execute(f"SELECT member, feature, count(*) FROM ({sql}) WHERE feature >= 0 GROUP BY ALL", [files, *best]).fetchall()
    assert got == {(f"fold-{m}", f): n for m, f, n in want} and got


def test_meta_bin_is_put_behind(binned):
    bins, rows = binned
    scored = rows.withColumn("m", F.when(F.col("user_id") == 3, None).otherwise(F.col("user_id") / 10.0))
    got = {r.user_id: (r.m, list(r.bins)) for r in B.with_bin(scored, "m", [5.0, 11.0, 20.0]).collect()}
    assert all(len(b) == 6 and b[-1] == (0 if m is None else 1 + sum(m > e for e in (5.0, 11.0, 20.0))) for m, b in got.values())


def test_no_rows(binned):
    bins, rows = binned
    with pytest.raises(ValueError, match="no rows"):
        B.fit_groups(rows.where("false"), bins, fits())
    assert B.scored(rows.where("false"), [B.Model("m", PLAIN, 1.0, [], [])], "p").count() == 0


def test_a_second_start_has_progress_of_its_own(binned, monkeypatch):
    """Two processes that begin the same fits at once write a start each; margins follow the blocks they were made on."""
    bins, rows = binned
    monkeypatch.setattr(B, "CHUNK", 4)
    calls, real = [], B._together

    def failing(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(B, "_together", failing)
    with pytest.raises(RuntimeError, match="lost"):
        B.fit_groups(rows, bins, fits())
    seen = B.finished
    blind = [True, True]  # the other process does not see the first start
    monkeypatch.setattr(B, "finished", lambda spark, path, prefix: [] if prefix == "start-" and blind and blind.pop() and len(blind) == 1 else seen(spark, path, prefix))
    other = B.fit_groups(rows.orderBy(F.desc("user_id")), bins, fits())
    assert other.made >= 2
    monkeypatch.setattr(B, "_together", real)
    monkeypatch.setattr(B, "CHUNK", 100)
    assert same(B.fit_groups(rows, bins, fits(replace(PLAIN, seed=PLAIN.seed))).models["one"], other.models["one"])
