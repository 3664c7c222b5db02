"""Toxic passages: segments against brute force, the law against simulation, scores against a recomputation, held-out accuracy."""

import math
import random

import numpy as np

from buyhorizon.llm import toxicity as T

BAD = "idiot clown moron scum".split()


def all_maximal(scores):
    """Maximal segments by their definition: the best one (least long, then first), then left and right of it."""
    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            for j in range(i + 1, hi + 1):
                s = sum(scores[i:j])
                if s > 1e-12 and (found is None or s > found[0] + 1e-12 or abs(s - found[0]) <= 1e-12 and j - i < found[2] - found[1]):
                    found = (s, i, j)
        return [] if found is None else best(lo, found[1]) + [found] + best(found[2], hi)
    return best(0, len(scores))


def test_segments_equal_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.choice([-3, -1, -1, 0.5, 2, 4]) + rng.random() / 1000 for _ in range(rng.randint(0, 14))]
        got = T.maximal_segments([(s, i, i + 1) for i, s in enumerate(scores)])
        want = all_maximal(scores)
        assert [(i, j) for _, i, j in got] == [(i, j) for _, i, j in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_runs_of_common_words_count_as_one():
    model = T.Model({"bad": 2.0, "good": -1.0}, other=-0.3)
    words = "x bad y y bad good bad y y y y y y y y bad x x".split()
    flat = T.maximal_segments([(model.odds.get(w, model.other), i, i + 1) for i, w in enumerate(words)])
    assert np.allclose(model.segments(words), flat)


def test_scan_is_linear():
    model = T.Model({"bad": 2.0}, other=-0.3)
    assert len(model.segments(["bad", *["x"] * 9] * 100_000)) == 100_000


def test_rate_solves_its_equation_and_bounds_exceedances():
    scores, shares = np.array([3.0, -0.5]), np.array([0.02, 0.98])
    rate = T.solve_rate(scores, shares)
    assert abs((shares * np.exp(rate * scores)).sum() - 1) < 1e-9
    model, rng = T.Model({"b": 3.0}, -0.5, rate), np.random.default_rng(1)
    best = np.array([max((s for s, _, _ in model.segments(["b" if x else "o" for x in rng.random(400) < 0.02])), default=0.0) for _ in range(2000)])
    # at equal steps of the score the exceedances fall by about exp(-rate x step)
    a, b = (best >= 5.5).mean(), (best >= 8.5).mean()
    assert 0.4 * math.exp(-rate * 3) < b / a < 2.5 * math.exp(-rate * 3)


def corpus(n=400):
    rng, rows = random.Random(3), []
    plain = ["w%d" % i for i in range(300)]
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 120))
        if toxic := i % 8 == 0:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() + rng.choice([",", ""]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learns_and_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows], "id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 250] + [(6, None), (None, 1), (8, 1), (8, 1)], "id long, label int")
    model = T.fit(docs.where("id < 250"), labels)
    assert {w for w, s in model.odds.items() if s > 0} == set(BAD) and model.other < 0 and model.rate > 0
    long = " ".join(["w1"] * 200_000 + ["idiot", "w2", "moron", "scum"])
    extra = spark.createDataFrame([(900, None, "", 0.0), (901, "", "", 0.0), (902, long, "", 0.0), (902, long, "", 0.0), (903, "?!", "", 0.0)], docs.schema)
    got = T.passages(docs.unionByName(extra).select("id", "text"), model, ["id"]).collect()
    assert len(got) == 405
    by = {r.id: r for r in got}
    assert all((by[i].score >= 0.5) == y for i, _, y in rows)
    assert by[900].score == by[901].score == by[903].score and abs(by[900].score - model.prior) < 1e-12 and not by[900].passages
    (found,) = by[902].passages
    assert found.passage == "idiot w2 moron scum" == long[found.start:found.end] and by[902].score > 0.5
    for i, text, _ in rows[:80]:  # the same by the formulas
        words, spans = T.words_of(text)
        scores = [model.odds.get(w, model.other) for w in words]
        segments = all_maximal(scores) if len(words) < 60 else T.maximal_segments([(s, k, k + 1) for k, s in enumerate(scores)])
        e = [model.size * len(words) * math.exp(-model.rate * s) for s, _, _ in segments]
        assert [p.passage for p in by[i].passages] == [text[spans[a][0]:spans[b - 1][1]] for (_, a, b), x in zip(segments, e, strict=True) if x <= 0.01]
        gain = sum(-math.log(x) for x in e if x < 1) or model.none
        assert abs(by[i].score - 1 / (1 + math.exp(-(math.log(model.prior / (1 - model.prior)) + gain)))) < 1e-9


def test_copies_prove_nothing_twice(spark):
    """A clean word of a toxic text that is copied many times does not become toxic."""
    rows = corpus(240)
    rows += [(1000 + i, "w1 w2 idiot harmless w3 moron w4", 1) for i in range(200)]
    model = T.fit(spark.createDataFrame([r[:2] for r in rows], "id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "id long, label int"))
    assert "harmless" not in model.odds and model.odds["idiot"] > 0


def test_log_odds_by_hand():
    counts = {"a": (500, 50), "b": (400, 40), "bad": (0, 10), "": (0, 0)}
    odds, other = T.log_odds(counts, 1.0, 0.5, 50.0)
    a = 50 * 10 / 1000
    assert abs(odds["bad"] - (math.log((10 + a) / (100 + 50 - 10 - a)) - math.log(a / (900 + 50 - a)))) < 1e-12
    assert list(odds) == ["bad"] and abs(other - (math.log(91 / 101) - math.log(901 / 901))) < 1e-12


def test_one_class_none_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string")
    for labels, want in ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([], 0.5), ([(1, 0), (2, 1)], 0.5):
        model = T.fit(docs, spark.createDataFrame(labels, "id long, label int"))
        assert [round(r.score, 9) for r in T.passages(docs, model, ["id"]).collect()] == [want, want]
    empty = spark.createDataFrame([], docs.schema)
    assert T.passages(empty, model, ["id"]).count() == 0 and T.fit(empty, spark.createDataFrame([], "id long, label int")).prior == 0.5


def test_a_score_beyond_any_double(spark):
    model = T.Model({"bad": 5.0}, other=-0.01, rate=2.0, size=1e-6, prior=0.1)
    (r,) = T.passages(spark.createDataFrame([(1, "bad " * 5000)], "id long, text string"), model, ["id"]).collect()
    assert r.score == 1.0 and len(r.passages) == 1 and 0 <= r.passages[0].expected < 1e-300
