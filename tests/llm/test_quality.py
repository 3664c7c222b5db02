"""Compression classifier: held-out accuracy, defined results of awkward rows."""

import math
import random

import numpy as np
import zstandard

from buyhorizon.llm import quality as Q


def corpus(n=300):
    rng = random.Random(6)
    good, bad = "the of and water house light over river".split(), "CLICK!! BUY!! $$$ free### win%%% now***".split()
    return [(i, " ".join(rng.choices(good if i % 3 else bad, k=rng.randint(20, 80))), int(i % 3 > 0)) for i in range(n)]


def test_learns_and_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "id long, text string, difference string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 200] + [(5, None), (None, 1), (7, 1)], "id long, label int")
    model = Q.fit(docs.where("id < 200"), labels)
    extra = spark.createDataFrame([(900, None, ""), (901, "", ""), (902, rows[1][1] * 500, ""), (902, rows[1][1] * 500, "")], docs.schema)
    got = [(r.id, r.score) for r in Q.scores(docs.unionByName(extra).select("id", "text"), model, ["id"]).collect()]
    assert len(got) == 304 and all(0 <= s <= 1 for _, s in got)
    by = dict(got)
    assert sum((by[i] >= 0.5) == y for i, _, y in rows if i >= 200) >= 97
    assert by[900] == by[901] and by[902] > 0.5


def test_one_class_and_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string")
    for labels, want in ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([], 0.5):
        model = Q.fit(docs, spark.createDataFrame(labels, "id long, label int"))
        assert [round(r.score, 9) for r in Q.scores(docs, model, ["id"]).collect()] == [want, want]
    empty = spark.createDataFrame([], docs.schema)
    assert Q.scores(empty, model, ["id"]).count() == 0


def test_logistic_recovers_a_curve():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 2)) * [0.1, 3]
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(8 * x[:, 0] - 0.5 * x[:, 1] + 1)))).astype(float)
    a, b, base = Q.logistic(x, y, np.ones(20_000), ridge=1e-9)
    assert abs(a - 8) < 0.6 and abs(b + 0.5) < 0.05 and abs(base - 1) < 0.1


def test_scores_equal_a_recomputation(spark):
    """Difference, shortness and score from the dictionaries and the curve, with the library's own calls."""
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, text string")
    model = Q.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "id long, label int"))
    extra = spark.createDataFrame([(900, None), (901, ""), (902, "über ünder " * 300)], docs.schema)
    got = {r.id: r.score for r in Q.scores(docs.unionByName(extra), model, ["id"]).collect()}
    a, b, base = model.curve
    sizes = {}
    for name, data in (("good", model.good), ("bad", model.bad)):
        whole = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes[name] = lambda part, c=whole: len(c.compress(part))
    for i, text in [(i, t) for i, t, _ in rows[:60]] + [(900, None), (901, ""), (902, "über ünder " * 300)]:
        data = (text or "").encode()
        parts = [data[k:k + model.piece] for k in range(0, len(data), model.piece)]
        difference = (sum(map(sizes["bad"], parts)) - sum(map(sizes["good"], parts))) / max(1, len(data))
        z = a * difference + b * 64 / (64 + len(text or "")) + base
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-9
