"""Mixing: targets, draws, permutations, and the whole job on awkward rows."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from buyhorizon.llm import mixing as M


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_share_everything_and_none_is_above_its_cap(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    t = M.targets(sizes, weights)
    assert abs(sum(t) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(x <= 3 * s + 1e-9 for x, s in zip(t, sizes))
    free = [x / w for x, s, w in zip(t, sizes, weights) if x < 3 * s - 1e-9]
    assert not free or max(free) - min(free) < 1e-6 * max(1, max(free))  # open sources keep the weights' proportions


@settings(max_examples=40)
@given(st.integers(1, 400), st.integers(0, 2**60))
def test_permutation(length, key):
    n = np.full(length, length)
    with np.errstate(over="ignore"):
        assert sorted(M.permuted(np.arange(length), n, np.full(length, key, np.uint64))) == list(range(length))


def test_draws_use_up_the_slots_evenly():
    slots = [1000, 0, 3, 77, 5000]
    got = M.draw(slots, 16, 1)
    assert got.sum(axis=0).tolist() == slots
    assert max(got.sum(axis=1)) - min(got.sum(axis=1)) <= 1
    assert (M.draw(slots, 16, 1) == got).all()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus():
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(1 + (i * 37) % 400)), f"s{i % 7}", "x") for i in range(120)]
    rows += [(500 + i, "same\ttext  here", "s1", None) for i in range(40)]
    return rows + [(900, None, "s1", ""), (901, "", None, ""), (902, "only null source " * 9, None, ""), (903, "w " * 30_000, "s2", ""), (1, rows[1][1], "s1", ""),
                   (None, "no id", "s3", "")]


def test_counts_and_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, file string")  # file clashes with the locator's name
    got = M.mixed_counts(docs, "doc_id", (5, 2, 1), block=16, shards=8).collect()
    assert sorted((r.id or -1, r["size"]) for r in got) == sorted((r[0] or -1, len(words(r[1]))) for r in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(len(words(r[1])) for r in rows if r[2] == s) for s in names]
    want = dict(zip(sizes, M.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])))
    assert {r.source_size: r.target for r in got} == want
    for size, target in want.items():
        taken = sum(r.taken for r in got if r.source_size == size)
        assert abs(taken - target) <= max(64, 0.02 * target)
    again = M.mixed_counts(docs, "doc_id", (5, 2, 1), block=16, shards=8).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))

    out = M.mixed_documents(docs.withColumn("n_chars", docs.doc_id), "doc_id", (5, 2, 1), block=16, shards=8)
    assert out.columns == ["doc_id", "text", "source", "file", "n_chars"]
    out = out.collect()
    assert sum(len(words(r.text)) for r in out) == sum(r.taken for r in got)
    assert all(r.n_chars == len(r.text) for r in out)
    by = {}
    for r in out:
        by[r.doc_id] = by.get(r.doc_id, 0) + len(words(r.text))
    counted = {}
    for r in got:
        counted[r.id] = counted.get(r.id, 0) + r.taken
    assert by == {k: v for k, v in counted.items() if v}


def test_pieces_of_a_text():
    part = lambda a, b, n: {"first": a, "to": b, "times": n}
    assert M.texts_of("a  b\tc d", [part(2, 4, 1), part(0, 2, 3)]) == ["a  b\tc d", "a  b", "a  b"]
    assert M.texts_of("a b c d e", [part(0, 1, 1), part(3, 5, 2)]) == ["a d e", "d e"]


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")
    assert M.mixed_counts(empty, "doc_id", (5, 2, 1)).count() == 0
    assert M.mixed_documents(empty, "doc_id", (5, 2, 1)).count() == 0


def test_every_output_shard_has_its_drawn_slots(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, file string")
    got = M.mixed_shards(docs, "doc_id", (5, 2, 1), block=16, shards=8).collect()
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(len(words(r[1])) for r in rows if r[2] == s) for s in names]
    slots = [max((r.slot for r in got if r.source == s), default=-1) + 1 for s in names]
    drawn = M.draw(slots, 8, 7)
    for k in range(8):
        assert [len({r.slot for r in got if r.shard == k and r.source == s}) for s in names] == drawn[k].tolist()
    for s, size in zip(names, sizes):
        filled = {}
        for r in (r for r in got if r.source == s):
            filled[r.slot] = filled.get(r.slot, 0) + r.to - r.first
        assert all(n == 16 or n == size % 16 for n in filled.values())  # each slot is one block
    texts = {i: words(t) for i, t, *_ in rows if i != 1}
    assert all(words(r.text) == texts[r.id][r.first:r.to] for r in got if r.id not in (1, None))
    by, counted = {}, {}
    for r in got:
        by[r.id] = by.get(r.id, 0) + len(words(r.text))
    for r in M.mixed_counts(docs, "doc_id", (5, 2, 1), block=16, shards=8).collect():
        counted[r.id] = counted.get(r.id, 0) + r.taken
    assert by == {k: v for k, v in counted.items() if v}
