"""Phrase collocations: brute force on small tables, over one and many tasks of a stream."""

import random
import re
from collections import Counter

import pytest

from buyhorizon.llm import phrases as P

SCHEMA = "lang string, text string, f long, words string"


def brute_force(rows, least, longest, most):
    counts = {}
    for lang, text, *_ in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            for k in range(1, longest + 1):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        many = {p: c for p, c in own.items() if c >= least and len(p) > 1}
        found = []
        for p, a in many.items():
            if any(len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in many.items()):
                continue
            score, k = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:most])]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = ["The", "of", "new", "york", "Ünder", "a\x01", "a", "a b", "é.", "city\tof", "x", " "]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", "\n"]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    rows += [("en", "one two three four five six. " * 30), ("en", "One two three four five six" * 3), ("en", None), (None, ""), ("fr", " \t,;")]
    rows += [("hot", "new york city new york city")] * 40
    return [(lang, text, 7, "clash") for lang, text in rows]


@pytest.mark.parametrize("per_task", [50_000, 40, 7])
def test_equals_brute_force(spark, monkeypatch, per_task):
    monkeypatch.setattr(P, "PER_TASK", per_task)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in P.top(P.collocations(P.frequent_phrases(docs, 12, 5)), 60).collect())
    assert got == brute_force(rows, 12, 5, 60)
    assert any(r[2] == "one two three four five" for r in got) and not any(r[2] == "three four" for r in got)


def test_counts_in_parts_and_shorter_phrases(spark, monkeypatch):
    monkeypatch.setattr(P, "AT_ONCE", 50)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in P.top(P.collocations(P.frequent_phrases(docs, 12, 5)), 60).collect()) == brute_force(rows, 12, 5, 60)
    assert sorted(tuple(r) for r in P.top(P.collocations(P.frequent_phrases(docs, 12, 2)), 60).collect()) == brute_force(rows, 12, 2, 60)


def test_chance_bits_do_not_matter(spark, monkeypatch):
    """With a bitmap so small that most bits are set, infrequent phrases are counted and fall away."""
    monkeypatch.setattr(P, "BITS", 64)
    rows = corpus()
    assert sorted(tuple(r) for r in P.top(P.collocations(P.frequent_phrases(spark.createDataFrame(rows, SCHEMA), 12, 5)), 60).collect()) == brute_force(rows, 12, 5, 60)


def test_empty_tables(spark):
    for rows in ([], [("en", None, 1, "")], [("en", "a b c", 1, "")]):
        docs = spark.createDataFrame(rows, SCHEMA)
        assert P.top(P.collocations(P.frequent_phrases(docs, 12, 5)), 60).count() == 0


def test_boundaries_inside_a_first_word(spark, monkeypatch):
    """Most phrases share a first word: the stream is cut inside it and the root counts still arrive."""
    monkeypatch.setattr(P, "PER_TASK", 5)
    stream = [("en", [], 1000)] + [("en", ["a"], 500)] + [("en", ["a", f"w{i:03d}"], 10 + i) for i in range(100)] + [("en", ["a", "w050", "z"], 3)]
    rows = P.stored(spark.createDataFrame(stream, "lang string, key array<string>, f long"), "stream")
    assert len(P.boundaries(rows, 20)) > 5
    got = {tuple(r.key): r.firsts for r in P.first_part_counts(rows, "firsts").collect()}
    assert len(got) == len(stream)
    assert got[()] == [] and got["a",] == [1000] and got["a", "w077"] == [1000, 500] and got["a", "w050", "z"] == [1000, 500, 60]
