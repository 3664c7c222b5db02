"""SimHash fingerprints, links and components against brute force."""

import random
import re

import pytest
import xxhash

from buyhorizon.llm import simhash as S
from buyhorizon.llm.components import connected_components


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points, distance):
    """points: (id, fingerprint); smallest id reachable."""
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i][1] ^ points[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(points):
        r = find(i)
        least[r] = min((x for x in (least.get(r), k) if x is not None), default=None)
    return [least[find(i)] for i in range(len(points))]


def test_queries_result_on_awkward_texts(spark):
    rng = random.Random(1)
    words = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(300)]
    texts = [None, "", " \t\n", "One", "one two", "ONE\x0btwo  three", "one two three", "é É ß x y", "z" * 100_000, "a b " * 60_000]
    texts += [" ".join(words[i:i + 40]) for i in range(0, 200, 20)] + [" ".join(words[:200]), " ".join([*words[:199], "other"])] * 2
    rows = [(100 - i, t, "x", 1.0) for i, t in enumerate(texts)] + [(None, "one two three", "x", 1.0)]
    got = S.near_duplicates(spark.createDataFrame(rows, "id long, text string, fp string, n double").select("id", "text")).collect()
    prints = {r[0]: brute_fingerprint(r[1]) for r in rows}
    assert {r.id: r.fp & (2**64 - 1) for r in got} == prints
    want = brute_components([(r[0], prints[r[0]]) for r in rows], 2)
    assert sorted((r.id or 0, r.component) for r in got) == sorted((r[0] or 0, c) for r, c in zip(rows, want, strict=True))


@pytest.mark.parametrize(("distance", "blocks", "crowded"), [(2, 5, 64), (2, 4, 1), (2, 5, 3), (1, 3, 2), (3, 5, 2)])
def test_links_connect_what_all_pairs_connect(spark, distance, blocks, crowded):
    rng = random.Random(distance * 10 + crowded)
    points = {rng.getrandbits(64) for _ in range(30)}
    for p in list(points)[:6]:
        for _ in range(40):  # chains and crowds around a few centres
            p ^= 1 << rng.randrange(64)
            p ^= 1 << rng.randrange(64) if rng.random() < 0.6 else 0
            points.add(p)
    points = sorted(points)
    signed = [p - 2**64 if p >> 63 else p for p in points]
    links = S.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance, blocks, crowded)
    assert all((a & (2**64 - 1) ^ b & (2**64 - 1)).bit_count() <= distance for a, b in links.collect())
    parts = {r.node: r.root for r in connected_components(links).collect()}
    assert [parts.get(p, p) for p in signed] == brute_components(list(zip(signed, points, strict=True)), distance)


def test_chain_loops_and_empty(spark):
    chain = [(i, i + 1) for i in range(200)] + [(5, 5), (300, 301), (301, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {300: 300, 301: 300}
    assert S.near_duplicates(spark.createDataFrame([], "id long, text string")).count() == 0
