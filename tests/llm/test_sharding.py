"""Karmarkar-Karp sharding: balance, whole groups, slots."""

import random
import time
import zlib
from itertools import product

from buyhorizon.llm import sharding as S


def spread(sizes, at, k):
    sums = [sum(s for s, a in zip(sizes, at) if a == i) for i in range(k)]
    return max(sums) - min(sums)


def test_differencing_is_near_the_best_split_and_beats_greedy():
    rng = random.Random(3)
    for k in (2, 3):
        for _ in range(20):
            sizes = [rng.randint(1, 100) for _ in range(8)]
            best = min(spread(sizes, at, k) for at in product(range(k), repeat=8))
            assert best <= spread(sizes, S.differencing(sizes, k), k) <= best + max(sizes) // 2
    sizes = [rng.randint(1, 10**6) for _ in range(4000)]
    greedy, sums = [], [0] * 8
    for s in sorted(sizes, reverse=True):
        i = sums.index(min(sums))
        greedy.append(i)
        sums[i] += s
    assert spread(sizes, S.differencing(sizes, 8), 8) <= max(sums) - min(sums)
    assert S.differencing([], 8) == []
    assert spread([8, 7, 6, 5, 4], S.differencing([8, 7, 6, 5, 4], 2), 2) == 2  # the method's known result


def check(rows, got, shards):
    assert sorted((r.id or -1, r["size"], r.crc32) for r in got) == sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for k in range(shards):
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < shards for r in got)
    where = {}
    for r in got:
        where.setdefault((r.crc32, r["size"]), set()).add(r.shard)
    assert all(len(v) == 1 for v in where.values())


def test_groups_stay_whole_and_bytes_near_equal(spark):
    rng = random.Random(5)
    rows = [(i, "é" * rng.randint(0, 300) + str(i)) for i in range(400)] + [(1000 + i, "copy") for i in range(90)]
    rows += [(2000, None), (2001, ""), (2001, ""), (2002, "z" * 3000), (None, "no id"), (3, rows[3][1])]
    table = spark.createDataFrame(rows, "id long, text string")
    for grains in (1024, 4):  # all groups as items, and most of them in bundles
        got = S.shard_by_bytes(table, 8, grains).collect()
        check(rows, got, 8)
        sums = [sum(r["size"] for r in got if r.shard == k) for k in range(8)]
        assert max(sums) - min(sums) <= (50 if grains > 4 else 1500)
    assert sorted(map(str, S.shard_by_bytes(table, 8, 4).collect())) == sorted(map(str, got))


def test_a_group_above_an_even_share_stays_whole(spark):
    rows = [(i, "hot text " * 20) for i in range(200)] + [(1000 + i, f"doc {i}") for i in range(300)]
    got = S.shard_by_bytes(spark.createDataFrame(rows, "id long, text string"), 4).collect()
    check(rows, got, 4)
    sums = sorted(sum(r["size"] for r in got if r.shard == k) for k in range(4))
    assert sums[2] - sums[0] <= 8


def test_empty_and_written(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, text string")
    assert S.shard_by_bytes(empty).count() == 0
    docs = spark.createDataFrame([(i, f"t{i % 5}", "a") for i in range(20)], "doc_id long, text string, shard string")
    S.write_shards(docs, S.shard_by_bytes(docs.selectExpr("doc_id id", "text"), 2), "doc_id", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def dense_differencing(sizes, k):
    """The method as it is written down: partitions of all k parts, the two of largest spread combined oppositely ordered."""
    parts = [(size, i, [0] * (k - 1) + [size]) for i, size in enumerate(sizes)]
    n = len(sizes)
    while len(parts) > 1:
        parts.sort(key=lambda x: (-x[0], x[1]))
        (_, _, a), (_, _, b), *parts = parts
        both = sorted(x + y for x, y in zip(a, b[::-1]))
        parts.append((both[-1] - both[0], n, both))
        n += 1
    return parts[0][2]


def test_lists_of_non_empty_parts_give_the_same_sums():
    rng = random.Random(5)
    for _ in range(60):
        k, sizes = rng.randint(2, 9), [rng.randint(1, 50) for _ in range(rng.randint(1, 40))]
        at = S.differencing(sizes, k)
        assert sorted(sum(s for s, x in zip(sizes, at) if x == i) for i in range(k)) == dense_differencing(sizes, k)


def test_a_thousand_shards():
    rng = random.Random(6)
    sizes = [int(rng.paretovariate(3) * 1000) for _ in range(2 * 1000 * max(S.LEAST, S.GRAINS // 1000))]
    began = time.process_time()
    at = S.differencing(sizes, 1000)
    assert time.process_time() - began < 60
    assert spread(sizes, at, 1000) < 0.06 * sum(sizes) / 1000
