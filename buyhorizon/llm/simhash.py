"""SimHash near-duplicate detection with pigeonhole blocks.

A fingerprint bit is 1 where more than half of the shingles' XXH64 values have
it. Fingerprints that differ in at most ``distance`` bits agree on all but
``distance`` of any ``blocks`` blocks, so they share the value of at least one
choice of ``blocks - distance`` blocks. Distinct fingerprints are joined on the
blocks of every choice, and each candidate's Hamming distance is verified.

Scale: equal fingerprints are one node before anything is joined, so a text with
a third of all rows is one row. A bucket (choice, value) with more than
``CROWDED`` distinct fingerprints is not paired: its fingerprints are listed with
every point that lies within half the distance, and those that share a point are
joined there. A point has a bounded number of neighbours (65 for two bits), so
the number of rows grows with the bucket, not with its square, and no link is
lost. Links feed the distributed components.

Defined results: null and empty texts have fingerprint zero, linked like any
other; repeated rows each get a result; null identifiers sort after all others
(the smallest identifier of a class is null only if all are); extra columns do
not matter.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored
from .components import connected_components

BITS = 64
#: Distinct fingerprints of a bucket that are compared pair by pair.
CROWDED = 64
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """The fingerprint of one whole text, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of ASCII: A-Z, and white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    last = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        h = np.array([hashed(line[a:b], seed) for a, b in zip(starts[i:i + BLOCK].tolist(), last[i:i + BLOCK].tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(rows: DataFrame, keep: list[str], shingle: int = 3, seed: int = 42) -> DataFrame:
    """``keep`` columns of ``rows`` with ``fp`` (long); the one other column is the text."""
    return map_rows(rows, keep, lambda texts: [[fingerprint(t, shingle, seed) for t in texts]], "fp long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _within(bits: list[int], radius: int) -> list[int]:
    """Masks that flip at most ``radius`` of ``bits``."""
    return [_signed(sum(1 << b for b in flip)) for r in range(radius + 1) for flip in combinations(bits, r)]


def links(nodes: DataFrame, distance: int = 2, blocks: int = 5, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``nodes.fp`` that connect all pairs within ``distance``.

    Every link is within the distance; within a crowded bucket the links are
    stars, which connect the same fingerprints as all pairs would.
    """
    if not 0 < distance < blocks:
        raise ValueError("0 < distance < blocks is needed")
    if distance % 2:
        crowded = 1 << 62  # an odd distance has no middle: pairs only
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    choices = list(combinations(range(blocks), blocks - distance))
    masks = [_signed(sum((1 << cuts[b + 1]) - (1 << cuts[b]) for b in c)) for c in choices]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks)])
    keyed = nodes.select("fp", F.explode(keys).alias("key")).select("fp", "key.choice", "key.value")
    sizes = stored(keyed.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes")
    shared = stored(keyed.join(sizes, ["choice", "value"]), "simhash-buckets")

    left = shared.where(F.col("n") <= crowded).select("choice", "value", F.col("fp").alias("a"))
    right = left.withColumnRenamed("a", "b")
    pairs = left.join(right, ["choice", "value"]).where((F.col("a") < F.col("b")) & _near("a", "b", distance)).select("a", "b")
    if distance % 2:
        return pairs.distinct()

    free = F.create_map(*[x for i, c in enumerate(choices) for x in (
        F.lit(i), F.array(*[F.lit(m) for m in _within([b for k in range(blocks) if k not in c for b in range(cuts[k], cuts[k + 1])], distance // 2)]))])
    points = shared.where(F.col("n") > crowded).select("choice", "fp", F.explode(free[F.col("choice")]).alias("flip"))
    points = points.select("choice", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")
    stars = (points.groupBy("choice", "point").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)  # at most one per flip
             .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where(F.col("a") < F.col("b")))
    return pairs.union(stars.where(_near("a", "b", distance))).distinct()


def near_duplicates(rows: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, blocks: int = 5, crowded: int = CROWDED) -> DataFrame:
    """One row per row of ``rows`` (id, text): id, fp, and component: the smallest id reachable by links."""
    prints = stored(fingerprints(rows, ["id"], shingle, seed), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    parts = connected_components(links(nodes, distance, blocks, crowded))
    labelled = stored(nodes.join(parts, nodes.fp == parts.node, "left")
                      .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-parts")
    least = labelled.groupBy("root").agg(F.min("least").alias("component"))
    named = stored(labelled.join(least, "root").select("fp", "component"), "simhash-components")
    return prints.join(named, "fp").select("id", "fp", "component")
