"""Sharding by bytes with Karmarkar-Karp differencing.

Groups (rows of one text) are indivisible. Groups of at least one grain (the
bytes of a shard over ``grains``) are items of their own, at most shards x grains
of them; smaller groups fall by hash into shards x grains bundles, each an item.
So the differencing always sees at most 2 x shards x grains items, whatever the
table's size, and the bundles are fine enough to even out the large groups. The
grains of a shard become fewer with more shards, so that their number stays about
``GRAINS`` until a shard has ``LEAST`` of them. The differencing repeatedly takes the
two partial partitions of largest spread and combines them oppositely ordered; a
partial partition lists its non-empty parts only. Only the items (sizes, no texts) reach the driver, and the
two look-up tables that go back, of the same bound, are broadcast.

Defined results: null text has no bytes and goes with empty text; the size is
the UTF-8 bytes plus one; repeated rows are separate rows of one group; slots
count a shard's rows without gaps, in an order fixed by identifier and text; an
empty table gives no rows; a group larger than an even share stays whole, and
the other shards are evened out.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total, stored

#: Grains of all shards together, and the fewest of one shard.
GRAINS, LEAST = 8192, 8


def differencing(sizes: list[int], shards: int) -> list[int]:
    """A shard for each item by the k-way largest differencing method."""
    if not sizes:
        return []
    heap = [(-size if shards > 1 else 0, i, [(size, i)]) for i, size in enumerate(sizes)]  # the other parts are empty
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - shards)  # parts that have none empty opposite: the smallest of either, oppositely ordered
        parts = [(x + y, (p, q)) for (x, p), (y, q) in zip(a[:both], b[both - 1::-1] if both else (), strict=True)] + a[both:] + b[both:]
        parts.sort(key=lambda x: x[0])
        heapq.heappush(heap, ((parts[0][0] if len(parts) == shards else 0) - parts[-1][0], order, parts))
        order += 1
    out = [0] * len(sizes)
    for shard, (_, tree) in enumerate(reversed(heap[0][2])):
        todo = [] if tree is None else [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                out[x] = shard
    return out


def shard_by_bytes(rows: DataFrame, shards: int = 8, grains: int | None = None) -> DataFrame:
    """``rows`` (id, text) to (id, size, crc32, shard, slot), groups of equal text whole."""
    spark = rows.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stored(rows.select("id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc32"),
                              F.unhex(F.sha2(text, 256)).alias("digest")), "shard-rows")
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    bundles = shards * (grains or max(LEAST, GRAINS // shards))
    heavy = F.col("bytes") * bundles >= total
    bundle = F.pmod(F.xxhash64("digest"), F.lit(bundles)).cast("int")
    items = (groups.where(heavy).select("digest", F.lit(None).cast("int").alias("bundle"), "bytes")
             .union(groups.where(~heavy).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).select(F.lit(None).cast("binary"), "bundle", "bytes")))
    items = sorted(items.collect(), key=lambda r: (-r.bytes, r.digest is None, bytes(r.digest or b""), r.bundle or 0))  # 2 x bundles at most
    placed = list(zip(items, differencing([r.bytes for r in items], shards), strict=True))
    large = spark.createDataFrame([(r.digest, s) for r, s in placed if r.digest is not None], "digest binary, own int")
    small = spark.createDataFrame([(r.bundle, s) for r, s in placed if r.digest is None], "bundle int, common int")
    placed = (rows.withColumn("bundle", bundle).join(F.broadcast(large), "digest", "left").join(F.broadcast(small), "bundle", "left")
              .select("id", "size", "crc32", "digest", F.coalesce("own", "common").alias("shard"), F.lit(1).alias("one")))
    return running_total(placed, ["shard"], ["id", "digest"], "one", "slot").select("id", "size", "crc32", "shard", "slot")


def write_shards(docs: DataFrame, placed: DataFrame, id_col: str, path: str) -> None:
    """Writes ``docs`` (unique ids) as one folder per shard, rows in slot order within files."""
    at = placed.select(F.col("id").alias(id_col), "shard", "slot")
    out = docs.drop("shard", "slot").join(at, id_col)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
