"""Mixing sources to target weights, in fixed-length blocks of words.

Every source's words, document after document in a fixed order, are cut into
blocks of ``block`` words. The output has as many block slots per source as its
target asks for, dealt to output shards by multinomial draws: shard after shard
draws from what is left, so a shard's counts are random but the totals are met.
A source's slots are numbered over all shards; each pass over the source (an
epoch) maps slot numbers through its own pseudorandom permutation of the
source's block indexes (a keyed Feistel network with cycle walking), and blocks
are joined by index. So a block is used at most once an epoch, and no document
more than ``most`` times.

Per source only its name, size and shard counts pass through the driver (a
mixture is configured per source); documents, slots and blocks are distributed,
and a source with a third of all rows is numbered in hash chunks.

Defined results: null or empty text has size 0 and takes nothing; null is a
source of its own, last in order; repeated rows are separate documents; sources
without words get target 0; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import cycle, islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, located, map_rows, running_total, stored, with_locators

_WORD = regex.compile(WORD)


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size: the excess is reshared by weight."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        share = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if share * weights[i] > most * sizes[i]]
        for i in over or open_:
            out[i] = most * sizes[i] if over else share * weights[i]
        if not over:
            break
        left -= sum(out[i] for i in over)
        open_ -= set(over)
    return out


def draw(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots per shard (rows) and source: multinomial draws that use up each source's slots."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for shard in range(shards):
        want = int(left.sum()) // (shards - shard)
        while want:
            got = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[shard] += got
            left -= got
            want -= int(got.sum())
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed constants of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, length: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """For each row, the image of ``index`` under the permutation of range(length) that ``key`` names."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(length, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for r in range(rounds):
            left, right = right, left ^ (_mix(right + k + np.uint64(0x9E3779B97F4A7C15) * np.uint64(r + 1)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= length[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _place(seed: int):
    def place(number: list, slot: list, blocks: list) -> list:
        number, slot, blocks = (np.array(x, np.int64) for x in (number, slot, blocks))
        with np.errstate(over="ignore"):
            key = _mix(np.uint64(seed) + (number.astype(np.uint64) << np.uint64(20)) + (slot // blocks).astype(np.uint64) + np.uint64(1))
            return [permuted(slot % blocks, blocks, key)]
    return place


def take(rows: DataFrame, weights: tuple[float, ...], most: int = 3, block: int = 128, shards: int = 64, seed: int = 7, by_shard: bool = False):
    """Mixes ``rows`` (source, size, order, and columns that identify a row).

    Returns (sources, taken): per source (source, source_size, target), and per row
    and block taken the row's columns with first and last word (to) and times; with
    ``by_shard``, per row and slot, with the output shard and the source's slot
    number instead of times.
    """
    spark = rows.sparkSession
    found = sorted(rows.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).collect(), key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in found]
    aims = targets(sizes, list(islice(cycle(weights), len(sizes))), most)
    blocks = [-(-s // block) for s in sizes]
    slots = [min(round(t * b / s), most * b) if s else 0 for t, b, s in zip(aims, blocks, sizes, strict=True)]
    counts = draw(slots, shards, seed)
    starts = np.cumsum(counts, axis=0) - counts
    sources = spark.createDataFrame([(r.source, i, s, float(t)) for i, (r, s, t) in enumerate(zip(found, sizes, aims, strict=True))],
                                    "source string, number long, source_size long, target double")
    dealt = spark.createDataFrame([(int(i), k, int(starts[k, i]), int(counts[k, i]), blocks[i]) for k in range(shards) for i in range(len(found)) if counts[k, i]],
                                  "number long, shard int, start long, n long, blocks long")
    slot = dealt.repartition(shards).select("number", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("slot"), "blocks")
    own = ["shard", "slot"] if by_shard else []
    slot = slot.select("number", *own, F.col("number").alias("key"), F.col("slot").alias("index"), "blocks")
    used = map_rows(slot, ["number", *own], _place(seed), "block long")
    if not by_shard:
        used = used.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))

    worded = rows.where("size > 0")
    at = running_total(worded, ["source"], ["order", *sorted(set(rows.columns) - {"source", "order"})], "size", "at")
    at = at.join(sources.select(F.col("source").alias("_source"), "number"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    last = F.expr(f"(at + size - 1) div {block}")
    pieces = at.withColumn("block", F.explode(F.sequence(F.expr(f"at div {block}"), last)))
    # made by explode from a few rows, so Spark's estimate of it is far too low: never broadcast
    taken = pieces.join(used.hint("merge"), ["number", "block"])
    return sources, taken.select(*rows.columns, F.greatest(F.lit(0), F.col("block") * block - F.col("at")).alias("first"),
                                 F.least(F.col("size"), (F.col("block") + 1) * block - F.col("at")).alias("to"), *(own or ["times"]))


def word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _sized(docs: DataFrame, id_col: str) -> DataFrame:
    return located(docs, [F.col(id_col).alias("order"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")])


def mixed_counts(docs: DataFrame, id_col: str, weights: tuple[float, ...], **options) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words the mix takes)."""
    rows = stored(_sized(with_locators(docs), id_col), "mix-rows")
    sources, taken = take(rows, weights, **options)
    words = taken.groupBy("file", "row").agg(F.sum((F.col("to") - F.col("first")) * F.col("times")).alias("taken"))
    words = stored(words, "mix-taken")  # its files are far smaller than its rows: never broadcast by their size
    out = rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).join(words.hint("merge"), ["file", "row"], "left")
    return out.select(F.col("order").alias("id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def texts_of(text: str | None, parts: list) -> list[str]:
    """The copies of a text that a mix takes: copy c has the pieces taken at least c times, in order."""
    parts = sorted((p["first"], p["to"], p["times"]) for p in parts)
    spans = None
    out = []
    for c in range(1, max(p[2] for p in parts) + 1):
        own = [p for p in parts if p[2] >= c]
        spans = spans or [m.span() for m in _WORD.finditer(text)]
        if sum(b - a for a, b, _ in own) == len(spans):
            out.append(text)
            continue
        runs: list[list[int]] = []
        for a, b, _ in own:
            if runs and runs[-1][1] == a:
                runs[-1][1] = b
            else:
                runs.append([a, b])
        out.append(" ".join(text[spans[a][0]:spans[b - 1][1]] for a, b in runs))
    return out


def mixed_documents(docs: DataFrame, id_col: str, weights: tuple[float, ...], **options) -> DataFrame:
    """The mix as documents: each row's text is what is taken of it, once per copy; ``n_chars`` is set anew."""
    docs = with_locators(docs)
    _, taken = take(stored(_sized(docs, id_col), "mix-rows"), weights, **options)
    parts = stored(taken.groupBy("file", "row").agg(F.collect_list(F.struct("first", "to", "times")).alias("parts")), "mix-parts")  # of one document
    whole = located(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")]).join(parts.hint("merge"), ["file", "row"]).select("whole", "parts")
    copies = map_rows(whole, ["whole"], lambda texts, parts: [[texts_of(t, p) for t, p in zip(texts, parts, strict=True)]], "texts array<string>", inner="text")
    copies = copies.select("whole", F.explode("texts").alias("mixed"))
    set_anew = {"text": F.col("mixed"), "n_chars": F.char_length("mixed")}
    return copies.select(*[(set_anew[f.name].cast(f.dataType) if f.name in set_anew else F.col(f"whole.`{f.name}`")).alias(f.name) for f in docs.schema.fields])


def mixed_shards(docs: DataFrame, id_col: str, weights: tuple[float, ...], **options) -> DataFrame:
    """The mix per output shard: shard, source, slot of the source, and per document in the slot's block id, first and last word (to) and text."""
    docs = with_locators(docs)
    _, taken = take(stored(_sized(docs, id_col), "mix-rows"), weights, by_shard=True, **options)
    piece = F.struct("shard", "slot", "first", "to", F.lit(1).alias("times"))
    parts = stored(taken.groupBy("file", "row", "source", F.col("order").alias("id")).agg(F.collect_list(piece).alias("parts")), "mix-slots")  # of one document
    whole = located(docs, [F.col("text")]).join(parts.hint("merge"), ["file", "row"]).select("source", "id", F.col("parts").alias("kept"), "text", "parts")
    made = map_rows(whole, ["source", "id", "kept"], lambda texts, parts: [[[texts_of(t, [p])[0] for p in ps] for t, ps in zip(texts, parts, strict=True)]], "texts array<string>")
    each = made.select("source", "id", F.explode(F.arrays_zip("kept", "texts")).alias("one"))
    return each.select("one.kept.shard", "source", "one.kept.slot", "id", "one.kept.first", "one.kept.to", F.col("one.texts").alias("text"))
