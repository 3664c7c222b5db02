"""Token counts from an exact length histogram.

Documents are encoded in whole and counted by length; a hot text or source does
not matter, since lengths are combined on the map side. Suffix sums over the
histogram (per range of lengths, then over the ranges) answer, for every
length taken as a context limit, how many documents and tokens are at least that
long, and how many tokens remain when every document is cut at the limit.

Defined results: null and empty texts have length 0; an empty table gives no
rows; special token strings in a text count as ordinary text; repeated rows
count each; extra columns do not matter.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, stored

#: Lengths summed by one window; the ranges' totals are summed once more.
RANGE = 64


def load(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def lengths(rows: DataFrame, path: str, pattern: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with ``n_tokens``; the one other column is the text."""
    shared = rows.sparkSession.sparkContext.broadcast({"ranks": load(path), "encoding": None})

    def count(texts: list) -> list:
        if shared.value["encoding"] is None:
            import tiktoken

            shared.value["encoding"] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=shared.value["ranks"], special_tokens={})
        encode = shared.value["encoding"].encode_ordinary
        return [[len(encode(t)) if t else 0 for t in texts]]

    return map_rows(rows, keep, count, "n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row per length that occurs; stored, since every answer reads it again."""
    return stored(counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "length-histogram")


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Adds per length: docs_at_least, tokens_at_least, truncated_tokens (each document cut there), docs_share_at_most."""
    hist = hist.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("range", F.expr(f"n_tokens div {RANGE}"))
    ranges = hist.groupBy("range").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("all"))
    beyond = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)  # longest length / RANGE rows
    every = Window.partitionBy()
    ranges = ranges.select(F.col("range").alias("_range"), F.coalesce(F.sum("docs").over(beyond), F.lit(0)).alias("more_docs"),
                           F.coalesce(F.sum("all").over(beyond), F.lit(0)).alias("more_tokens"),
                           F.sum("docs").over(every).alias("total_docs"), F.sum("all").over(every).alias("total_tokens"))
    own = Window.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    at = hist.withColumn("own_docs", F.sum("n_docs").over(own)).withColumn("own_tokens", F.sum("tokens").over(own)).join(ranges, F.col("range") == F.col("_range"))
    at = at.withColumn("docs_at_least", F.col("own_docs") + F.col("more_docs")).withColumn("tokens_at_least", F.col("own_tokens") + F.col("more_tokens"))
    return at.select("n_tokens", "n_docs", "tokens", "docs_at_least", "tokens_at_least",
                     (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
                     ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("docs_share_at_most"))


def totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """One row: n_docs, n_tokens, and ``at_<limit>``: the tokens left when documents are cut at a limit."""
    cut = [F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(n)) * F.col("n_docs")), F.lit(0)).alias(f"at_{n}") for n in limits]
    return hist.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0)).alias("n_tokens"), *cut)


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """One row: ``q_<share>``, the least length that at least that share of documents does not exceed."""
    return sums.agg(*[F.min(F.when(F.col("docs_share_at_most") >= q, F.col("n_tokens"))).alias(f"q_{q}") for q in shares])
