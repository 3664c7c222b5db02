"""The fact tables of one build: pruned by their own date, enriched once, stored.

Every grouped pass of a build reads the stored rows, so no pass repeats the
enrichment joins, and a lost executor re-reads files instead of recomputing.
Each source is pruned by its own timestamp before it is joined: orders in range
LEFT JOIN comments, comments in range JOIN orders, actions in range; labels need
orders of target products only and no comments.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqlexpr as X
from ..operators.enrich import SKU_COLUMNS
from ..session import stored
from ..sources.fixtures import Tables
from ..spec import FeatureSpec

COLUMNS = {
    "order": ["user_id", "o_id", "sku_id", "o_date", "o_area", "o_sku_num", "comment_create_tm", "score_level", *SKU_COLUMNS],
    "action": ["user_id", "sku_id", "a_date", "a_num", "a_type", *SKU_COLUMNS],
}
COLUMNS["comment"] = COLUMNS["order"]


def between_days(df: DataFrame, ts: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Timestamps from the first day's midnight to the last day's midnight (both included)."""
    return df.where(f"{ts} >= {X.midnight_of(lo)} AND {ts} <= {X.midnight_of(hi)}")


def enriched(t: Tables, src: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """The rows of a source in the date range, with their joins; pruned before the joins."""
    sku = t.sku.select("sku_id", *SKU_COLUMNS)
    comments = t.comment.select("user_id", "o_id", "comment_create_tm", "score_level")
    if src == "order":
        df = between_days(t.order, "o_date", lo, hi).join(comments, ["user_id", "o_id"], "left")
    elif src == "comment":
        df = between_days(comments, "comment_create_tm", lo, hi).join(t.order, ["user_id", "o_id"])
    else:
        df = between_days(t.action, "a_date", lo, hi)
    return df.join(sku, "sku_id", "left").select(*COLUMNS[src])


def label_orders(t: Tables, spec: FeatureSpec, anchors) -> DataFrame:
    """Orders of target products in the label windows: (user_id, o_id, o_date). A second
    order line or a comment changes neither the distinct orders nor the first day."""
    lo, hi = min(a for _, a in anchors), max(a for _, a in anchors) + dt.timedelta(days=spec.label_window)
    targets = t.sku.where(F.col("cate").isin([int(c) for c in spec.target_cates])).select("sku_id")
    return between_days(t.order, "o_date", lo, hi).join(targets, "sku_id", "left_semi").select("user_id", "o_id", "o_date")


class Facts:
    """Stored facts per source and date range, made on first use."""

    def __init__(self, t: Tables):
        self.tables, self.made = t, {}

    def make(self, sources, spec: FeatureSpec, anchors) -> None:
        """Stores several sources at once: independent jobs that share the cluster."""
        with ThreadPoolExecutor(len(COLUMNS)) as pool:
            list(pool.map(lambda src: self.of(src, spec, anchors), sources))

    def of(self, src: str, spec: FeatureSpec, anchors) -> DataFrame:
        lo = min(a for _, a in anchors) - dt.timedelta(days=spec.max_window)
        hi = max(a for _, a in anchors) - dt.timedelta(days=1)
        if (src, lo, hi) not in self.made:
            self.made[src, lo, hi] = stored(enriched(self.tables, src, lo, hi), f"facts-{src}")
        return self.made[src, lo, hi]


class DayFacts(Facts):
    """Facts in an append-only table per source, partitioned by day: a build adds the days that its windows need and the
    table lacks, and reads its own days only. For builds one after the other, as a new slip or a new month is added.

    ``folder`` belongs to one state of the input tables (name it after ``session.input_identity``): an order's comments
    are joined when its day is added. Days are noted as held after they are written, and written by replacing whole
    days, so an attempt that was lost is made again without doubling rows."""

    TIMES = {"order": "o_date", "comment": "comment_create_tm", "action": "a_date"}

    def __init__(self, t: Tables, folder: str):
        super().__init__(t)
        self.folder, self.added = folder, []

    def held(self, spark, src: str) -> set[dt.date]:
        try:
            rows = spark.read.parquet(f"{self.folder}/{src}-days").distinct().collect()  # at most a row per day
        except AnalysisException:  # none yet
            return set()
        return {r.day for r in rows}

    def of(self, src: str, spec: FeatureSpec, anchors) -> DataFrame:
        spark = self.tables.user.sparkSession
        lo = min(a for _, a in anchors) - dt.timedelta(days=spec.max_window)
        hi = max(a for _, a in anchors) - dt.timedelta(days=1)
        held = self.held(spark, src)
        missing = [d for d in (lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)) if d not in held]
        time, path = self.TIMES[src], f"{self.folder}/{src}"
        if missing:
            first, last = missing[0], missing[-1]
            wanted = F.to_date(time).isin(missing) if len(missing) <= (last - first).days else F.to_date(time) <= F.lit(last)
            rows = enriched(self.tables, src, first, last + dt.timedelta(days=1)).where(wanted).withColumn("day", F.to_date(time))
            # dealt by day, or every task would write a file for each of the days; a large day is split by its size
            rows.hint("rebalance", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
            spark.createDataFrame([(d,) for d in missing], "day date").coalesce(1).write.mode("append").parquet(f"{self.folder}/{src}-days")
            self.added.append((src, first, last, len(missing)))
        schema = enriched(self.tables, src, lo, hi).withColumn("day", F.to_date(time)).schema
        days = spark.read.schema(schema).parquet(path).where(F.col("day").between(F.lit(lo), F.lit(hi)))
        return between_days(days, time, lo, hi).drop("day")
