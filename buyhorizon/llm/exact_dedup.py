"""Exact deduplication as a stateful stream.

Rows are logged as (identifier, digest, content locator, batch), each locator once:
a batch that is added again, in whole or in part, or whose first attempt was lost
after the log was written, changes nothing twice. A Structured Streaming query folds
the log into disk-backed state (RocksDB), keyed by digest and kept without expiry: the
smallest identifier seen, the locator of its content and the number of rows. The
streaming aggregate combines on the map side, so a text with a third of all copies
reaches its state partition as one row per task.

Every hit (a digest with more than one row) is checked byte by byte against one text of
its digest, once: rows of batches that are not yet checked are compared with the row
that earlier batches kept, whose text is read at its locator, or, where there is none,
with the one that is kept now. Should texts of one digest differ, they are told apart
by their full text.

Defined results: null text counts as empty; rows that repeat an identifier and a
text are copies of each other, and exactly one (by locator) is kept; a null
identifier sorts after all others; an empty table gives no rows; texts of any length
are compared whole; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, located, new_folder, rows_at, stored, with_locators

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no files of 4 MB set aside per state partition
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: Copies of one text that a task compares with one replica of the kept text.
COPIES_PER_SALT = 4096


def normalised(text: Column) -> Column:
    """Null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class StreamingDedup:
    """Digest state in ``folder``; each ``add`` folds one batch of documents into it."""

    def __init__(self, spark: SparkSession, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256):
        self.spark, self.id_col, self.text_col, self.digest = spark, id_col, text_col, digest
        self.folder = folder or new_folder(spark, "exact-dedup")

    def _rows(self, docs: DataFrame, with_text: bool = False) -> DataFrame:
        text = normalised(F.col(self.text_col))
        cols = [F.col(self.id_col).alias("id"), self.digest(text).alias("digest")]
        return located(docs, cols + ([text.alias("content")] if with_text else []))

    def add(self, docs: DataFrame) -> None:
        """Logs those rows of ``docs`` (with locators) that the log lacks, and runs the stream over what is new."""
        rows, log = self._rows(docs), self.log()
        if log is None:
            rows = rows.withColumn("batch", F.lit(0))
        else:
            known = log.join(rows.select("file").distinct(), "file", "left_semi").select("file", "row")
            newest = log.agg(F.max("batch")).first()[0]
            rows = rows.join(known, ["file", "row"], "left_anti").select(*rows.columns, F.lit(0 if newest is None else newest + 1).alias("batch"))
            rows = stored(rows, "dedup-new")  # before the log that it reads grows
        if log is None or not rows.isEmpty():
            rows.write.mode("append").parquet(f"{self.folder}/log")
        stream = self.spark.readStream.schema(self.log().schema).parquet(f"{self.folder}/log")
        state = stream.groupBy("digest").agg(
            F.min(F.struct(F.col("id").isNull().alias("null_id"), "id", "file", "row")).alias("first"), F.count(F.lit(1)).alias("group_size"))
        with _settings(self.spark, ROCKSDB):
            query = (state.writeStream.outputMode("update").option("checkpointLocation", f"{self.folder}/state")
                     .trigger(availableNow=True)
                     .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{self.folder}/groups/batch={n}")).start())
            query.awaitTermination()

    def _table(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        except AnalysisException:  # none yet
            return None

    def log(self) -> DataFrame | None:
        """The logged rows: id, digest, file, row, batch."""
        return self._table("log")

    def groups(self) -> DataFrame:
        """The state's latest version of each digest: the kept row and the group's size.

        Over batches the kept row only falls and the size only grows, so the
        versions of a digest combine by min and max.
        """
        versions = self.spark.read.parquet(f"{self.folder}/groups")
        return versions.groupBy("digest").agg(F.min("first").alias("first"), F.max("group_size").alias("group_size"))

    def checked(self) -> tuple[int, DataFrame | None]:
        """The last batch whose hits were compared, and the digests of which texts differed so far."""
        found = self._table("checked")
        last = found.agg(F.max("batch")).first()[0] if found is not None else None
        return (-1 if last is None else last), None if found is None else found.where("digest IS NOT NULL").select("digest").distinct()

    def hits(self, docs: DataFrame, groups: DataFrame) -> DataFrame:
        """Rows of digests seen more than once, with their text."""
        shared = groups.where("group_size > 1")
        first = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
        return (self._rows(docs, True).join(shared, "digest")
                .select("digest", "id", "file", "row", "content", "group_size", first.alias("is_first")))

    def texts_at(self, rows: DataFrame) -> DataFrame:
        """The stored ``rows`` (file, row, ...) with their text: of the files that they lie in, only those rows' texts are kept.
        The list of these files is all that the driver sees, as with any read of them."""
        files = [r["file"] for r in rows.select("file").distinct().collect()]
        if not files:
            return rows.withColumn("content", F.lit(None).cast("string"))
        return rows.join(located(self.spark.read.parquet(*files), [normalised(F.col(self.text_col)).alias("content")]), ["file", "row"])

    def unchecked(self, docs: DataFrame, groups: DataFrame, done: int) -> DataFrame:
        """Hits that were not compared yet, and per digest the one row (is_first) that they are compared with."""
        hits = stored(self.hits(docs, groups), "dedup-hits")
        log = self.log()
        if done < 0 and log.agg(F.max("batch")).first()[0] == 0:
            return hits  # the first batch is all there is
        shared = groups.where("group_size > 1").select("digest", "first", "group_size")
        new = log.where(F.col("batch") > done).join(shared, "digest")
        before = log.where(F.col("batch") <= done).join(new.select("digest").distinct(), "digest", "left_semi")
        before = before.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("null_id"), "id", "file", "row")).alias("kept"))
        new = new.join(before, "digest", "left").withColumn("against", F.coalesce("kept", "first"))
        here = (F.col("file") == F.col("against.file")) & (F.col("row") == F.col("against.row"))
        wanted = new.select("digest", "id", "file", "row", "group_size", here.alias("is_first"))
        earlier = new.where("kept IS NOT NULL").select("digest", "kept.id", "kept.file", "kept.row", "group_size", F.lit(True).alias("is_first")).distinct()
        wanted = stored(wanted.unionByName(earlier), "dedup-unchecked")
        at_hand = wanted.join(hits.select("file", "row", "content"), ["file", "row"])
        absent = stored(wanted.join(hits.select("file", "row"), ["file", "row"], "left_anti"), "dedup-absent")
        return stored(at_hand.select(*hits.columns).unionByName(self.texts_at(absent).select(*hits.columns)), "dedup-texts")

    @staticmethod
    def differing(hits: DataFrame) -> DataFrame:
        """Digests of which some text is not, byte for byte, the kept one."""
        salts = F.ceil(F.col("group_size") / COPIES_PER_SALT).cast("int")
        kept = (hits.where("is_first")
                .select("digest", F.col("content").alias("kept_content"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")))
        other = hits.where("NOT is_first").select("digest", "content", F.pmod(F.xxhash64("file", "row"), salts).cast("int").alias("salt"))
        return (other.join(kept, ["digest", "salt"])
                .where(F.col("content").cast("binary") != F.col("kept_content").cast("binary")).select("digest").distinct())

    def result(self, docs: DataFrame) -> DataFrame:
        """One row per logged row: id, file, row, digest, first (struct), group_size."""
        groups = stored(self.groups(), "dedup-groups")
        done, known = self.checked()
        newest = self.log().agg(F.max("batch")).first()[0]
        if newest is not None and newest > done:
            hits = self.unchecked(docs, groups, done)
            found = self.differing(hits).select("digest", F.lit(newest).alias("batch"))
            marker = self.spark.createDataFrame([(None, newest)], found.schema)
            found.unionByName(marker).write.mode("overwrite").parquet(f"{self.folder}/checked/upto={newest}")
            known = self.checked()[1]
        rows = self.log().join(groups, "digest")
        if known is None or known.isEmpty():
            return rows
        mixed = self.texts_at(stored(self.log().join(known, "digest", "left_semi"), "dedup-mixed"))
        apart = mixed.groupBy("digest", "content").agg(
            F.min(F.struct(F.col("id").isNull().alias("null_id"), "id", "file", "row")).alias("own_first"), F.count(F.lit(1)).alias("own_size"))
        apart = mixed.join(apart, ["digest", "content"]).select("file", "row", "own_first", "own_size")
        return (rows.join(apart, ["file", "row"], "left")
                .withColumn("first", F.coalesce("own_first", "first")).withColumn("group_size", F.coalesce("own_size", "group_size")))


def _landed(docs: DataFrame, folder: str | None) -> DataFrame:
    """``docs`` with locators. Rows that come from no file are landed under their content, so that they have the same locators when they come again."""
    found = with_locators(docs, lambda: None)
    if found is not None or folder is None:
        return found if found is not None else stored(docs, "landed")
    h = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    path = f"{folder}/landed/{r.n}_{r.x}_{r.s}"
    try:
        return docs.sparkSession.read.schema(docs.schema).parquet(path)
    except AnalysisException:  # first time
        docs.write.parquet(path)
        return docs.sparkSession.read.schema(docs.schema).parquet(path)


def _dedup(docs: DataFrame, folder: str | None, **options) -> tuple[DataFrame, DataFrame]:
    docs = _landed(docs, folder)
    dedup = StreamingDedup(docs.sparkSession, folder, **options)
    dedup.add(docs)
    return docs, dedup.result(docs)


def _kept() -> Column:
    return (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))


def exact_groups(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and the digest of the normalised text."""
    _, rows = _dedup(docs, folder, **options)
    return rows.select("id", F.col("first.id").alias("keep_id"), "group_size", _kept().alias("kept"), "digest")


def drop_exact_copies(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs, rows = _dedup(docs, folder, **options)
    return rows_at(docs, rows.where(_kept()).select("file", "row"))
