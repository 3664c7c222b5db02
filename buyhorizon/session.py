"""Spark session defaults for the pipeline."""

from __future__ import annotations

import functools
import getpass
import hashlib
import pathlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults for sessions this library builds. Broadcast thresholds and memory are
# left to the cluster; results depend on none of these settings.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "buyhorizon",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SQL_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Where the setting is absent a local session (tests) gets a scratch folder,
    once; any other master is refused, since a machine-local folder would be
    invisible to the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d.rstrip("/")
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="buyhorizon-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder; ``drop_scratch`` removes it."""
    path = f"{checkpoint_dir(spark)}/{name}"
    _MADE.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Removes the intermediate tables this process has made, through the folder's own file
    system. For the end of a job: frames that still read them can no longer be evaluated."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _MADE:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(hadoop).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: shared by later passes, lineage cut."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- results that outlive a session ------------------------------------------

def store_root(spark: SparkSession) -> str:
    """Where finished tables and fits are kept for later sessions: below the folder all executors share;
    a local session without one has a folder of the user's own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return f"{d.rstrip('/')}/buyhorizon-store"
    checkpoint_dir(spark)  # refuses a cluster that names no shared folder
    return f"{tempfile.gettempdir()}/buyhorizon-store-{getpass.getuser()}"


def store_entry(spark: SparkSession, name: str) -> str:
    return f"{store_root(spark)}/{name}"


def finished(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """The tables below ``folder`` with this prefix that were written whole, in a fixed order. Writers use a name
    of their own each, so two that make the same table at once do not meet."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}*/_SUCCESS")
    found = path.getFileSystem(hadoop).globStatus(path)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def kept(spark: SparkSession, name: str, make) -> DataFrame:
    """The stored table of this name, made by ``make()`` and written if there is none yet."""
    folder = store_entry(spark, name)
    if not finished(spark, folder, "run-"):
        make().write.parquet(f"{folder}/run-{uuid.uuid4().hex}")
    return spark.read.parquet(finished(spark, folder, "run-")[0])


def input_identity(tables: list[DataFrame]) -> list[str]:
    """Per table a digest of its files: paths, sizes and times of change. Reads no column."""
    out = []
    for df in tables:
        files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        files = files.select(F.xxhash64("file_path", "file_size", F.unix_micros("file_modification_time")).alias("h"))
        r = files.agg(F.count("h").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
        out.append(f"{r.n}:{r.x}:{r.s}")
    return out


@functools.cache
def code_digest() -> str:
    """Names the code that made a stored result: the library's sources (the corpus operators apart)."""
    root, h = pathlib.Path(__file__).parent, hashlib.sha256()
    for path in sorted(root.rglob("*.py")):
        if "llm" not in path.relative_to(root).parts:
            h.update(path.read_bytes())
    return h.hexdigest()
