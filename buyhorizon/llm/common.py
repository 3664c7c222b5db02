"""Small helpers shared by the operators: tables, stored intermediates, positions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path

#: ASCII white space, as the contracts define it; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the one all executors share."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` of ``docs`` with each row's content locator (``file``, ``row``).

    The locator is the file a row lies in and its index there. Rows that do not
    come straight from files are written to the shared folder first.
    """
    meta = docs.metadataColumn("_metadata")
    return docs.select(*columns, meta["file_path"].alias("file"), meta["row_index"].alias("row"))


def with_locators(docs: DataFrame, otherwise: Callable[[], DataFrame | None] | None = None) -> DataFrame | None:
    """``docs`` itself if its rows carry file metadata, else a stored copy that does (or what ``otherwise`` gives)."""
    try:
        located(docs, [F.lit(1).alias("one")]).schema  # noqa: B018  analysis happens here
        return docs
    except AnalysisException:
        return otherwise() if otherwise else stored(docs, "landed")


def rows_at(docs: DataFrame, locators: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with locators) that lie at ``locators`` (file, row), with all their columns, whatever those are called."""
    meta = docs.metadataColumn("_metadata")
    return docs.join(locators, (meta["file_path"] == locators["file"]) & (meta["row_index"] == locators["row"]), "left_semi")


def running_total(df: DataFrame, group: list[str], order: list[str], size: str, out: str, chunks: int = 1024) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows before this one in its group.

    The order within a group is (hash chunk of ``order[0]``, ``order``): fixed, but
    spread over ``chunks`` windows, so a group with a third of all rows is summed
    by many tasks. Chunk totals (groups x chunks rows) are summed once more.
    Nulls are a group of their own; rows that tie in ``order`` are interchangeable.
    """
    d = df.withColumn("_chunk", F.pmod(F.xxhash64(order[0]), F.lit(chunks)).cast("int"))
    before = (Window.unboundedPreceding, -1)
    local = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(*before)
    totals = d.groupBy(*group, "_chunk").agg(F.sum(size).alias("_sum"))
    over = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(*before)
    totals = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_chunk").alias("_c"),
                           F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_base"))
    d = d.withColumn("_local", F.coalesce(F.sum(size).over(local), F.lit(0)))
    on = F.col("_chunk") == F.col("_c")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (d.join(totals, on).withColumn(out, F.col("_local") + F.col("_base"))
            .drop("_chunk", "_c", "_local", "_base", *[f"_g{i}" for i in range(len(group))]))


#: Bytes of rows that a task turns into Python objects at once; a larger row is a slice of its own.
SLICE = 1 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``SLICE`` bytes, all rows in order."""
    rows = max(1, batch.num_rows * SLICE // max(SLICE, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_rows(df: DataFrame, keep: list[str], fn: Callable[..., list], outputs: str, inner: str | None = None) -> DataFrame:
    """``keep`` columns of ``df`` plus ``outputs``, made by ``fn`` batch by batch.

    ``fn`` gets the other columns as Python lists and returns one list or array
    per output. Rows stay in Arrow, so kept values do not change type. With
    ``inner``, that field of the first kept column, a struct, comes before the
    other columns, so a text that is kept need not be sent twice.
    """
    rest = [c for c in df.columns if c not in keep]
    rows = df.select(*keep, *rest)
    schema = StructType(rows.select(*keep).schema.fields + StructType.fromDDL(outputs).fields)
    arrow, n = to_arrow_schema(schema), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            pa.default_memory_pool().release_unused()
            own = [pc.struct_field(batch.column(0), inner)] if inner else []
            new = fn(*[c.to_pylist() for c in own + batch.columns[n:]])
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(batch.columns[:n], arrow, strict=False)]
                + [pa.array(v, f.type) for v, f in zip(new, list(arrow)[n:], strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)
