"""Readers and writers (§2.1): declared-schema CSV/parquet scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import with_date_parts
from ..session import stored
from . import schemas

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def scan_static(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """load_csv(path): a header CSV (or parquet) with the declared schema."""
    r = spark.read.schema(schemas.SCHEMAS[table])
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.parquet(path)


def scan_dated(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """load_csv(path, date_col): parse the date column, add year, month, day.
    No global sort: every consumer states its own order."""
    r = spark.read.schema(schemas.SCHEMAS[table])
    if fmt == "csv":
        df = r.option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path)
    else:
        df = r.parquet(path)
    return with_date_parts(df, schemas.DATE_COLUMN[table])


#: Where a line that does not fit the declared schema is kept while a scan is split.
REJECTED = "_rejected_line"


def scan_checked(spark: SparkSession, path: str, table: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A CSV table's rows, and the lines that do not fit its declared schema: (file, line).

    A line is rejected if it has more or fewer fields than the schema or one that its type cannot hold; none becomes a
    row of silent nulls. The files are parsed once, all columns of them, and stored: both results read that, and do not
    depend on which columns a query reads. Only a rejected line has its file's name stored."""
    schema = StructType([*schemas.SCHEMAS[table].fields, StructField(REJECTED, StringType())])
    df = (spark.read.schema(schema).option("header", header).option("timestampNTZFormat", TIMESTAMP_FORMAT).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", False).csv(path))
    bad = F.col(REJECTED).isNotNull()
    df = stored(df.select("*", F.when(bad, F.col("_metadata.file_path")).alias("_file")), f"parsed-{table}")
    return df.where(~bad).drop(REJECTED, "_file"), df.where(bad).select(F.col("_file").alias("file"), F.col(REJECTED).alias("line"))


def sink_rejected(rejected: DataFrame, table: str, path: str) -> None:
    """Appends rejected lines to the quarantine, one folder per table."""
    rejected.withColumn("table", F.lit(table)).write.mode("append").partitionBy("table").parquet(path)


def rejected_counts(spark: SparkSession, path: str) -> DataFrame:
    """(table, file, rejected) of a quarantine."""
    return spark.read.schema("file STRING, line STRING, table STRING").parquet(path).groupBy("table", "file").agg(F.count(F.lit(1)).alias("rejected"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT)
       .csv(path))


def sink_feature_table(df: DataFrame, path: str, mode: str = "overwrite", by: tuple[str, ...] = ("slip",)) -> None:
    """Feature tables as parquet partitioned by slip; with ("part", "slip") each part's folder is a table of its own,
    and all are written in one pass."""
    df.write.mode(mode).partitionBy(*by).parquet(path)


def scan_feature_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sink_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "user_id") -> DataFrame:
    """A table in ``buckets`` files by ``key``, each sorted by it: tables of one bucket count join on it without an exchange.

    The rows are dealt to the buckets first, so every bucket is one file."""
    df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def scan_bucketed(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int, key: str = "user_id") -> DataFrame:
    """A bucketed table written by another session, under a name of this one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


SUBMISSION = "position BIGINT, user_id BIGINT, pred_date DATE"


def sink_predictions(ranked: DataFrame, path: str) -> None:
    """The full ranked list (position, user, both predictions, date) as CSV with a header."""
    ranked.write.mode("overwrite").option("header", True).csv(path)


def sink_submission(ranked: DataFrame, path: str, k: int) -> None:
    """position, user_id, pred_date of the first ``k`` positions as CSV with a header."""
    ranked.where(F.col("position") <= k).select("position", "user_id", "pred_date").write.mode("overwrite").option("header", True).csv(path)


def scan_prediction(spark: SparkSession, path: str, schema: str = SUBMISSION) -> DataFrame:
    """A submission, or with its schema a full list, with the positions as written."""
    return spark.read.schema(schema).option("header", True).csv(path)


def sink_tuning_result(df: DataFrame, path: str) -> None:
    """Append the best parameters (one row per tuning run)."""
    df.write.mode("append").parquet(path)
