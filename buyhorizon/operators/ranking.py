"""Per-user ranking operators and global ranks, all without one-task groups.

Per-user first/last/max rows are aggregates (``min``/``max`` over a struct
whose leading fields are the order keys), so they partially aggregate
map-side: a user holding a third of the rows costs one row per task before
the shuffle, unlike ``row_number`` over a user window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sqlexpr as X
from ..session import checkpoint_dir


def _extreme_per_key(df: DataFrame, keys: list[str], order: list[str], cols: list[str], fn) -> DataFrame:
    cols = [c for c in cols if c not in keys]
    st = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)],
                  *[F.col(c).alias(f"v_{c}") for c in cols])
    agg = df.groupBy(*keys).agg(fn(st).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.v_{c}").alias(c) for c in cols])


def first_per_user(df: DataFrame, order: list[str], cols: list[str], keys=("user_id",)) -> DataFrame:
    """Earliest row per key by ``order`` (then by the columns themselves)."""
    return _extreme_per_key(df, list(keys), order + [c for c in cols if c not in order], cols, F.min)


def last_per_user(df: DataFrame, order: list[str], cols: list[str], keys=("user_id",)) -> DataFrame:
    """Latest row per key by ``order`` (then by the columns themselves)."""
    return _extreme_per_key(df, list(keys), order + [c for c in cols if c not in order], cols, F.max)


def max_measure_per_user(df: DataFrame, measure: str, date_col: str, cols: list[str],
                         keys=("user_id",)) -> DataFrame:
    """Row with the largest measure; equal maxima -> the earliest date."""
    neg = df.withColumn("_neg_date", -F.expr(X.micros(date_col)))
    picked = _extreme_per_key(neg.where(F.col(measure).isNotNull()), list(keys), [measure, "_neg_date"], cols, F.max)
    return picked


def singleton_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose full value occurs exactly once (drop_duplicates(keep=False))."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")


def rows_except_singleton(df: DataFrame, first: DataFrame, cols: list[str]) -> DataFrame:
    """The reference's append-first-twice + keep=False: rows occurring once,
    minus the first rows."""
    return singleton_rows(df.select(*cols), cols).join(first.select(*cols), cols, "left_anti")


def second_purchase(df: DataFrame, cols: list[str], order: list[str], key: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """(first rows, earliest remaining singleton rows) per user."""
    first = first_per_user(df, order, cols, (key,))
    rest = rows_except_singleton(df, first, cols)
    second = first_per_user(rest, order, cols, (key,))
    return first, second


def global_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Dense 1..n position under a total order, computed distributed.

    Sort by range partitioning, checkpoint it (both passes below must see the
    same partitions), count rows per partition (one row per partition), turn
    the counts into offsets on that tiny table and add each row's index inside
    its partition. No single task ever holds more than one range partition."""
    checkpoint_dir(df.sparkSession)
    sorted_df = (df.orderBy(*order)
                   .withColumn("_pid", F.spark_partition_id())
                   .withColumn("_mid", F.monotonically_increasing_id())
                   .checkpoint(eager=True))
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # offsets has one row per partition: a bounded broadcast
    return (sorted_df.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
                     .withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
                     .drop("_pid", "_mid", "_off", "_m0"))


def rank_weight(topk: DataFrame, order: list) -> DataFrame:
    """Position 1..k in submission order and weight 1 / (1 + ln position).
    Runs on the top-K rows only (k bounded by the report size)."""
    w = Window.orderBy(*order)
    return (topk.withColumn("index", F.row_number().over(w))
                .withColumn("wi", 1.0 / (1.0 + F.log(F.col("index").cast("double")))))


def exact_median(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The exact median per key from value counts: a key with a third of all rows is
    first combined per (key, value), and only its distinct values meet in one window."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    by_value = Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    seen = counts.withColumn("_upto", F.sum("_n").over(by_value)).withColumn("_all", F.sum("_n").over(Window.partitionBy(key)))
    # the rows at positions floor((n + 1) / 2) and floor((n + 2) / 2), which coincide for odd n
    low, high = F.expr("(_all + 1) div 2"), F.expr("(_all + 2) div 2")
    before = F.col("_upto") - F.col("_n")
    hit = lambda at: F.when((before < at) & (at <= F.col("_upto")), F.col(value).cast("double"))
    return seen.groupBy(key).agg(((F.max(hit(low)) + F.max(hit(high))) / 2).alias(out))
