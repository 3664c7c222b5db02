"""The five pipeline tables derived from the TPC-H-like test data.

The derivations are fixed values: they must produce exactly the rows the
DuckDB oracle builds from the same parquet files (see ``FIXTURE_SQL``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


@dataclass(frozen=True)
class Tables:
    """The five input tables of one run (raw: -1 sentinels still present)."""
    user: DataFrame
    sku: DataFrame
    order: DataFrame
    comment: DataFrame
    action: DataFrame

    def cleaned(self) -> "Tables":
        """Apply the -1 -> null rule to the sentinel columns (null_sentinel)."""
        from ..functions.columns import null_sentinel
        return Tables(
            user=null_sentinel(self.user, schemas.SENTINEL_COLUMNS["user"]),
            sku=null_sentinel(self.sku, schemas.SENTINEL_COLUMNS["sku"]),
            order=self.order,
            comment=null_sentinel(self.comment, schemas.SENTINEL_COLUMNS["comment"]),
            action=self.action,
        )


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def f_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    seg = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", 1)
           .when(F.col("c_mktsegment") == "BUILDING", 2)
           .when(F.col("c_mktsegment") == "FURNITURE", 3)
           .when(F.col("c_mktsegment") == "HOUSEHOLD", 4)
           .otherwise(5))
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(-1))
         .otherwise((F.col("c_nationkey") % 6 + 1).cast("int")).alias("age"),
        (F.col("c_custkey") % 3).cast("int").alias("sex"),
        seg.cast("int").alias("user_lv_cd"),
    )


def f_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part", ["p_partkey", "p_retailprice", "p_type", "p_size", "p_brand"])
    cate = (F.when(F.col("p_type") == "STANDARD", 30)
            .when(F.col("p_type") == "PROMO", 101)
            .when(F.col("p_type") == "ECONOMY", 1)
            .when(F.col("p_type") == "MEDIUM", 46)
            .when(F.col("p_type") == "LARGE", 71)
            .otherwise(83))
    return p.where(F.col("p_partkey") % 50 != 49).select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_retailprice").alias("price"),
        cate.cast("int").alias("cate"),
        F.when(F.col("p_size") % 10 == 0, F.lit(-1)).otherwise(F.col("p_size")).cast("int").alias("para_1"),
        F.substring("p_brand", 7, 1 << 20).cast("int").alias("para_2"),
        F.when(F.col("p_partkey") % 4 == 0, F.lit(-1)).otherwise((F.col("p_partkey") % 9).cast("int")).alias("para_3"),
    )


def f_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"])
    s = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    return (o.join(li, li.l_orderkey == o.o_orderkey)
             .join(s, li.l_suppkey == s.s_suppkey)
             .select(F.col("o_custkey").alias("user_id"),
                     F.col("l_partkey").alias("sku_id"),
                     F.col("o_orderkey").alias("o_id"),
                     F.col("o_orderdate").alias("o_date"),
                     F.col("s_nationkey").cast("int").alias("o_area"),
                     F.col("l_quantity").cast("int").alias("o_sku_num")))


def f_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = (_read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"])
          .where(F.col("l_linenumber") == 1))
    day_shift = (F.col("o_orderkey") % 20).cast("int")
    hour_shift = ((F.col("o_orderkey") * 5 + F.col("l_partkey")) % 24).cast("int")
    tm = F.timestamp_add("HOUR", hour_shift, F.timestamp_add("DAY", day_shift, F.col("o_orderdate")))
    score = (F.when(F.col("o_orderkey") % 11 == 0, F.lit(-1))
             .when(F.col("l_returnflag") == "R", 3)
             .when(F.col("l_returnflag") == "A", 2)
             .otherwise(1))
    return (o.join(li, li.l_orderkey == o.o_orderkey)
             .select(F.col("o_custkey").alias("user_id"),
                     F.col("o_orderkey").alias("o_id"),
                     tm.alias("comment_create_tm"),
                     score.cast("int").alias("score_level")))


def f_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"]).where(F.col("o_custkey") % 10 != 3)
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_shipdate", "l_quantity", "l_returnflag"])
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("user_id"),
                      F.col("l_partkey").alias("sku_id"),
                      F.col("l_shipdate").alias("a_date"),
                      F.col("l_quantity").cast("int").alias("a_num"),
                      F.when(F.col("l_returnflag") == "R", 2).otherwise(1).cast("int").alias("a_type")))


def load_fixture_tables(spark: SparkSession, sf_dir: str, clean: bool = True) -> Tables:
    t = Tables(user=f_user(spark, sf_dir), sku=f_sku(spark, sf_dir), order=f_order(spark, sf_dir),
               comment=f_comment(spark, sf_dir), action=f_action(spark, sf_dir))
    return t.cleaned() if clean else t


# The same derivations as DuckDB SQL, used as CTEs by the oracle.
FIXTURE_SQL = """
f_user_raw AS (
 SELECT c_custkey AS user_id,
  CASE WHEN c_custkey % 7 = 0 THEN -1 ELSE CAST(c_nationkey % 6 + 1 AS INT) END AS age,
  CAST(c_custkey % 3 AS INT) AS sex,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS user_lv_cd
 FROM customer),
f_sku_raw AS (
 SELECT p_partkey AS sku_id, p_retailprice AS price,
  CASE p_type WHEN 'STANDARD' THEN 30 WHEN 'PROMO' THEN 101 WHEN 'ECONOMY' THEN 1 WHEN 'MEDIUM' THEN 46 WHEN 'LARGE' THEN 71 ELSE 83 END AS cate,
  CASE WHEN p_size % 10 = 0 THEN -1 ELSE p_size END AS para_1,
  CAST(substr(p_brand, 7) AS INT) AS para_2,
  CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE CAST(p_partkey % 9 AS INT) END AS para_3
 FROM part WHERE p_partkey % 50 <> 49),
f_order AS (
 SELECT o_custkey AS user_id, l_partkey AS sku_id, o_orderkey AS o_id, o_orderdate AS o_date,
  s_nationkey AS o_area, CAST(l_quantity AS INT) AS o_sku_num
 FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
f_comment_raw AS (
 SELECT o_custkey AS user_id, o_orderkey AS o_id,
  o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey % 20 AS INT) + INTERVAL '1' HOUR * CAST((o_orderkey * 5 + l_partkey) % 24 AS INT) AS comment_create_tm,
  CASE WHEN o_orderkey % 11 = 0 THEN -1 WHEN l_returnflag = 'R' THEN 3 WHEN l_returnflag = 'A' THEN 2 ELSE 1 END AS score_level
 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1),
f_action AS (
 SELECT o_custkey AS user_id, l_partkey AS sku_id, l_shipdate AS a_date,
  CAST(l_quantity AS INT) AS a_num, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS a_type
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 10 <> 3),
f_user AS (SELECT user_id, nullif(age, -1) AS age, sex, user_lv_cd FROM f_user_raw),
f_sku AS (SELECT sku_id, price, cate, nullif(para_1, -1) AS para_1, nullif(para_2, -1) AS para_2,
  nullif(para_3, -1) AS para_3 FROM f_sku_raw),
f_comment AS (SELECT user_id, o_id, comment_create_tm, nullif(score_level, -1) AS score_level FROM f_comment_raw)
"""
