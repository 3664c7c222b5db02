"""Declared schemas of the five input tables (no inference at read time)."""

from pyspark.sql import types as T

SKU = T.StructType([
    T.StructField("sku_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("cate", T.IntegerType()),
    T.StructField("para_1", T.IntegerType()),
    T.StructField("para_2", T.IntegerType()),
    T.StructField("para_3", T.IntegerType()),
])

USER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("sex", T.IntegerType()),
    T.StructField("user_lv_cd", T.IntegerType()),
])

ACTION = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("a_date", T.TimestampNTZType()),
    T.StructField("a_num", T.IntegerType()),
    T.StructField("a_type", T.IntegerType()),
])

ORDER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("o_id", T.LongType()),
    T.StructField("o_date", T.TimestampNTZType()),
    T.StructField("o_area", T.IntegerType()),
    T.StructField("o_sku_num", T.IntegerType()),
])

COMMENT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("o_id", T.LongType()),
    T.StructField("comment_create_tm", T.TimestampNTZType()),
    T.StructField("score_level", T.IntegerType()),
])

SCHEMAS = {"sku": SKU, "user": USER, "action": ACTION, "order": ORDER, "comment": COMMENT}

# date column of each dated table
DATE_COLUMN = {"action": "a_date", "order": "o_date", "comment": "comment_create_tm"}

# -1 means missing in these columns
SENTINEL_COLUMNS = {"sku": ("para_1", "para_2", "para_3"), "user": ("age",), "comment": ("score_level",)}
