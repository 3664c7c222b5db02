"""Fact enrichment joins (join_order_enriched, join_action_enriched, join_order_sku).

The product table is a dimension: Spark broadcasts it when its estimated size
is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both
sides (AQE may still switch to broadcast from runtime sizes, and splits a hot
product's partition with skew join). User attributes are not joined onto the
facts: no feature reads them there, they are added once on the spine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.fixtures import Tables

SKU_COLUMNS = ["price", "cate", "para_1", "para_2", "para_3"]


def join_order_sku(order: DataFrame, sku: DataFrame) -> DataFrame:
    return order.join(sku.select("sku_id", *SKU_COLUMNS), "sku_id", "left")


def join_order_enriched(t: Tables) -> DataFrame:
    """order LEFT JOIN comment (user_id, o_id) LEFT JOIN sku: one row per order
    line and matching comment (the comment join fans out and is kept so)."""
    o = t.order
    c = t.comment.select("user_id", "o_id", "comment_create_tm", "score_level")
    joined = o.join(c, ["user_id", "o_id"], "left")
    return join_order_sku(joined, t.sku).withColumns({
        "month_order": F.month("o_date"),
        "day_order": F.dayofmonth("o_date"),
        "day_comment": F.dayofmonth("comment_create_tm"),
    })


def join_action_enriched(t: Tables) -> DataFrame:
    """action LEFT JOIN sku, with the day of month of the action."""
    return (t.action.join(t.sku.select("sku_id", *SKU_COLUMNS), "sku_id", "left")
                    .withColumn("day", F.dayofmonth("a_date")))
