"""Registered queries: key -> (spark, sf_dir) -> DataFrame, and their oracles.

Every query reads the given test tables (through the fixture derivations)
and runs over whole tables; parameters are the fixture values of the spec.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import oracle_sql as O
from .operators.calendar import sample_spine
from .plans.catalogue import CATALOGUE, VARIANTS
from .plans.features import build_features
from .plans.training import facts_of
from .sources.fixtures import load_fixture_tables
from .spec import FIXTURE_SPEC

SPEC = FIXTURE_SPEC
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def normalize(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, doubles rounded to six places (the oracle does the same)."""
    out = []
    for f in df.schema.fields:
        n = f"`{f.name}`"
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(f"CAST({n} AS BIGINT) AS {n}")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            out.append(f"round(CAST({n} AS DOUBLE), 6) AS {n}")
        else:
            out.append(n)
    return df.selectExpr(*out)


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


# ---- §2.5 feature keys: user_id + that key's columns, slip 0, full spine ----

def _feature_query(key: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = load_fixture_tables(spark, sf_dir)
        spine = sample_spine(t.user.select("user_id"), SPEC, SPEC.train_anchor, [0])
        df = build_features(facts_of(t), spine, SPEC, SPEC.train_anchor, keys=[key], slips=[0])
        return normalize(df.drop("slip", "anchor"))
    return q


for _key in [r.key for r in CATALOGUE] + list(VARIANTS):
    register(_key, O.feature_key_sql(SPEC, _key))(_feature_query(_key))


# =============================================================================
# Everything else in SURVEY §2. Helpers first.
# =============================================================================

import datetime as _dt  # noqa: E402
import uuid as _uuid  # noqa: E402
from multiprocessing.pool import ThreadPool as _ThreadPool  # noqa: E402

from pyspark import inheritable_thread_target as _inheritable  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from .functions import columns as C  # noqa: E402
from .functions import sqlexpr as X  # noqa: E402
from .operators import ranking as RK  # noqa: E402
from .operators.calendar import explode_to_slips, slip_calendar  # noqa: E402
from .operators.enrich import join_action_enriched, join_order_enriched, join_order_sku  # noqa: E402
from .plans import analysis as AN  # noqa: E402
from .plans import cleaning as CL  # noqa: E402
from .plans import labels as LB  # noqa: E402
from .plans import score as SC  # noqa: E402
from .plans import training as TR  # noqa: E402
from .plans.catalogue import FAMILY_KEYS  # noqa: E402
from .plans.facts import DayFacts, Facts  # noqa: E402
from .plans.features import feature_names  # noqa: E402
from .session import input_identity, scratch_path, stored  # noqa: E402
from .sources import io as IO  # noqa: E402

A = SPEC.train_anchor
LO = A - _dt.timedelta(days=SPEC.max_window)
HI = A - _dt.timedelta(days=1)
TA = SPEC.test_anchor
BUY, DAY = "label_30_101_BuyNums", "label_30_101_IntervalDay"
TGT = "coalesce(cate IN (30, 101), FALSE)"
W = f"o_date >= {O.ts_lit(LO)} AND o_date <= {O.ts_lit(HI)}"
WA = f"a_date >= {O.ts_lit(LO)} AND a_date <= {O.ts_lit(HI)}"
WC = f"comment_create_tm >= {O.ts_lit(LO)} AND comment_create_tm <= {O.ts_lit(HI)}"


def _t(spark, sf, clean=True):
    return load_fixture_tables(spark, sf, clean)


def _in_window(df, col, lo=LO, hi=HI):
    return df.where(f"{col} >= {X.midnight_of(lo)} AND {col} <= {X.midnight_of(hi)}")


def _q(sql_body: str, ctes: str = "") -> str:
    return O.with_fixtures(sql_body, ctes)


def _reuse(key: str, source: str):
    register(key, ORACLES.get(source))(QUERIES[source])


def _promo_sql(ts, ranges):
    return O.promo_sql(ts, ranges)


# ---- §2.1 sources and sinks -------------------------------------------------

_SCANS = {
    "scan_static": ("sku", "SELECT sku_id, round(price, 6) AS price, cate, para_1, para_2, para_3 FROM f_sku_raw"),
    "scan_static_user": ("user", "SELECT user_id, age, sex, user_lv_cd FROM f_user_raw"),
    "scan_dated": ("order", "SELECT *, year(o_date) AS year, month(o_date) AS month, day(o_date) AS day FROM f_order"),
    "scan_dated_comment": ("comment", "SELECT *, year(comment_create_tm) AS year, month(comment_create_tm) AS month, day(comment_create_tm) AS day FROM f_comment_raw"),
    "scan_dated_action": ("action", "SELECT *, year(a_date) AS year, month(a_date) AS month, day(a_date) AS day FROM f_action"),
}


def _scan(key: str, table: str):
    def q(spark, sf):
        path = scratch_path(spark, f"{key}_{_uuid.uuid4().hex}")
        IO.write_csv(getattr(_t(spark, sf, clean=False), table), path)
        return normalize((IO.scan_static if key.startswith("scan_static") else IO.scan_dated)(spark, path, table))
    return q


for _k, (_table, _sql) in _SCANS.items():
    register(_k, _q(_sql))(_scan(_k, _table))

# every table's key that breaks a line here and there: one more field, and a word for a number
_BROKEN = {"sku": "sku_id", "user": "user_id", "order": "o_id", "comment": "o_id", "action": "sku_id"}


def _lines_with_broken(df: DataFrame, key: str) -> DataFrame:
    """A table's CSV lines, each made once, with the broken copies of a line behind it."""
    lines = df.select(F.col(key).alias("key"), F.to_csv(F.struct(*df.columns), {"timestampNTZFormat": IO.TIMESTAMP_FORMAT}).alias("line"))
    more = F.when(F.col("key") % 97 == 0, F.concat("line", F.lit(",more")))
    word = F.when(F.col("key") % 89 == 0, F.concat(F.lit("no-number"), F.regexp_replace("line", "^[^,]*", "")))
    return lines.select(F.explode(F.array("line", more, word)).alias("value")).where("value IS NOT NULL")


@register("scan_quarantine", _q(" UNION ALL ".join(
    f"SELECT '{name}' AS tbl, CAST(count(*) AS BIGINT) AS kept, CAST(count(*) FILTER (WHERE {key} % 97 = 0) + count(*) FILTER (WHERE {key} % 89 = 0) AS BIGINT) AS rejected FROM {src}"
    for name, key, src in (("sku", "sku_id", "f_sku_raw"), ("user", "user_id", "f_user_raw"), ("order", "o_id", "f_order"), ("comment", "o_id", "f_comment_raw"), ("action", "sku_id", "f_action")))))
def q_scan_quarantine(spark, sf):
    """Every input table as CSV with broken lines among its rows: rows read, and lines in the quarantine.

    The tables are written and parsed side by side; the quarantine is one folder, so appends to it are one after the other."""
    t, out, path = _t(spark, sf, clean=False), None, scratch_path(spark, f"quarantine_{_uuid.uuid4().hex}")

    def checked(name):
        _lines_with_broken(getattr(t, name), _BROKEN[name]).write.text(f"{path}/{name}-lines")
        return IO.scan_checked(spark, f"{path}/{name}-lines", name, header=False)

    with _ThreadPool(len(_BROKEN)) as pool:
        found = dict(zip(_BROKEN, pool.map(_inheritable(spark)(checked), _BROKEN)))
    for name, (rows, rejected) in found.items():
        IO.sink_rejected(rejected, name, f"{path}/rejected")
        part = rows.agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("kept"))
        out = part if out is None else out.unionByName(part)
    counts = IO.rejected_counts(spark, f"{path}/rejected").groupBy(F.col("table").alias("tbl")).agg(F.sum("rejected").alias("rejected"))
    return normalize(out.join(counts, "tbl", "left").select("tbl", "kept", F.coalesce("rejected", F.lit(0)).alias("rejected")))


_ALL_KEYS = [r.key for r in CATALOGUE]


@register("sink_feature_table", O.table_sql(SPEC, _ALL_KEYS, A, SPEC.slips, onehot=True))
def q_sink_feature_table(spark, sf):
    path = scratch_path(spark, f"features_{_uuid.uuid4().hex}")
    IO.sink_feature_table(TR.build_training_table(_t(spark, sf), SPEC), path)
    return normalize(IO.scan_feature_table(spark, path))


VA = SPEC.valid_anchor


@register("scan_feature_tables", O.tables_sql(SPEC, _ALL_KEYS, [("train", A, list(SPEC.slips), True), ("valid", VA, [0], False), ("test", TA, [0], False)]))
def q_scan_feature_tables(spark, sf):
    """Train, valid and test tables, built together, written as one table each and read back."""
    parts = {"train": (A, list(SPEC.slips), True), "valid": (VA, [0], False), "test": (TA, [0], False)}
    path, out = scratch_path(spark, f"features_{_uuid.uuid4().hex}"), None
    IO.sink_feature_table(TR.build_tables(_t(spark, sf), SPEC, parts), path, by=("part", "slip"))
    for name in parts:
        part = IO.scan_feature_table(spark, f"{path}/part={name}").withColumn("part", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return normalize(out)


_BASELINE_SQL = f"""
bl_o AS (SELECT user_id, count(DISTINCT o_id) AS n, max(o_date) AS last FROM ocus
  WHERE o_date >= {O.ts_lit(TA - _dt.timedelta(days=180))} AND o_date <= {O.ts_lit(TA - _dt.timedelta(days=1))}
  AND {TGT} GROUP BY user_id),
bl AS (SELECT u.user_id, CAST(coalesce(n, 0) AS DOUBLE) AS {BUY},
  coalesce(CAST(({O.gap_sql(O.ts_lit(TA), 'last')} % 31 + 31) % 31 AS DOUBLE) + 0.3, 15.0) AS {DAY}
  FROM f_user u LEFT JOIN bl_o ON bl_o.user_id = u.user_id),
topk AS (SELECT user_id, {BUY}, {DAY},
  CAST(DATE '{TA}' + CAST(trunc({DAY} + ({SPEC.day_offset})) AS INTEGER) AS DATE) AS pred_date
  FROM bl ORDER BY {BUY} DESC, user_id ASC LIMIT {SPEC.top_k}),
truth AS (SELECT user_id, min(o_date) AS o_date FROM ocus WHERE CAST(o_date AS DATE) BETWEEN DATE '{SPEC.truth_start}'
  AND DATE '{SPEC.truth_end}' AND {TGT} GROUP BY user_id),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {BUY} DESC, user_id ASC) AS idx FROM topk),
pairs AS (SELECT r.user_id, r.idx, 1.0 / (1.0 + ln(r.idx)) AS wi, day(r.pred_date) AS pred_day,
  coalesce(day(t.o_date), 0) AS real_day, CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS oi
  FROM ranked r LEFT JOIN truth t ON t.user_id = r.user_id),
scores AS (SELECT sum(oi * wi) / sum(wi) AS s1,
  coalesce(sum(CASE WHEN oi = 1 THEN 10.0 / (10.0 + pow(pred_day - real_day, 2)) END), 0)
   / (SELECT count(*) FROM truth) AS s2 FROM pairs)
"""


def _baseline(spark, sf):
    t = _t(spark, sf)
    return t, SC.baseline_predictions(t, SPEC, TA)


def _topk(spark, sf):
    t, pred = _baseline(spark, sf)
    return t, SC.topk_users(pred, SPEC, TA)


@register("sink_submission", _q("SELECT idx AS position, user_id, pred_date FROM ranked", _BASELINE_SQL))
def q_sink_submission(spark, sf):
    _, pred = _baseline(spark, sf)
    path = scratch_path(spark, f"submission_{_uuid.uuid4().hex}")
    IO.sink_submission(SC.ranked_predictions(pred, SPEC, TA), path, SPEC.top_k)
    return normalize(IO.scan_prediction(spark, path))


_FULL = f"position BIGINT, user_id BIGINT, {BUY} DOUBLE, {DAY} DOUBLE, pred_date DATE"


@register("scan_prediction", _q(
    f"SELECT ROW_NUMBER() OVER (ORDER BY {BUY} DESC, user_id ASC) AS position, user_id, round({BUY}, 6) AS {BUY}, round({DAY}, 6) AS {DAY}, "
    f"CAST(DATE '{TA}' + CAST(trunc({DAY} + ({SPEC.day_offset})) AS INTEGER) AS DATE) AS pred_date FROM bl", _BASELINE_SQL))
def q_scan_prediction(spark, sf):
    _, pred = _baseline(spark, sf)
    path = scratch_path(spark, f"predictions_{_uuid.uuid4().hex}")
    IO.sink_predictions(SC.ranked_predictions(pred, SPEC, TA), path)
    return normalize(IO.scan_prediction(spark, path, _FULL))


# ---- §2.2 projections, filters, predicates ------------------------------------

register("null_sentinel", _q("SELECT sku_id, round(price, 6) AS price, cate, para_1, para_2, para_3 FROM f_sku"))(
    lambda spark, sf: normalize(_t(spark, sf).sku))

_ORDER_ROW = "user_id, o_id, sku_id, o_date, comment_create_tm, score_level, cate"


@register("filter_window_orders", _q(f"SELECT {_ORDER_ROW} FROM ocus WHERE {W}"))
def q_filter_window_orders(spark, sf):
    return normalize(_in_window(join_order_enriched(_t(spark, sf)), "o_date").selectExpr(*_ORDER_ROW.split(", ")))


@register("filter_window_comments", _q(f"SELECT {_ORDER_ROW} FROM ocus WHERE {WC}"))
def q_filter_window_comments(spark, sf):
    return normalize(_in_window(join_order_enriched(_t(spark, sf)), "comment_create_tm")
                     .selectExpr(*_ORDER_ROW.split(", ")))


_ACTION_ROW = "user_id, sku_id, a_date, a_num, a_type, cate"


@register("filter_window_actions", _q(f"SELECT {_ACTION_ROW} FROM aus WHERE {WA}"))
def q_filter_window_actions(spark, sf):
    return normalize(_in_window(join_action_enriched(_t(spark, sf)), "a_date").selectExpr(*_ACTION_ROW.split(", ")))


_SLICES5 = ["all", "30_101", "30", "101", "other"]


@register("slice_category", _q(" UNION ALL ".join(
    f"SELECT '{s}' AS slice, count(*) AS rows, count(DISTINCT user_id) AS users FROM ocus WHERE {W} AND "
    f"{O.slice_sql(SPEC, s)}" for s in _SLICES5)))
def q_slice_category(spark, sf):
    o = _in_window(join_order_enriched(_t(spark, sf)), "o_date")
    tags = F.filter(F.array(*[F.lit(s) for s in _SLICES5]),
                    lambda x: F.coalesce(
                        (x == "all") | ((x == "30_101") & F.col("cate").isin(30, 101)) | ((x == "30") & (F.col("cate") == 30))
                        | ((x == "101") & (F.col("cate") == 101))
                        | ((x == "other") & ~F.coalesce(F.col("cate").isin(30, 101), F.lit(False))), F.lit(False)))
    return normalize(o.withColumn("slice", F.explode(tags)).groupBy("slice").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users")))


@register("slice_action_type", _q(
    f"SELECT CASE a_type WHEN {SPEC.look_type} THEN 'look' WHEN {SPEC.star_type} THEN 'star' ELSE 'other' END AS kind, "
    f"count(*) AS rows, sum(a_num) AS a_num FROM aus WHERE {WA} GROUP BY 1"))
def q_slice_action_type(spark, sf):
    a = _in_window(join_action_enriched(_t(spark, sf)), "a_date")
    kind = (F.when(F.col("a_type") == SPEC.look_type, "look").when(F.col("a_type") == SPEC.star_type, "star")
            .otherwise("other"))
    return normalize(a.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows"), F.sum("a_num").alias("a_num")))


@register("filter_promo_days", _q(f"SELECT user_id, o_id, sku_id, o_date FROM f_order WHERE "
                                  f"{_promo_sql('o_date', SPEC.promo_days)}"))
def q_filter_promo_days(spark, sf):
    o = _t(spark, sf).order
    return normalize(o.where(C.in_date_ranges(F.col("o_date"), SPEC.promo_days)).select("user_id", "o_id", "sku_id", "o_date"))


@register("filter_not_promo", _q(f"SELECT user_id, o_id, sku_id, o_date FROM f_order WHERE NOT coalesce("
                                 f"{_promo_sql('o_date', SPEC.cleaning_promo_days)}, FALSE)"))
def q_filter_not_promo(spark, sf):
    o = _t(spark, sf).order
    return normalize(o.where(~C.in_date_ranges(F.col("o_date"), SPEC.cleaning_promo_days))
                     .select("user_id", "o_id", "sku_id", "o_date"))


@register("filter_month", _q(f"SELECT o.user_id, o.o_id, o.sku_id, o.o_date, s.cate FROM f_order o LEFT JOIN f_sku s "
                             f"ON o.sku_id = s.sku_id WHERE CAST(o.o_date AS DATE) BETWEEN DATE '{SPEC.truth_start}' "
                             f"AND DATE '{SPEC.truth_end}'"))
def q_filter_month(spark, sf):
    t = _t(spark, sf)
    o = join_order_sku(t.order, t.sku).where(F.to_date("o_date").between(F.lit(SPEC.truth_start), F.lit(SPEC.truth_end)))
    return normalize(o.select("user_id", "o_id", "sku_id", "o_date", "cate"))


@register("filter_interval", _q(f"SELECT user_id, o_id, sku_id, o_date FROM f_order WHERE o_date >= "
                                f"TIMESTAMP '{SPEC.repurchase_start}' AND o_date <= TIMESTAMP '{SPEC.repurchase_end}'"))
def q_filter_interval(spark, sf):
    o = _t(spark, sf).order
    return normalize(o.where((F.col("o_date") >= F.lit(SPEC.repurchase_start)) & (F.col("o_date") <= F.lit(SPEC.repurchase_end)))
                     .select("user_id", "o_id", "sku_id", "o_date"))


_LABELS_ALL = O.table_sql(SPEC, [], A, SPEC.slips)


def _labels(spark, sf):
    t = _t(spark, sf)
    from .operators.calendar import sample_spine
    spine = sample_spine(t.user.select("user_id"), SPEC, A, list(SPEC.slips))
    return LB.attach_labels(spine, t, SPEC, A, True, list(SPEC.slips)).drop("anchor")


register("drop_columns", _LABELS_ALL)(lambda spark, sf: normalize(_labels(spark, sf)))


@register("filter_buyers_only", f"SELECT * FROM ({_LABELS_ALL}) q WHERE {DAY} < {SPEC.no_buy_day}")
def q_filter_buyers_only(spark, sf):
    return normalize(_labels(spark, sf).where(F.col(DAY) < SPEC.no_buy_day))


@register("relabel_binary", f"SELECT slip, user_id, CAST(CASE WHEN {BUY} > 0 THEN 1 ELSE 0 END AS BIGINT) AS {BUY} "
                            f"FROM ({_LABELS_ALL}) q")
def q_relabel_binary(spark, sf):
    return normalize(_labels(spark, sf).select("slip", "user_id", (F.col(BUY) > 0).cast("int").alias(BUY)))


def _feature_names_no_spark() -> list[str]:
    b = O.OracleBuilder(SPEC, A)
    for k in _ALL_KEYS:
        b.add(O.BY_KEY[k])
    return [o.rsplit(' AS "', 1)[1].rstrip('"') for o in b.outputs]


_MODEL_COLUMNS = _feature_names_no_spark() + [f"{c}_{v}" for c, codes in O.ONEHOT.items() for v in codes]


@register("select_feature_columns", f"WITH sfc AS MATERIALIZED ({O.table_sql(SPEC, _ALL_KEYS, A, SPEC.slips, onehot=True)}) "
          f"UNPIVOT (SELECT {', '.join(f'count({chr(34)}{c}{chr(34)}) AS {chr(34)}{c}{chr(34)}' for c in _MODEL_COLUMNS)} FROM sfc) "
          f"ON COLUMNS(*) INTO NAME name VALUE filled")
def q_select_feature_columns(spark, sf):
    """Each model column with the number of rows that have a value in it."""
    df = TR.build_training_table(_t(spark, sf), SPEC)
    cols = TR.feature_columns(df, SPEC)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    return normalize(counts.unpivot([], cols, "name", "filled"))


@register("rename_joined", _q(
    "SELECT o.user_id, o.o_id, o.sku_id, o.o_date, c.comment_create_tm, year(o.o_date) AS year_order, "
    "month(o.o_date) AS month_order, day(o.o_date) AS day_order, year(c.comment_create_tm) AS year_comment, "
    "month(c.comment_create_tm) AS month_comment, day(c.comment_create_tm) AS day_comment "
    "FROM f_order o LEFT JOIN f_comment c ON o.user_id = c.user_id AND o.o_id = c.o_id"))
def q_rename_joined(spark, sf):
    t = _t(spark, sf)
    o = C.with_date_parts(t.order, "o_date")
    c = C.with_date_parts(t.comment, "comment_create_tm")
    o = o.withColumnsRenamed({"year": "year_order", "month": "month_order", "day": "day_order"})
    c = c.withColumnsRenamed({"year": "year_comment", "month": "month_comment", "day": "day_comment"})
    j = o.join(c.drop("score_level"), ["user_id", "o_id"], "left")
    return normalize(j.select("user_id", "o_id", "sku_id", "o_date", "comment_create_tm", "year_order", "month_order",
                              "day_order", "year_comment", "month_comment", "day_comment"))


_reuse("rename_prefixed", "oc_last_order")


# ---- §2.3 joins --------------------------------------------------------------

_OCUS_COLS = ("user_id, sku_id, o_id, o_date, o_area, o_sku_num, comment_create_tm, score_level, price, cate, "
              "para_1, para_2, para_3")


@register("join_order_enriched", _q(f"SELECT {_OCUS_COLS.replace('price', 'round(price, 6) AS price')} FROM ocus"))
def q_join_order_enriched(spark, sf):
    return normalize(join_order_enriched(_t(spark, sf)).selectExpr(*_OCUS_COLS.split(", ")))


_AUS_COLS = "user_id, sku_id, a_date, a_num, a_type, price, cate, para_1, para_2, para_3"


@register("join_action_enriched", _q(f"SELECT {_AUS_COLS.replace('price', 'round(price, 6) AS price')} FROM aus"))
def q_join_action_enriched(spark, sf):
    return normalize(join_action_enriched(_t(spark, sf)).selectExpr(*_AUS_COLS.split(", ")))


@register("join_order_sku", _q("SELECT o.*, round(s.price, 6) AS price, s.cate, s.para_1, s.para_2, s.para_3 "
                               "FROM f_order o LEFT JOIN f_sku s ON o.sku_id = s.sku_id"))
def q_join_order_sku(spark, sf):
    t = _t(spark, sf)
    return normalize(join_order_sku(t.order, t.sku))


@register("join_feature_to_spine", O.table_sql(SPEC, [r.key for r in CATALOGUE], A, [0], labels=False, slip_col=False))
def q_join_feature_to_spine(spark, sf):
    """The three families' stored tables, bucketed on user_id, joined to the spine without an exchange."""
    name = f"families_{_uuid.uuid4().hex}"
    return normalize(TR.bucketed_families(_t(spark, sf), SPEC, scratch_path(spark, name), name, int(spark.conf.get("spark.sql.shuffle.partitions"))))


@register("join_inner_two_aggs", _q(
    f"SELECT o.user_id, o.o_id, l.a_num FROM (SELECT user_id, count(DISTINCT o_id) AS o_id FROM f_order WHERE {W} "
    f"GROUP BY user_id) o JOIN (SELECT user_id, sum(a_num) AS a_num FROM f_action WHERE {WA} AND a_type = "
    f"{SPEC.look_type} GROUP BY user_id) l ON l.user_id = o.user_id"))
def q_join_inner_two_aggs(spark, sf):
    t = _t(spark, sf)
    o = _in_window(t.order, "o_date").groupBy("user_id").agg(F.count_distinct("o_id").alias("o_id"))
    looks = (_in_window(t.action, "a_date").where(F.col("a_type") == SPEC.look_type)
             .groupBy("user_id").agg(F.sum("a_num").alias("a_num")))
    return normalize(o.join(looks, "user_id", "inner"))


_GAPV = f"""
gv_first AS (SELECT user_id, count(DISTINCT o_id) AS buy, min(o_date) AS first FROM ocus
  WHERE o_date >= {O.ts_lit(A)} AND o_date <= {O.ts_lit(A + _dt.timedelta(days=SPEC.label_window))} AND {TGT}
  GROUP BY user_id),
gv_last AS (SELECT user_id, max(a_date) AS last FROM f_action
  WHERE a_date >= {O.ts_lit(A - _dt.timedelta(days=30))} AND a_date <= {O.ts_lit(HI)} GROUP BY user_id),
gv_pos AS (SELECT u.user_id, f.buy, {O.gap_sql('f.first', 'l.last')} AS day, l.last FROM f_user u
  JOIN gv_first f ON f.user_id = u.user_id JOIN gv_last l ON l.user_id = u.user_id)
"""


@register("join_label_positive", _q(f"SELECT CAST(0 AS BIGINT) AS slip, user_id, CAST(buy AS BIGINT) AS {BUY}, "
                                    f"CAST(day AS BIGINT) AS {DAY}, last AS Sample_30_101_LastTime FROM gv_pos", _GAPV))
def q_join_label_positive(spark, sf):
    t = _t(spark, sf)
    v = LB.label_gap_variant(t, SPEC, A, 30, [0])
    return normalize(v.where(F.col("Sample_30_101_LastTime").isNotNull()))


@register("label_gap_variant", _q(
    f"SELECT CAST(0 AS BIGINT) AS slip, user_id, CAST(buy AS BIGINT) AS {BUY}, CAST(day AS BIGINT) AS {DAY}, "
    f"last AS Sample_30_101_LastTime FROM gv_pos UNION ALL SELECT 0, user_id, 0, {SPEC.no_buy_day}, NULL FROM f_user "
    f"WHERE user_id NOT IN (SELECT user_id FROM gv_pos)", _GAPV))
def q_label_gap_variant(spark, sf):
    t = _t(spark, sf)
    return normalize(LB.label_gap_variant(t, SPEC, A, 30, [0]))


_CLEAN = f"""
buyers AS (SELECT DISTINCT user_id FROM f_order),
actors AS (SELECT DISTINCT user_id FROM f_action),
noact AS (SELECT user_id FROM buyers WHERE user_id NOT IN (SELECT user_id FROM actors)),
few AS (SELECT user_id, count(DISTINCT o_id) AS o_id FROM f_order WHERE user_id IN (SELECT user_id FROM noact)
  GROUP BY user_id HAVING count(DISTINCT o_id) BETWEEN {SPEC.few_orders_min} AND {SPEC.few_orders_max}),
promo_only AS (SELECT user_id FROM f_order GROUP BY user_id
  HAVING bool_and(coalesce({_promo_sql('o_date', SPEC.cleaning_promo_days)}, FALSE))),
removed AS (SELECT user_id FROM few UNION SELECT user_id FROM promo_only)
"""

register("clean_few_orders_no_action", _q("SELECT user_id, o_id FROM few", _CLEAN))(
    lambda spark, sf: normalize(CL.clean_few_orders_no_action(_t(spark, sf), SPEC)))
register("clean_promo_only", _q("SELECT user_id FROM promo_only", _CLEAN))(
    lambda spark, sf: normalize(CL.clean_promo_only(_t(spark, sf), SPEC)))
register("clean_users_total", _q("SELECT user_id FROM removed", _CLEAN))(
    lambda spark, sf: normalize(CL.clean_users_total(_t(spark, sf), SPEC)))
_reuse("join_outer_users", "clean_users_total")
register("distinct_users", _q("SELECT user_id FROM buyers", _CLEAN))(
    lambda spark, sf: normalize(CL.distinct_users(_t(spark, sf).order)))
register("users_difference", _q("SELECT user_id FROM noact", _CLEAN))(
    lambda spark, sf: normalize(CL.buyers_without_actions(_t(spark, sf))))


@register("union_user_sets", _q(" UNION ALL ".join(
    f"SELECT user_id, o_id FROM few WHERE o_id = {n}" for n in range(SPEC.few_orders_min, SPEC.few_orders_max + 1)),
    _CLEAN))
def q_union_user_sets(spark, sf):
    few = CL.clean_few_orders_no_action(_t(spark, sf), SPEC)
    parts = [few.where(F.col("o_id") == n) for n in range(SPEC.few_orders_min, SPEC.few_orders_max + 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return normalize(out)


@register("join_semi_users", _q("SELECT user_id, o_id, sku_id, o_date FROM f_order WHERE user_id IN "
                                "(SELECT user_id FROM noact)", _CLEAN))
def q_join_semi_users(spark, sf):
    t = _t(spark, sf)
    return normalize(t.order.join(CL.buyers_without_actions(t), "user_id", "left_semi")
                     .select("user_id", "o_id", "sku_id", "o_date"))


@register("join_anti_users", _q("SELECT user_id, sku_id, a_date, a_num, a_type FROM f_action WHERE user_id NOT IN "
                                "(SELECT user_id FROM few)", _CLEAN))
def q_join_anti_users(spark, sf):
    t = _t(spark, sf)
    return normalize(CL.apply_cleaning(t.action, CL.clean_few_orders_no_action(t, SPEC)))


@register("apply_cleaning", _q(f"SELECT * FROM ({_LABELS_ALL}) q WHERE user_id NOT IN (SELECT user_id FROM removed)",
                              _CLEAN))
def q_apply_cleaning(spark, sf):
    t = _t(spark, sf)
    return normalize(CL.apply_cleaning(_labels(spark, sf), CL.clean_users_total(t, SPEC)))


@register("join_prediction_truth", _q("SELECT user_id, idx AS index, round(wi, 6) AS wi, pred_day, real_day, oi FROM pairs",
                                      _BASELINE_SQL))
def q_join_prediction_truth(spark, sf):
    t, top = _topk(spark, sf)
    p = SC.scored_pairs(top, SC.truth_first_order(t, SPEC), SPEC)
    return normalize(p.select("user_id", "index", "wi", "pred_day", "real_day", "oi"))


@register("feature_examine", _q(
    f"SELECT u.user_id, CAST(CASE WHEN f.user_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS E_first_order_on_last_action "
    f"FROM f_user u LEFT JOIN gv_last l ON l.user_id = u.user_id LEFT JOIN (SELECT user_id, min(o_date) AS o_date "
    f"FROM f_order GROUP BY user_id) f ON f.user_id = u.user_id AND f.o_date = l.last", _GAPV))
def q_feature_examine(spark, sf):
    t = _t(spark, sf)
    last = LB.label_gap_inference(t.user, t.action, SPEC, A, 30).select("user_id", "Sample_30_101_LastTime")
    first = t.order.groupBy("user_id").agg(F.min("o_date").alias("o_date"))
    hit = (last.join(first, (last.user_id == first.user_id) & (last.Sample_30_101_LastTime == first.o_date), "inner")
               .select(last.user_id))
    out = t.user.select("user_id").join(hit.withColumn("_hit", F.lit(1)), "user_id", "left")
    return normalize(out.select("user_id", C.is_null_flag(F.col("_hit")).alias("E_first_order_on_last_action")))


@register("join_slip_range", _q(" UNION ALL ".join(
    f"SELECT CAST({s} AS BIGINT) AS slip, user_id, o_id, sku_id, o_date FROM f_order WHERE o_date >= "
    f"{O.ts_lit(a - _dt.timedelta(days=SPEC.max_window))} AND o_date <= {O.ts_lit(a - _dt.timedelta(days=1))}"
    for s, a in ((s, O.anchor_of(A, s)) for s in SPEC.slips))))
def q_join_slip_range(spark, sf):
    o = _t(spark, sf).order
    e = explode_to_slips(o, "o_date", SPEC.anchors(A), -SPEC.max_window, -1)
    return normalize(e.select("slip", "user_id", "o_id", "sku_id", "o_date"))


# ---- §2.4 aggregation helpers on the 180-day slices (full user spine) -------

def _helper(spark, sf, src, aggs: dict):
    t = _t(spark, sf)
    facts = join_order_enriched(t) if src == "order" else join_action_enriched(t)
    ts = "o_date" if src == "order" else "a_date"
    g = _in_window(facts, ts).groupBy("user_id").agg(*[e.alias(n) for n, e in aggs.items()])
    return normalize(t.user.select("user_id").join(g, "user_id", "left"))


def _helper_sql(src, aggs: dict) -> str:
    tab, w = ("ocus", W) if src == "order" else ("aus", WA)
    cols = ", ".join(f"{e} AS {n}" for n, e in aggs.items())
    return _q(f"SELECT u.user_id, {', '.join('g.' + n for n in aggs)} FROM f_user u LEFT JOIN "
              f"(SELECT user_id, {cols} FROM {tab} WHERE {w} GROUP BY user_id) g ON g.user_id = u.user_id")


_HELPERS = {
    "agg_count": ("order", {"o_id_count": (lambda: F.count("o_id"), "CAST(count(o_id) AS BIGINT)")}),
    "agg_nunique": ("order", {"sku_id_nunique": (lambda: F.count_distinct("sku_id"), "CAST(count(DISTINCT sku_id) AS BIGINT)")}),
    "agg_mean": ("order", {"o_sku_num_mean": (lambda: F.avg("o_sku_num"), "round(avg(o_sku_num), 6)")}),
    "agg_sum": ("order", {"o_sku_num_sum": (lambda: F.coalesce(F.sum("o_sku_num"), F.lit(0)), "CAST(coalesce(sum(o_sku_num), 0) AS BIGINT)")}),
    "agg_max": ("order", {"price_max": (lambda: F.max("price"), "round(max(price), 6)")}),
    "agg_min": ("order", {"price_min": (lambda: F.min("price"), "round(min(price), 6)")}),
    "agg_std": ("order", {"o_sku_num_std": (lambda: F.stddev_samp("o_sku_num"), "round(stddev_samp(o_sku_num), 6)")}),
    "last_action_gap": ("action", {"a_date_gap": (lambda: C.day_gap(C.midnight(A), F.max("a_date")),
                                                  O.gap_sql(O.ts_lit(A), "max(a_date)"))}),
}
for _k, (_src, _aggs) in _HELPERS.items():
    register(_k, _helper_sql(_src, {n: v[1] for n, v in _aggs.items()}))(
        (lambda src, aggs: lambda spark, sf: _helper(spark, sf, src, {n: v[0]() for n, v in aggs.items()}))(_src, _aggs))



@register("agg_median", _helper_sql("order", {"o_sku_num_median": "round(CAST(median(o_sku_num) AS DOUBLE), 6)"}))
def q_agg_median(spark, sf):
    t = _t(spark, sf)
    m = RK.exact_median(_in_window(join_order_enriched(t), "o_date"), "user_id", "o_sku_num", "o_sku_num_median")
    return normalize(t.user.select("user_id").join(m, "user_id", "left"))


_reuse("last_event_attributes", "ac_last_action")
_reuse("share_count", "oc_orders_share_count")
_reuse("share_nunique", "oc_orders_share_nunique")
_reuse("share_promo_orders", "oc_promo_share")
_reuse("share_promo_actions", "ac_promo_share")
_reuse("last_event_on_promo", "oc_last_on_promo")


@register("op_gap", _q(f"SELECT user_id, o_id, sku_id, {O.gap_sql(O.ts_lit(A), 'o_date')} AS gap FROM f_order WHERE {W}"))
def q_op_gap(spark, sf):
    o = _in_window(_t(spark, sf).order, "o_date")
    return normalize(o.select("user_id", "o_id", "sku_id", C.day_gap(C.midnight(A), F.col("o_date")).alias("gap")))


@register("time_gap", _q(f"SELECT user_id, o_id, sku_id, {O.gap_sql('comment_create_tm', 'o_date')} AS gap "
                         f"FROM ocus WHERE {W}"))
def q_time_gap(spark, sf):
    o = _in_window(join_order_enriched(_t(spark, sf)), "o_date")
    return normalize(o.select("user_id", "o_id", "sku_id", C.day_gap(F.col("comment_create_tm"), F.col("o_date"))
                              .alias("gap")))


def _repurchase_share(o, cate):
    """feature_buy_second_rate on one category: quantity of the singleton
    (user_id, o_date, o_sku_num) rows other than the first / all quantity."""
    rows = o.where(F.col("cate") == cate).select("user_id", "o_date", "o_sku_num")
    cols = ["user_id", "o_date", "o_sku_num"]
    total = rows.groupBy("user_id").agg(F.sum("o_sku_num").alias("_all"))
    first = RK.first_per_user(rows, ["o_date"], cols)
    second = RK.rows_except_singleton(rows, first, cols).groupBy("user_id").agg(F.sum("o_sku_num").alias("_sec"))
    return total.join(second, "user_id", "left").select(
        "user_id", C.ratio(F.col("_sec"), F.col("_all")).alias(f"o_sku_num_{cate}_second_rate"))


@register("share_repurchase", _q(
    "SELECT u.user_id, " + ", ".join(f"round(r{c}.rate, 6) AS o_sku_num_{c}_second_rate" for c in SPEC.target_cates)
    + " FROM f_user u " + " ".join(f"LEFT JOIN r{c} ON r{c}.user_id = u.user_id" for c in SPEC.target_cates),
    ",\n".join(f"""
 x{c} AS (SELECT user_id, o_date, o_sku_num FROM ocus WHERE {W} AND cate = {c}),
 f{c} AS (SELECT user_id, o_date, o_sku_num FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
   ORDER BY o_date, o_sku_num) AS rn FROM x{c}) q WHERE rn = 1),
 s{c} AS (SELECT user_id, o_date, o_sku_num FROM x{c} GROUP BY user_id, o_date, o_sku_num HAVING count(*) = 1
   EXCEPT SELECT * FROM f{c}),
 r{c} AS (SELECT a.user_id, CAST(b.q AS DOUBLE) / a.q AS rate FROM (SELECT user_id, sum(o_sku_num) AS q FROM x{c}
   GROUP BY user_id) a LEFT JOIN (SELECT user_id, sum(o_sku_num) AS q FROM s{c} GROUP BY user_id) b
   ON a.user_id = b.user_id)""" for c in SPEC.target_cates)))
def q_share_repurchase(spark, sf):
    t = _t(spark, sf)
    o = _in_window(join_order_enriched(t), "o_date")
    out = t.user.select("user_id")
    for c in SPEC.target_cates:
        out = out.join(_repurchase_share(o, c), "user_id", "left")
    return normalize(out)


def _onehot(users):
    return TR.onehot_users(users, TR.onehot_vocab(users))


def _repurchase_windows_sql():
    ctes, cols, joins = [], [], []
    for w in (30, 60, 90, 180):
        inside = f"o_date >= {O.ts_lit(A - _dt.timedelta(days=w))} AND o_date <= {O.ts_lit(HI)}"
        for c in (30, 101):
            n = f"{w}_{c}"
            ctes.append(f"""
 x{n} AS (SELECT user_id, o_date, o_sku_num FROM ocus WHERE {inside} AND cate = {c}),
 f{n} AS (SELECT user_id, o_date, o_sku_num FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY o_date, o_sku_num) AS rn FROM x{n}) q WHERE rn = 1),
 s{n} AS (SELECT user_id, o_date, o_sku_num FROM x{n} GROUP BY user_id, o_date, o_sku_num HAVING count(*) = 1 EXCEPT SELECT * FROM f{n}),
 r{n} AS (SELECT a.user_id, CAST(b.q AS DOUBLE) / a.q AS rate FROM (SELECT user_id, sum(o_sku_num) AS q FROM x{n} GROUP BY user_id) a
   LEFT JOIN (SELECT user_id, sum(o_sku_num) AS q FROM s{n} GROUP BY user_id) b ON a.user_id = b.user_id)""")
            cols.append(f'round(r{n}.rate, 6) AS "OC_{w}slip_o_sku_num_{c}_second_rate"')
            joins.append(f"LEFT JOIN r{n} ON r{n}.user_id = u.user_id")
    return _q(f"SELECT u.user_id, {', '.join(cols)} FROM f_user u {' '.join(joins)}", ",".join(ctes))


@register("oc_repurchase", _repurchase_windows_sql())
def q_oc_repurchase(spark, sf):
    t = _t(spark, sf)
    o = Facts(t).of("order", SPEC, [(0, A)])
    out = t.user.select("user_id")
    for w in SPEC.windows:
        inside = _in_window(o, "o_date", A - _dt.timedelta(days=w))
        for c in SPEC.target_cates:
            share = _repurchase_share(inside, c).withColumnRenamed(f"o_sku_num_{c}_second_rate", f"OC_{w}slip_o_sku_num_{c}_second_rate")
            out = out.join(share, "user_id", "left")
    return normalize(out)


_ONEHOT_SQL = _q("SELECT u.user_id, " + ", ".join(O.onehot_cols(SPEC)) + " FROM f_user u")
register("onehot", _ONEHOT_SQL)(lambda spark, sf: normalize(_onehot(_t(spark, sf).user)))
_reuse("onehot_users", "onehot")


# ---- §2.6 labels, samples, assembly -------------------------------------------

# fixed values: the slips' bounds, written out
_CALENDAR = ((0, "2001-05-01", "2000-11-02", "2001-04-30", "2001-05-31"), (2, "2001-02-28", "2000-09-01", "2001-02-27", "2001-03-30"),
             (3, "2001-01-28", "2000-08-01", "2001-01-27", "2001-02-27"), (4, "2000-12-28", "2000-07-01", "2000-12-27", "2001-01-27"))


@register("slip_calendar", _q(" UNION ALL ".join(
    f"SELECT CAST({s} AS BIGINT) AS slip, DATE '{a}' AS anchor, DATE '{b}' AS sample_start, DATE '{c}' AS sample_end, DATE '{a}' AS label_start, "
    f"DATE '{d}' AS label_end, (SELECT count(*) FROM f_order WHERE o_date >= TIMESTAMP '{b} 00:00:00' AND o_date <= TIMESTAMP '{c} 00:00:00') AS sample_rows, "
    f"(SELECT count(*) FROM f_order WHERE o_date >= TIMESTAMP '{a} 00:00:00' AND o_date <= TIMESTAMP '{d} 00:00:00') AS label_rows"
    for s, a, b, c, d in _CALENDAR)))
def q_slip_calendar(spark, sf):
    o = _t(spark, sf).order
    cal = spark.createDataFrame(slip_calendar(SPEC, A), "slip int, anchor date, sample_start date, sample_end date, "
                                                      "label_start date, label_end date")
    s = explode_to_slips(o, "o_date", SPEC.anchors(A), -SPEC.max_window, -1).groupBy("slip").agg(
        F.count(F.lit(1)).alias("sample_rows"))
    lab = explode_to_slips(o, "o_date", SPEC.anchors(A), 0, SPEC.label_window).groupBy("slip").agg(
        F.count(F.lit(1)).alias("label_rows"))
    out = cal.join(s, "slip", "left").join(lab, "slip", "left").fillna(0, ["sample_rows", "label_rows"])
    return normalize(out)


_LAB0 = O.table_sql(SPEC, [], A, [0], slip_col=False)
register("label_buy_count", f"SELECT user_id, {BUY} FROM ({_LAB0}) q")(
    lambda spark, sf: normalize(_labels(spark, sf).where("slip = 0").select("user_id", BUY)))
register("label_first_day", f"SELECT user_id, {DAY} FROM ({_LAB0}) q")(
    lambda spark, sf: normalize(_labels(spark, sf).where("slip = 0").select("user_id", DAY)))


@register("label_inference", O.table_sql(SPEC, [], TA, [0], is_training=False))
def q_label_inference(spark, sf):
    t = _t(spark, sf)
    from .operators.calendar import sample_spine
    spine = sample_spine(t.user.select("user_id"), SPEC, TA, [0])
    return normalize(LB.attach_labels(spine, t, SPEC, TA, False, [0]).drop("anchor"))


@register("label_balance", f"SELECT slip, count(*) FILTER (WHERE {BUY} > 0) AS positives, count(*) FILTER (WHERE "
                           f"{BUY} = 0) AS negatives, round(CAST(count(*) FILTER (WHERE {BUY} = 0) AS DOUBLE) / "
                           f"nullif(count(*) FILTER (WHERE {BUY} > 0), 0), 6) AS ratio FROM ({_LABELS_ALL}) q GROUP BY slip")
def q_label_balance(spark, sf):
    return normalize(LB.label_balance(_labels(spark, sf), SPEC))


@register("label_gap_inference", _q(f"SELECT u.user_id, l.last AS Sample_30_101_LastTime, CAST(-1 AS BIGINT) AS {BUY}, "
                                    f"CAST(-1 AS BIGINT) AS {DAY} FROM f_user u LEFT JOIN gv_last l ON l.user_id = "
                                    f"u.user_id", _GAPV))
def q_label_gap_inference(spark, sf):
    t = _t(spark, sf)
    return normalize(LB.label_gap_inference(t.user, t.action, SPEC, A, 30))


@register("sample_spine", _q(" UNION ALL ".join(f"SELECT CAST({s} AS BIGINT) AS slip, user_id FROM f_user"
                                                for s in SPEC.slips)))
def q_sample_spine(spark, sf):
    from .operators.calendar import sample_spine
    return normalize(sample_spine(_t(spark, sf).user.select("user_id"), SPEC, A).select("slip", "user_id"))


for _fam, _key in (("OC", "features_orders"), ("CC", "features_comments"), ("AC", "features_actions")):
    register(_key, O.table_sql(SPEC, FAMILY_KEYS[_fam], A, [0], labels=False, slip_col=False))(
        (lambda fam: lambda spark, sf: normalize(TR.family_table(_t(spark, sf), SPEC, fam).drop("slip")))(_fam))

_STACK_KEYS = _ALL_KEYS
register("stack_slips", O.table_sql(SPEC, _STACK_KEYS, A, SPEC.slips))(
    lambda spark, sf: normalize(TR.build_table(_t(spark, sf), SPEC, A, SPEC.slips, True, _STACK_KEYS, onehot=False)
                                .drop("sex", "user_lv_cd", "age")))


@register("stack_slips_incremental", O.table_sql(SPEC, FAMILY_KEYS["CC"], A, SPEC.slips, labels=False))
def q_stack_slips_incremental(spark, sf):
    """The review family of all slips, added one by one over facts that are kept by day."""
    t = _t(spark, sf)
    facts = DayFacts(t, scratch_path(spark, f"days_{_uuid.uuid4().hex}"))
    return normalize(TR.stacked_one_by_one(t, SPEC, "CC", SPEC.slips, facts))


_NAN_NAMES = _feature_names_no_spark()


@register("nan_count", "SELECT slip, user_id, CAST(len(list_filter([" + ", ".join(f'"{n}" IS NULL' for n in _NAN_NAMES)
          + f"], lambda x: x)) AS BIGINT) AS NaNcount FROM ({O.table_sql(SPEC, _ALL_KEYS, A, SPEC.slips)}) q")
def q_nan_count(spark, sf):
    return normalize(TR.nan_count(TR.build_training_table(_t(spark, sf), SPEC), feature_names(SPEC)).select("slip", "user_id", "NaNcount"))


@register("build_training_table", O.table_sql(SPEC, [r.key for r in CATALOGUE], A, SPEC.slips, onehot=True))
def q_build_training_table(spark, sf):
    return normalize(TR.build_training_table(_t(spark, sf), SPEC))


@register("build_inference_table", O.table_sql(SPEC, [r.key for r in CATALOGUE], TA, [0], is_training=False,
                                               onehot=True))
def q_build_inference_table(spark, sf):
    return normalize(TR.build_inference_table(_t(spark, sf), SPEC))


# ---- §2.7 per-group ranking ----------------------------------------------------

register("first_per_user", _q("SELECT user_id, o_date FROM truth", _BASELINE_SQL))(
    lambda spark, sf: normalize(SC.truth_first_order(_t(spark, sf), SPEC)))
_reuse("truth_first_order", "first_per_user")


@register("last_per_user", _q(f"SELECT user_id, a_date, a_type, sku_id, a_num FROM (SELECT *, ROW_NUMBER() OVER "
                              f"(PARTITION BY user_id ORDER BY a_date DESC, a_type DESC, sku_id DESC, a_num DESC) AS rn "
                              f"FROM f_action WHERE {WA}) q WHERE rn = 1"))
def q_last_per_user(spark, sf):
    a = _in_window(_t(spark, sf).action, "a_date")
    cols = ["a_date", "a_type", "sku_id", "a_num"]
    return normalize(RK.last_per_user(a, cols, cols))


@register("max_measure_per_user", _q(f"SELECT user_id, o_date, o_sku_num FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
                                     f"user_id ORDER BY o_sku_num DESC, o_date ASC) AS rn FROM f_order WHERE {W} AND "
                                     f"o_sku_num IS NOT NULL) q WHERE rn = 1"))
def q_max_measure_per_user(spark, sf):
    o = _in_window(_t(spark, sf).order, "o_date")
    return normalize(RK.max_measure_per_user(o, "o_sku_num", "o_date", ["o_date", "o_sku_num"]))


_REP = _CLEAN.strip() + f""",
rep AS (SELECT o.user_id, o.o_date, o.o_id FROM f_order o LEFT JOIN f_sku s ON o.sku_id = s.sku_id
  WHERE {TGT} AND o.o_date >= TIMESTAMP '{SPEC.repurchase_start}' AND o.o_date <= TIMESTAMP '{SPEC.repurchase_end}'
  AND o.user_id NOT IN (SELECT user_id FROM removed)),
rep_first AS (SELECT user_id, o_date, o_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY o_date, o_id)
  AS rn FROM rep) q WHERE rn = 1),
rep_rest AS (SELECT user_id, o_date, o_id FROM rep GROUP BY user_id, o_date, o_id HAVING count(*) = 1
  EXCEPT SELECT user_id, o_date, o_id FROM rep_first),
rep_second AS (SELECT user_id, min(o_date) AS o_date FROM rep_rest GROUP BY user_id),
rep_pairs AS (SELECT f.user_id, f.o_date AS o_date_first, s.o_date AS o_date_second,
  {O.gap_sql('s.o_date', 'f.o_date')} AS time_tag FROM rep_first f JOIN rep_second s ON s.user_id = f.user_id)
"""

register("second_purchase", _q("SELECT * FROM rep_pairs", _REP))(
    lambda spark, sf: normalize(AN.repurchase_pairs(_t(spark, sf), SPEC)))
register("rows_except_singleton", _q("SELECT * FROM rep_rest", _REP))(
    lambda spark, sf: normalize(_rows_except(spark, sf)))


def _rows_except(spark, sf):
    t = _t(spark, sf)
    rows = AN.target_orders_in(t, SPEC, SPEC.repurchase_start, SPEC.repurchase_end, CL.clean_users_total(t, SPEC))
    cols = ["user_id", "o_date", "o_id"]
    return RK.rows_except_singleton(rows, RK.first_per_user(rows, ["o_date", "o_id"], cols), cols)


@register("rank_weight", _q("SELECT user_id, idx AS index, round(wi, 6) AS wi FROM pairs", _BASELINE_SQL))
def q_rank_weight(spark, sf):
    _, top = _topk(spark, sf)
    return normalize(RK.rank_weight(top, SC.rank_order(SPEC)).select("user_id", "index", "wi"))


# ---- §2.8 sort, top-k, sets ------------------------------------------------------

@register("rank_users", _q(f"SELECT user_id, ROW_NUMBER() OVER (ORDER BY {BUY} DESC, user_id ASC) AS rank FROM bl",
                           _BASELINE_SQL))
def q_rank_users(spark, sf):
    _, pred = _baseline(spark, sf)
    return normalize(RK.global_rank(pred, SC.rank_order(SPEC)).select("user_id", "rank"))


register("topk_users", _q("SELECT user_id, pred_date FROM topk", _BASELINE_SQL))(
    lambda spark, sf: normalize(_topk(spark, sf)[1].select("user_id", "pred_date")))


@register("predict_date", _q(f"SELECT user_id, CAST(DATE '{TA}' + CAST(trunc({DAY} + ({SPEC.day_offset})) AS INTEGER) "
                             f"AS DATE) AS pred_date FROM bl", _BASELINE_SQL))
def q_predict_date(spark, sf):
    _, pred = _baseline(spark, sf)
    return normalize(SC.predict_date(pred, SPEC, TA).select("user_id", "pred_date"))


_DAILY = _CLEAN.strip() + """,
daily_orders AS (SELECT CAST(o_date AS DATE) AS o_date, count(DISTINCT o_id) AS o_id_nunique FROM f_order
  WHERE user_id NOT IN (SELECT user_id FROM removed) GROUP BY 1)
"""

register("daily_order_count", _q("SELECT * FROM daily_orders", _DAILY))(
    lambda spark, sf: normalize(AN.daily_order_count(_t(spark, sf), SPEC)))
register("sort_ascending_report", _q("SELECT * FROM daily_orders ORDER BY o_id_nunique, o_date", _DAILY))(
    lambda spark, sf: normalize(AN.daily_order_count(_t(spark, sf), SPEC).orderBy("o_id_nunique", "o_date")))


@register("daily_action_volume", _q("SELECT CAST(a_date AS DATE) AS a_date, sum(a_num) AS a_num_sum FROM f_action WHERE "
                                    "user_id NOT IN (SELECT user_id FROM few) GROUP BY 1", _CLEAN))
def q_daily_action_volume(spark, sf):
    return normalize(AN.daily_action_volume(_t(spark, sf), SPEC))


# ---- §2.9 commented-out cleaning variants ----------------------------------------

_RECENT = (A - _dt.timedelta(days=89), A - _dt.timedelta(days=1))


@register("clean_no_recent_orders", _q(f"SELECT user_id FROM f_user WHERE user_id NOT IN (SELECT o.user_id FROM f_order o "
                                       f"LEFT JOIN f_sku s ON o.sku_id = s.sku_id WHERE CAST(o.o_date AS DATE) BETWEEN "
                                       f"DATE '{_RECENT[0]}' AND DATE '{_RECENT[1]}' AND {TGT})"))
def q_clean_no_recent_orders(spark, sf):
    return normalize(CL.clean_no_recent_orders(_t(spark, sf), SPEC, *_RECENT))


_LOOKERS = (40.0, 2)


@register("clean_lookers", _q(f"SELECT o.user_id FROM (SELECT user_id, count(DISTINCT o_id) AS n FROM f_order GROUP BY "
                              f"user_id) o LEFT JOIN (SELECT user_id, sum(a_num) AS a FROM f_action WHERE a_type = "
                              f"{SPEC.look_type} GROUP BY user_id) l ON l.user_id = o.user_id WHERE CAST(l.a AS DOUBLE) "
                              f"/ o.n >= {_LOOKERS[0]} AND o.n <= {_LOOKERS[1]}"))
def q_clean_lookers(spark, sf):
    return normalize(CL.clean_lookers(_t(spark, sf), SPEC, *_LOOKERS))


# a day on which a buyer made all their orders (rows at sf0.01)
_SINGLE_DAY = _dt.date(2001, 1, 5)


@register("clean_single_day", _q(f"SELECT user_id FROM f_order GROUP BY user_id HAVING bool_and(CAST(o_date AS DATE) = "
                                 f"DATE '{_SINGLE_DAY}')"))
def q_clean_single_day(spark, sf):
    return normalize(CL.clean_single_day(_t(spark, sf), _SINGLE_DAY))


# ---- §2.10 analyses ---------------------------------------------------------------

register("repurchase_gap_histogram", _q("SELECT time_tag, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM f_user), 6)"
                                        " AS user_count FROM rep_pairs GROUP BY time_tag", _REP))(
    lambda spark, sf: normalize(AN.repurchase_gap_histogram(_t(spark, sf), SPEC)))

_DAILY_BOTH = _DAILY.strip() + """,
daily_actions AS (SELECT CAST(a_date AS DATE) AS a_date, sum(a_num) AS a_num_sum FROM f_action WHERE user_id NOT IN (SELECT user_id FROM few) GROUP BY 1)
"""


def _bins_sql(source, table, day, value, lo, hi):
    return (f"SELECT '{source}' AS source, d.day, CAST(v.{value} AS BIGINT) AS value, CASE WHEN v.{value} IS NULL THEN NULL ELSE CAST(least(greatest("
            f"floor((v.{value} - {lo}) / (({hi} - {lo}) / 20)) + 1, 1), 20) AS BIGINT) END AS bin FROM (SELECT CAST(unnest(generate_series("
            f"DATE '{SPEC.calendar_start}', DATE '{SPEC.calendar_end}', INTERVAL 1 DAY)) AS DATE) AS day) d LEFT JOIN {table} v ON v.{day} = d.day")


@register("calendar_bins", _q(_bins_sql("orders", "daily_orders", "o_date", "o_id_nunique", 200.0, 6000.0) + " UNION ALL "
                              + _bins_sql("actions", "daily_actions", "a_date", "a_num_sum", 11000.0, 200000.0), _DAILY_BOTH))
def q_calendar_bins(spark, sf):
    t, out = _t(spark, sf), []
    for source, daily, day, value, (lo, hi) in (("orders", AN.daily_order_count(t, SPEC), "o_date", "o_id_nunique", SPEC.calendar_order_range),
                                                ("actions", AN.daily_action_volume(t, SPEC), "a_date", "a_num_sum", SPEC.calendar_action_range)):
        bins = AN.calendar_bins(daily, day, value, SPEC.calendar_start, SPEC.calendar_end, lo, hi, SPEC.calendar_bins)
        out.append(bins.select(F.lit(source).alias("source"), F.col(day).alias("day"), F.col(value).cast("long").alias("value"), "bin"))
    return normalize(out[0].unionByName(out[1]))


@register("cohort_counts", _q(
    "SELECT cohort, count(*) AS users FROM (SELECT DISTINCT user_id, 'first_buyers' AS cohort FROM rep "
    "UNION ALL SELECT user_id, 'repeat_buyers' FROM rep_pairs "
    "UNION ALL SELECT user_id, 'no_action_orders_' || CAST(o_id AS VARCHAR) FROM few "
    "UNION ALL SELECT user_id, 'no_action_few_orders' FROM few "
    "UNION ALL SELECT user_id, 'promo_only' FROM promo_only "
    "UNION ALL SELECT user_id, 'removed_total' FROM removed) q GROUP BY cohort", _REP))
def q_cohort_counts(spark, sf):
    return normalize(AN.cohort_counts(_t(spark, sf), SPEC))


register("monthly_buyers", _q("SELECT month(o_date) AS month, count(DISTINCT user_id) AS buyers FROM f_order GROUP BY 1"))(
    lambda spark, sf: normalize(AN.monthly_buyers(_t(spark, sf))))
_MONTHS = (1, 2, 3, 11, 12)
register("buyers_in_months", _q(f"SELECT count(DISTINCT user_id) AS buyers FROM f_order WHERE month(o_date) IN "
                                f"({', '.join(map(str, _MONTHS))})"))(
    lambda spark, sf: normalize(AN.buyers_in_months(_t(spark, sf), _MONTHS)))


# ---- §2.12 scoring -------------------------------------------------------------------

def _score(spark, sf):
    t, top = _topk(spark, sf)
    return SC.score(top, SC.truth_first_order(t, SPEC), SPEC)


register("score_s1", _q("SELECT round(s1, 6) AS s1 FROM scores", _BASELINE_SQL))(
    lambda spark, sf: normalize(_score(spark, sf).select("s1")))
register("score_s2", _q("SELECT round(s2, 6) AS s2 FROM scores", _BASELINE_SQL))(
    lambda spark, sf: normalize(_score(spark, sf).select("s2")))
register("score_total", _q("SELECT round(s1, 6) AS s1, round(s2, 6) AS s2, round(0.4 * s1 + 0.6 * s2, 6) AS s "
                           "FROM scores", _BASELINE_SQL))(lambda spark, sf: normalize(_score(spark, sf)))


# ---- §2.13 scalar functions (per row over the whole order / action tables) ---------

_FN = {
    "fn_date_parts": ("f_order", ["user_id", "o_id", "sku_id"],
                      {"year": (lambda: F.year("o_date"), "year(o_date)"), "month": (lambda: F.month("o_date"), "month(o_date)"),
                       "day": (lambda: F.dayofmonth("o_date"), "day(o_date)")}),
    "fn_weekday": ("f_order", ["user_id", "o_id", "sku_id"],
                   {"weekday": (lambda: F.weekday("o_date"), "isodow(o_date) - 1")}),
    "fn_date_arith": ("f_order", ["user_id", "o_id", "sku_id"],
                      {"plus_31": (lambda: F.date_add(F.to_date("o_date"), 31), "CAST(CAST(o_date AS DATE) + 31 AS DATE)"),
                       "minus_31": (lambda: F.date_sub(F.to_date("o_date"), 31), "CAST(CAST(o_date AS DATE) - 31 AS DATE)")}),
    "fn_day_diff": ("f_comment", ["user_id", "o_id"],
                    {"gap": (lambda: C.day_gap(C.midnight(A), F.col("comment_create_tm")),
                             O.gap_sql(O.ts_lit(A), "comment_create_tm"))}),
    "fn_ratio": ("f_order", ["user_id", "o_id", "sku_id"],
                 {"ratio": (lambda: C.ratio(F.col("o_area"), F.col("o_sku_num") - 1),
                            "round(CAST(o_area AS DOUBLE) / nullif(o_sku_num - 1, 0), 6)")}),
    "fn_cap": ("f_order", ["user_id", "o_id", "sku_id"],
               {"capped": (lambda: F.least(F.col("o_area") / F.lit(10.0), F.lit(1.0)), "round(least(o_area / 10.0, 1.0), 6)")}),
    "fn_log_square": ("f_order", ["user_id", "o_id", "sku_id"],
                      {"ln_qty": (lambda: F.log(F.col("o_sku_num").cast("double")), "round(ln(o_sku_num), 6)"),
                       "sq_qty": (lambda: F.pow(F.col("o_sku_num"), 2), "round(pow(o_sku_num, 2), 6)")}),
    "fn_fill": ("f_comment", ["user_id", "o_id", "comment_create_tm"],
                {"score_filled": (lambda: F.coalesce(F.col("score_level"), F.lit(0)), "coalesce(score_level, 0)")}),
    "fn_is_null_flag": ("f_comment", ["user_id", "o_id", "comment_create_tm"],
                        {"has_score": (lambda: C.is_null_flag(F.col("score_level")),
                                       "CASE WHEN score_level IS NOT NULL THEN 1 ELSE 0 END")}),
    "fn_membership": ("f_order", ["user_id", "o_id", "sku_id"],
                      {"on_promo": (lambda: C.in_date_ranges(F.col("o_date"), SPEC.promo_days).cast("int"),
                                    f"CASE WHEN {_promo_sql('o_date', SPEC.promo_days)} THEN 1 ELSE 0 END")}),
}


def _fn_query(tab, keys, exprs):
    def q(spark, sf):
        t = _t(spark, sf)
        df = {"f_order": t.order, "f_comment": t.comment}[tab]
        return normalize(df.select(*keys, *[e().alias(n) for n, (e, _) in exprs.items()]))
    return q


for _k, (_tab, _keys, _exprs) in _FN.items():
    _sel = ", ".join(_keys + [f"{sql} AS {n}" for n, (_, sql) in _exprs.items()])
    register(_k, _q(f"SELECT {_sel} FROM {_tab}"))(_fn_query(_tab, _keys, _exprs))


@register("fn_date_range", _q(f"SELECT d.day, count(o.o_id) AS orders FROM (SELECT CAST(unnest(generate_series(DATE "
                              f"'{SPEC.promo_days[0][0]}', DATE '{SPEC.promo_days[0][1]}', INTERVAL 1 DAY)) AS DATE) AS day) d "
                              f"LEFT JOIN f_order o ON CAST(o.o_date AS DATE) = d.day GROUP BY d.day"))
def q_fn_date_range(spark, sf):
    o = _t(spark, sf).order
    days = spark.range(1).select(F.explode(F.sequence(F.lit(SPEC.promo_days[0][0]), F.lit(SPEC.promo_days[0][1])))
                                 .alias("day"))
    j = days.join(o.select(F.to_date("o_date").alias("day"), "o_id"), "day", "left")
    return normalize(j.groupBy("day").agg(F.count("o_id").alias("orders")))


# ---- §2.11 training and prediction on MLlib (rows-only checks, except splits) ------

import math as _math  # noqa: E402

from .plans import model as ML  # noqa: E402
from .plans import predict as PR  # noqa: E402

_ML_PARAMS = ML.BoostParams()
# fixed values: the leaves of the binary variant, and the grids' parameters
_BINARY = ML.BoostParams(num_leaves=31)
_CV_PARAMS = ML.BoostParams(num_leaves=20, seed=2018, early_stopping_rounds=30)
# stored tables and fits of this application, so that keys of one run share them; each key also runs alone
_MEMO: dict = {}


def _hex_threshold(frac: float) -> str:
    return format(_math.ceil(frac * 16 ** 8), "08x")


def _md5_sql(seed) -> str:
    return f"substr(md5(concat_ws('|', CAST(slip AS VARCHAR), CAST(user_id AS VARCHAR), '{seed}')), 1, 8)"


@register("holdout_split", f"SELECT slip, user_id, CAST(CASE WHEN {_md5_sql(0)} < '{_hex_threshold(0.33)}' THEN 1 ELSE 0 "
                           f"END AS BIGINT) AS is_test FROM ({_LABELS_ALL}) q")
def q_holdout_split(spark, sf):
    tr, te = ML.holdout_split(_labels(spark, sf), 0.33, 0)
    return normalize(tr.select("slip", "user_id", F.lit(0).alias("is_test"))
                     .unionByName(te.select("slip", "user_id", F.lit(1).alias("is_test"))))


@register("stratified_folds", f"SELECT slip, user_id, {BUY}, CAST(ROW_NUMBER() OVER (ORDER BY {BUY}, {_md5_sql(1)}, slip, "
                              f"user_id) % 5 AS BIGINT) AS fold FROM ({_LABELS_ALL}) q")
def q_stratified_folds(spark, sf):
    return normalize(ML.stratified_folds(_labels(spark, sf), BUY, 5, 1).select("slip", "user_id", BUY, "fold"))


def _once(spark, key: tuple, make):
    key = (spark.sparkContext.applicationId, *key)
    if key not in _MEMO:
        _MEMO[key] = make()
    return _MEMO[key]


# the given tables that the fixtures are derived from
_INPUTS = ("customer", "part", "supplier", "orders", "lineitem")


def _matrices(spark, sf) -> PR.Matrices:
    return _once(spark, ("matrices", sf), lambda: PR.matrices(_t(spark, sf), SPEC, input_identity([spark.read.parquet(f"{sf}/{n}.parquet") for n in _INPUTS])))


def _models(spark, sf):
    return _once(spark, ("models", sf), lambda: PR.fit_models(_matrices(spark, sf), SPEC, _ML_PARAMS))


def _count_stack(spark, sf):
    """The count model's stack alone, and its out-of-fold rows."""
    def make():
        m = _matrices(spark, sf)
        model = ML.StackedBaggedGBT(BUY, m.binned(_ML_PARAMS.max_bin)[0], _ML_PARAMS)
        return model, model.out_of_fold(m.rows("train"))
    return _once(spark, ("stack", sf), make)


@register("oof_stack_feature")
def q_oof_stack_feature(spark, sf):
    return _count_stack(spark, sf)[1].select("slip", "user_id", BUY, "fold", "stack_pred")


@register("stack_inference_feature")
def q_stack_inference_feature(spark, sf):
    return _count_stack(spark, sf)[0].stack_inference(_matrices(spark, sf).rows("test")).select("user_id", "stack_pred")


@register("bagging_ensemble")
def q_bagging_ensemble(spark, sf):
    """Each bag's own prediction and their mean."""
    model = _models(spark, sf)[0]
    bags = [F.col(f"bag_{i}") for i in range(len(model.bag_models))]
    return model.each_bag(_matrices(spark, sf).rows("test")).select("user_id", *bags, (sum(bags[1:], bags[0]) / float(len(bags))).alias(BUY))


def _both_parts(spark, sf, which: int, label: str):
    """A model's predictions of the validation and the test table."""
    m, model = _matrices(spark, sf), _models(spark, sf)[which]
    parts = [model.predict(m.rows(part).drop(BUY, DAY), label).select(F.lit(part).alias("part"), "user_id", label) for part in ("valid", "test")]
    return parts[0].unionByName(parts[1])


register("train_buy_count")(lambda spark, sf: _both_parts(spark, sf, 0, BUY))
register("train_first_day")(lambda spark, sf: _both_parts(spark, sf, 1, DAY))


@register("train_buy_binary")
def q_train_buy_binary(spark, sf):
    """The binary variant through the same stack and bags."""
    m = _matrices(spark, sf)
    model = _once(spark, ("binary", sf), lambda: ML.StackedBaggedGBT(BUY, m.binned(_BINARY.max_bin)[0], _BINARY, binary=True).fit(m.rows("train")))
    return model.predict(m.rows("test").drop(BUY, DAY), "p_buy").select("user_id", "p_buy")


@register("feature_importance")
def q_feature_importance(spark, sf):
    """Split counts and gains per stacking fold, from the written node table."""
    return _count_stack(spark, sf)[0].importances()


def _scores(spark, sf, which: int, metric: str):
    """The score of each bag on its holdout, and their mean."""
    scores = _models(spark, sf)[which].scores
    rows = [(str(i), metric, float(v)) for i, v in enumerate(scores)] + [("mean", metric, float(sum(scores) / len(scores)))]
    return spark.createDataFrame(rows, "bag string, metric string, value double")


register("metric_auc")(lambda spark, sf: _scores(spark, sf, 0, "auc"))
register("metric_l2")(lambda spark, sf: _scores(spark, sf, 1, "l2"))

# the metrics themselves, exactly, on the hand-made predictions of the test month
_METRIC_SQL = f"""
mt AS (SELECT bl.{BUY} AS p, coalesce(l.buy, 0) AS y FROM bl LEFT JOIN (SELECT user_id, count(DISTINCT o_id) AS buy FROM ocus
  WHERE o_date >= TIMESTAMP '2001-07-01 00:00:00' AND o_date <= TIMESTAMP '2001-07-31 00:00:00' AND {TGT} GROUP BY user_id) l ON l.user_id = bl.user_id),
rk AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM mt)
"""


def _baseline_scored(spark, sf):
    t, pred = _baseline(spark, sf)
    truth = LB.label_aggregates(t, SPEC, TA, [0]).select("user_id", F.col(BUY).alias("y"))
    return pred.join(truth, "user_id", "left").select(F.col(BUY).alias("prediction"), F.coalesce("y", F.lit(0)).cast("double").alias("y"))


register("metric_auc_exact", _q("SELECT round((sum(CASE WHEN y > 0 THEN r END) - count(*) FILTER (WHERE y > 0) * (count(*) FILTER (WHERE y > 0) + 1) / 2.0) / "
         "(count(*) FILTER (WHERE y > 0) * count(*) FILTER (WHERE y = 0)), 6) AS auc FROM rk", _BASELINE_SQL.strip() + "," + _METRIC_SQL))(
    lambda spark, sf: spark.createDataFrame([(round(ML.metric_auc(_baseline_scored(spark, sf), "y"), 6),)], "auc double"))
register("metric_l2_exact", _q("SELECT round(avg((p - y) * (p - y)), 6) AS l2 FROM mt", _BASELINE_SQL.strip() + "," + _METRIC_SQL))(
    lambda spark, sf: spark.createDataFrame([(round(ML.metric_l2(_baseline_scored(spark, sf), "y"), 6),)], "l2 double"))


@register("predict_submit_score")
def q_predict_submit_score(spark, sf):
    """The whole prediction job: models, ranked lists, submission files, scores from the files."""
    return PR.predict_submit_score(_t(spark, sf), _matrices(spark, sf), _models(spark, sf), SPEC, f"submit_{_uuid.uuid4().hex}")


# fixed values: the reference's grid of leaves and depths, the first-day label's own leaves, its sampling shares and draws
_LEAVES, _DEPTHS = range(20, 200, 10), range(3, 8)
_DAY_LEAVES, _SHARES, _DRAWS = range(20, 100, 5), (0.6, 0.7, 0.8, 0.9, 1.0), range(0, 20, 5)
# some of the reference's 51 x 38 values of bins and leaf size
_BINS, _LEAF_ROWS = (16, 32, 64), (10, 20, 50)


def _grid_rows(spark, sf, target: str, max_bin: int):
    """Rows and label of a search: for the count label the rows outside a 0.2 holdout, for the first-day label the buyers."""
    train = _matrices(spark, sf).rows("train", max_bin)
    return (ML.holdout_split(train, 0.2, 0)[0], F.col(BUY)) if target == "count" else (train.where(F.col(DAY) < SPEC.no_buy_day), F.col(DAY))


def _searched(spark, sf, target: str, points: list[dict]) -> list[float]:
    """The error of every point; points with the same bins in one search."""
    out: dict[int, float] = {}
    for max_bin in sorted({p.get("max_bin", _CV_PARAMS.max_bin) for p in points}):
        at = [i for i, p in enumerate(points) if p.get("max_bin", _CV_PARAMS.max_bin) == max_bin]
        rows, label = _grid_rows(spark, sf, target, max_bin)
        found = ML.grid_search_cv(rows, _matrices(spark, sf).binned(max_bin)[0], label, _CV_PARAMS, [points[i] for i in at])
        out |= {i: v for i, (_, v) in zip(at, found, strict=True)}
    return [out[i] for i in range(len(points))]


def _grid(spark, sf):
    """Every (leaves, depth) of the grid for the count label, on the rows outside a 0.2 holdout."""
    def make():
        pairs = [(n, d) for n in _LEAVES for d in _DEPTHS]
        found = _searched(spark, sf, "count", [{"num_leaves": n, "max_depth": d} for n, d in pairs])
        return [(n, d, v) for (n, d), v in zip(pairs, found, strict=True)]
    return spark.createDataFrame(_once(spark, ("grid", sf), make), "num_leaves int, max_depth int, mse double")


def _more_points() -> list[tuple[str, str, dict]]:
    """(target, point, parameters): leaves and depths of the first-day label, then bins, leaf size and sampling of either label."""
    out = [("first_day", f"num_leaves={n} max_depth={d}", {"num_leaves": n, "max_depth": d}) for n in _DAY_LEAVES for d in _DEPTHS]
    later = [{"max_bin": b, "min_data_in_leaf": n} for b in _BINS for n in _LEAF_ROWS]
    later += [{"bagging_fraction": r, "bagging_freq": k, "feature_fraction": f} for f in _SHARES for r in _SHARES for k in _DRAWS]
    return out + [(target, " ".join(f"{k}={v}" for k, v in p.items()), p) for target in ("count", "first_day") for p in later]


def _grid_more(spark, sf):
    """The later grids: the first-day label's leaves and depths, and bins, leaf size and sampling of both labels."""
    def make():
        out = []
        for target in ("count", "first_day"):
            points = [(name, p) for t, name, p in _more_points() if t == target]
            out += [(target, name, v) for (name, _), v in zip(points, _searched(spark, sf, target, [p for _, p in points]), strict=True)]
        return out
    return spark.createDataFrame(_once(spark, ("more", sf), make), "target string, point string, mse double")


register("grid_search_cv")(_grid)
register("grid_search_more")(_grid_more)


@register("sink_tuning_result")
def q_sink_tuning_result(spark, sf):
    """The best point of the first search and of the later one per label, appended one after the other and read back."""
    path = scratch_path(spark, f"tuning_{_uuid.uuid4().hex}")
    best = _grid(spark, sf).orderBy("mse", "num_leaves", "max_depth").limit(1)
    IO.sink_tuning_result(best.selectExpr("'count' AS target", "concat('num_leaves=', num_leaves, ' max_depth=', max_depth) AS point", "mse"), path)
    for target in ("count", "first_day"):
        IO.sink_tuning_result(_grid_more(spark, sf).where(F.col("target") == target).orderBy("mse", "point").limit(1), path)
    return spark.read.parquet(path)
