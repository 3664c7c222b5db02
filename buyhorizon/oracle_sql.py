"""DuckDB oracle SQL for the correctness gate.

Written independently of the Spark plans: plain SQL over the fixture views
(FIXTURES §2, inlined as CTEs), one ``GROUP BY user_id`` per window with
``FILTER`` clauses and ``count(DISTINCT ...)``, ``ROW_NUMBER`` for latest /
largest rows. Only names, slices and windows come from the shared catalogue.
Feature keys cover slip 0 at the training anchor over the full user table;
integers are cast to BIGINT and doubles rounded to six places (both sides).
"""

from __future__ import annotations

import datetime as dt

from .plans.catalogue import BY_KEY, FAMILY_SOURCE, VARIANTS, FeatureRow
from .sources.fixtures import FIXTURE_SQL
from .spec import FeatureSpec

ENRICHED_SQL = """
ocus AS (
 SELECT o.user_id, o.sku_id, o.o_id, o.o_date, o.o_area, o.o_sku_num,
  c.comment_create_tm, c.score_level, s.price, s.cate, s.para_1, s.para_2, s.para_3,
  month(o.o_date) AS month_order, day(o.o_date) AS day_order, day(c.comment_create_tm) AS day_comment
 FROM f_order o LEFT JOIN f_comment c ON o.user_id = c.user_id AND o.o_id = c.o_id
 LEFT JOIN f_sku s ON o.sku_id = s.sku_id),
aus AS (
 SELECT a.user_id, a.sku_id, a.a_date, a.a_num, a.a_type, s.price, s.cate, s.para_1, s.para_2, s.para_3,
  day(a.a_date) AS day
 FROM f_action a LEFT JOIN f_sku s ON a.sku_id = s.sku_id)
"""

# Stated here once more, as literals, so that a wrong window, slice, anchor or
# tie-break order in the engine cannot pass on both sides.
WINDOWS = {"all": (30, 60, 90, 180), "recency": (60, 90, 180), "long": (180,)}
SLICES = {"1": ("all",), "2": ("all", "30_101"), "3": ("all", "30_101", "other"), "4": ("all", "30_101", "30", "101"),
          "5": ("all", "30_101", "30", "101", "other"), "targets": ("30_101", "30", "101", "other"), "classes": ("30_101", "30", "101")}
ANCHORS = {("2001-05-01", 0): "2001-05-01", ("2001-05-01", 2): "2001-02-28", ("2001-05-01", 3): "2001-01-28", ("2001-05-01", 4): "2000-12-28",
           ("2001-06-01", 0): "2001-06-01", ("2001-07-01", 0): "2001-07-01"}
LAST_ORDER = {"order": ("o_date", "o_id", "sku_id", "comment_create_tm", "score_level"),
              "comment": ("comment_create_tm", "o_date", "o_id", "sku_id", "score_level"),
              "action": ("a_date", "a_type", "sku_id", "a_num")}
LABEL_DAYS = 30
ONEHOT = {"sex": (0, 1, 2), "user_lv_cd": (1, 2, 3, 4, 5), "age": (1, 2, 3, 4, 5, 6)}


def anchor_of(anchor: dt.date, slip: int) -> dt.date:
    return dt.date.fromisoformat(ANCHORS[anchor.isoformat(), slip])


SRC_TABLE = {"order": "ocus", "comment": "ocus", "action": "aus"}
SRC_TS = {"order": "o_date", "comment": "comment_create_tm", "action": "a_date"}
DOUBLE_ATTRS = {"price"}


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE_SQL.strip() + ",\n" + ENRICHED_SQL.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body}"


def ts_lit(d: dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def gap_sql(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch({later}) - epoch({earlier})) / 86400) AS BIGINT)"


def promo_sql(ts: str, ranges) -> str:
    parts = [f"(CAST({ts} AS DATE) BETWEEN DATE '{a}' AND DATE '{b}')" for a, b in ranges]
    return "(" + " OR ".join(parts) + ")"


def slice_sql(spec: FeatureSpec, s: str) -> str:
    t = ", ".join(str(x) for x in spec.target_cates)
    if s == "all":
        return "TRUE"
    if s == "_".join(str(x) for x in spec.target_cates):
        return f"coalesce(cate IN ({t}), FALSE)"
    if s == "other":
        return f"NOT coalesce(cate IN ({t}), FALSE)"
    return f"coalesce(cate = {s}, FALSE)"


def type_sql(spec: FeatureSpec, t) -> str:
    if t is None:
        return "TRUE"
    return f"coalesce(a_type = {spec.look_type if t == 'look' else spec.star_type}, FALSE)"


def dbl(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


class OracleBuilder:
    """Builds one SELECT per feature key: per-window CTEs + final projection."""

    def __init__(self, spec: FeatureSpec, anchor: dt.date, prefix: str = ""):
        self.spec, self.anchor, self.prefix = spec, anchor, prefix
        self.ctes: dict[str, tuple[str, list[str]]] = {}   # name -> (from/where, [agg AS col])
        self.extra: list[str] = []                          # extra CTE text
        self.joins: list[str] = []
        self.outputs: list[str] = []
        self.n = 0

    def _win_cte(self, src: str, w: int) -> str:
        name = f"{self.prefix}{src[0]}w{w}"
        if name not in self.ctes:
            ts = SRC_TS[src]
            lo = self.anchor - dt.timedelta(days=w)
            hi = self.anchor - dt.timedelta(days=1)
            where = (f"FROM {SRC_TABLE[src]} WHERE {ts} >= {ts_lit(lo)} AND {ts} <= {ts_lit(hi)}")
            self.ctes[name] = (where, [])
            self.joins.append(name)
        return name

    def agg(self, src: str, w: int, expr: str) -> str:
        cte = self._win_cte(src, w)
        self.n += 1
        col = f"a{self.n}"
        self.ctes[cte][1].append(f"{expr} AS {col}")
        return f"{cte}.{col}"

    def ranked(self, src: str, w: int, pred: str, order: list[str], cols: list[str]) -> str:
        """A CTE with the first row per user under ``order`` among rows matching pred."""
        self.n += 1
        name = f"{self.prefix}r{self.n}"
        ts = SRC_TS[src]
        lo = self.anchor - dt.timedelta(days=w)
        hi = self.anchor - dt.timedelta(days=1)
        self.extra.append(
            f"{name} AS (SELECT user_id, {', '.join(cols)} FROM (SELECT *, ROW_NUMBER() OVER "
            f"(PARTITION BY user_id ORDER BY {', '.join(order)}) AS rn FROM {SRC_TABLE[src]} "
            f"WHERE {ts} >= {ts_lit(lo)} AND {ts} <= {ts_lit(hi)} AND {pred}) q WHERE rn = 1)")
        self.joins.append(name)
        return name

    def out(self, expr: str, name: str):
        self.outputs.append(f"{expr} AS \"{name}\"")

    def add(self, row: FeatureRow):
        spec, A = self.spec, self.anchor
        src = FAMILY_SOURCE[row.family]
        ts = SRC_TS[src]
        for w in WINDOWS[row.windows]:
            prefix = f"{row.family}_{w}slip_"
            for t in row.types:
                for s in SLICES[row.slices]:
                    p = f"({slice_sql(spec, s)} AND {type_sql(spec, t)})"
                    name = prefix + row.pattern.format(agg="{agg}", attr="{attr}", col=row.col, s=s)
                    rows = self.agg(src, w, f"count(*) FILTER (WHERE {p})")
                    k = row.kind
                    if k in ("agg", "gap", "delay"):
                        val = {"agg": row.col, "gap": gap_sql(ts_lit(A), row.col),
                               "delay": gap_sql("comment_create_tm", "o_date")}[k]
                        if k == "agg" and row.col == "month_order":
                            val = "month(o_date)"
                        for a in row.aggs:
                            f = {"count": "count", "sum": "sum", "mean": "avg", "min": "min", "max": "max",
                                 "std": "stddev_samp"}[a]
                            e = self.agg(src, w, f"{f}({val}) FILTER (WHERE {p})")
                            if a == "count":
                                e = f"CASE WHEN {rows} > 0 THEN {e} END"
                            if a == "sum":
                                e = f"CASE WHEN {rows} > 0 THEN coalesce({e}, 0) END"
                            self.out(dbl(e) if a in ("mean", "std") else big(e), name.format(agg=a))
                    elif k == "nunique":
                        e = self.agg(src, w, f"count(DISTINCT {row.col}) FILTER (WHERE {p})")
                        self.out(big(f"CASE WHEN {rows} > 0 THEN {e} END"), name)
                    elif k in ("share_count", "share_nunique"):
                        d = "DISTINCT " if k == "share_nunique" else ""
                        num = self.agg(src, w, f"count({d}{row.col}) FILTER (WHERE {p})")
                        den = self.agg(src, w, f"count({d}{row.col}) FILTER (WHERE {type_sql(spec, t)})")
                        self.out(dbl(f"CASE WHEN {rows} > 0 THEN {num} / {den} END"), name)
                    elif k == "last":
                        keys = list(LAST_ORDER[src]) + list(row.attrs)
                        order = [f"{x} DESC NULLS LAST" for x in keys]
                        r = self.ranked(src, w, p, order, [f"{a} AS {a}" for a in row.attrs])
                        for a in row.attrs:
                            e = f"{r}.{a}"
                            self.out(dbl(e) if a in DOUBLE_ATTRS else big(e), name.format(attr=a))
                    elif k == "last_promo":
                        mx = self.agg(src, w, f"max({ts}) FILTER (WHERE {p})")
                        self.out(big(f"CASE WHEN {mx} IS NOT NULL THEN CASE WHEN {promo_sql(mx, spec.promo_days)} "
                                      f"THEN 1 ELSE 0 END END"), name)
                    elif k == "max_measure":
                        g = gap_sql(ts_lit(A), ts)
                        r = self.ranked(src, w, p, [f"{row.col} DESC NULLS LAST", f"{ts} ASC"], [f"{g} AS g"])
                        self.out(big(f"{r}.g"), name)
                    elif k == "weekend":
                        wk = self.agg(src, w, f"count(*) FILTER (WHERE {p} AND isodow({ts}) - 1 IN (5, 6))")
                        self.out(dbl(f"CASE WHEN {wk} > 0 THEN {wk} / {rows} END"), name)
                    elif k == "poor":
                        bad = self.agg(src, w, f"count(*) FILTER (WHERE {p} AND {row.col} = {spec.poor_score})")
                        tot = self.agg(src, w, f"count({row.col}) FILTER (WHERE {p})")
                        self.out(dbl(f"CASE WHEN {bad} > 0 THEN {bad} / {tot} END"), name)
                    elif k == "promo_nunique":
                        pr = promo_sql(ts, spec.promo_days)
                        prow = self.agg(src, w, f"count(*) FILTER (WHERE {p} AND {pr})")
                        num = self.agg(src, w, f"count(DISTINCT {row.col}) FILTER (WHERE {p} AND {pr})")
                        den = self.agg(src, w, f"count(DISTINCT {row.col}) FILTER (WHERE {p})")
                        self.out(dbl(f"CASE WHEN {prow} > 0 THEN {num} / {den} END"), name)
                    elif k == "promo_sum":
                        pr = promo_sql(ts, spec.promo_days)
                        prow = self.agg(src, w, f"count(*) FILTER (WHERE {p} AND {pr})")
                        num = self.agg(src, w, f"sum({row.col}) FILTER (WHERE {p} AND {pr})")
                        den = self.agg(src, w, f"sum({row.col}) FILTER (WHERE {p})")
                        self.out(dbl(f"CASE WHEN {prow} > 0 THEN {num} / nullif({den}, 0) END"), name)
                    elif k == "conversion":
                        op = slice_sql(spec, s)
                        orows = self.agg("order", w, f"count(*) FILTER (WHERE {op})")
                        od = self.agg("order", w, f"count(DISTINCT o_id) FILTER (WHERE {op})")
                        asum = self.agg("action", w, f"coalesce(sum(a_num) FILTER (WHERE {p}), 0)")
                        self.out(dbl(f"CASE WHEN {orows} > 0 AND {rows} > 0 THEN CASE WHEN {asum} = 0 THEN 1.0 "
                                     f"ELSE least({od} / {asum}, 1.0) END END"), name)
                    else:
                        raise ValueError(k)

    def parts(self, lead: list[str] | None = None, extra_joins: list[str] | None = None) -> tuple[list[str], str]:
        ctes = [f"{n} AS (SELECT user_id, {', '.join(aggs)} {frm} GROUP BY user_id)"
                for n, (frm, aggs) in self.ctes.items()]
        cols = (lead or ["u.user_id AS user_id"]) + self.outputs
        body = "SELECT " + ", ".join(cols) + " FROM f_user u " + " ".join(
            f"LEFT JOIN {j} ON {j}.user_id = u.user_id" for j in self.joins + (extra_joins or []))
        return ctes + self.extra, body

    def sql(self) -> str:
        ctes, body = self.parts()
        return with_fixtures(body, ",\n".join(ctes))


def label_cte(spec: FeatureSpec, anchor: dt.date, name: str) -> str:
    hi = anchor + dt.timedelta(days=LABEL_DAYS)
    return (f"{name} AS (SELECT user_id, count(DISTINCT o_id) AS buy, min(o_date) AS first FROM ocus "
            f"WHERE o_date >= {ts_lit(anchor)} AND o_date <= {ts_lit(hi)} AND {slice_sql(spec, '_'.join(str(c) for c in spec.target_cates))} "
            f"GROUP BY user_id)")


def label_cols(spec: FeatureSpec, anchor: dt.date, name: str, is_training: bool = True) -> list[str]:
    t = "_".join(str(c) for c in spec.target_cates)
    if not is_training:
        return [f"CAST(-1 AS BIGINT) AS label_{t}_BuyNums", f"CAST(-1 AS BIGINT) AS label_{t}_IntervalDay"]
    return [f"CAST(coalesce({name}.buy, 0) AS BIGINT) AS label_{t}_BuyNums",
            f"CAST(coalesce({gap_sql(name + '.first', ts_lit(anchor))}, {spec.no_buy_day}) AS BIGINT) "
            f"AS label_{t}_IntervalDay"]


def onehot_cols(spec: FeatureSpec) -> list[str]:
    out = []
    for c in ("sex", "user_lv_cd", "age"):
        for v in ONEHOT[c]:
            out.append(f"CAST(CASE WHEN u.{c} = {v} THEN 1 ELSE 0 END AS BIGINT) AS {c}_{v}")
    return out


def table_sql(spec: FeatureSpec, keys, anchor: dt.date, slips, labels: bool = True, is_training: bool = True,
              onehot: bool = False, slip_col: bool = True) -> str:
    """Union over slips of spine [+ labels] + features [+ one-hot]."""
    all_ctes, bodies = [], []
    for s in slips:
        a = anchor_of(anchor, s)
        b = OracleBuilder(spec, a, prefix=f"s{s}_")
        for k in keys:
            b.add(BY_KEY[k])
        lead = ([f"CAST({s} AS BIGINT) AS slip"] if slip_col else []) + ["u.user_id AS user_id"]
        joins = []
        if labels:
            ln = f"s{s}_lab"
            if is_training:
                all_ctes.append(label_cte(spec, a, ln))
                joins.append(ln)
            lead += label_cols(spec, a, ln, is_training)
        ctes, body = b.parts(lead, joins)
        if onehot:
            body = body.replace(" FROM f_user u ", ", " + ", ".join(onehot_cols(spec)) + " FROM f_user u ", 1)
        all_ctes += ctes
        bodies.append(body)
    return with_fixtures("\nUNION ALL\n".join(bodies), ",\n".join(all_ctes))


def tables_sql(spec: FeatureSpec, keys, parts: list[tuple[str, dt.date, list[int], bool]]) -> str:
    """Several tables (name, anchor, slips, with labels) under one ``part`` column; the shared facts are made once."""
    all_ctes, bodies = [], []
    for i, (name, anchor, slips, is_training) in enumerate(parts):
        for s in slips:
            a = anchor_of(anchor, s)
            b = OracleBuilder(spec, a, prefix=f"p{i}s{s}_")
            for k in keys:
                b.add(BY_KEY[k])
            joins = []
            if is_training:
                all_ctes.append(label_cte(spec, a, f"p{i}s{s}_lab"))
                joins.append(f"p{i}s{s}_lab")
            lead = [f"'{name}' AS part", f"CAST({s} AS BIGINT) AS slip", "u.user_id AS user_id", *label_cols(spec, a, f"p{i}s{s}_lab", is_training)]
            ctes, body = b.parts(lead, joins)
            all_ctes += ctes
            bodies.append(body.replace(" FROM f_user u ", ", " + ", ".join(onehot_cols(spec)) + " FROM f_user u ", 1))
    sql = with_fixtures("\nUNION ALL\n".join(bodies), ",\n".join(all_ctes))
    for name in ("f_order", "f_action", "f_user", "f_sku", "f_comment", "ocus", "aus"):
        sql = sql.replace(f"\n{name} AS (", f"\n{name} AS MATERIALIZED (", 1)
    return sql


def feature_key_sql(spec: FeatureSpec, key: str, anchor: dt.date | None = None) -> str:
    b = OracleBuilder(spec, anchor or spec.train_anchor)
    for row in VARIANTS.get(key) or (BY_KEY[key],):
        b.add(row)
    return b.sql()
