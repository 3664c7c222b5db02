"""Compile catalogue rows into Spark jobs and run them for all slips.

Plan shape, per source (orders, comments, actions), on the stored, date-pruned
facts of ``plans.facts``:

1. facts are first combined per (user, day, midnight flag, category class,
   action type), before anything is copied to slips: counts, sums, sums of
   squares, minima and maxima. Whatever depends on the anchor (day gaps, promo
   and weekend days, window bounds) is a function of the day and the flag that
   tells a timestamp at midnight from one later in the day;
2. these day rows are exploded to the slips whose widest window holds them (a
   narrow Generate, no join), get their *cell* (window band, category class,
   action type) and are combined per (slip, user, cell). Both steps are
   code-generated hash aggregates with map-side partials, so a hot user is
   pre-aggregated in every task before each shuffle;
3. the cell rows (at most K per user and slip, K fixed by the spec) are
   repartitioned on (slip, user_id); each is exploded to the *selections*
   (window, slice, type) it belongs to, the statistics are combined per
   selection, and the selection rows of a user are packed into an array of the
   selection ids there are and an array of their statistics, so the joined rows
   stay narrow and are looked up by generated code;
4. each feature is a projection over its selection's statistics: mean =
   sum / count and the sample spread from (n, sum, sum of squares) in exact
   decimal arithmetic (all spread inputs are integers: day numbers, day
   gaps, quantities, scores).

Distinct counts dedupe (user, day, class, type, value) before the slips, then
use the skew-safe bitmask stage of ``operators.distinct``. Latest-row attributes
take the latest timestamp from the day rows (fixed width, hashed), join the
facts at exactly these timestamps, and compare structs of the few rows left. The
user x slip spine LEFT JOINs every side on (slip, user_id); each side is already
hash-partitioned on that key.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqlexpr as X
from ..functions.slices import slice_names
from ..operators.distinct import DistinctRequest, _agg_sql, long_rows, masked_counts
from ..spec import FeatureSpec
from .catalogue import BY_KEY, CATALOGUE, FAMILY_SOURCE, SOURCE_TS, VARIANTS, FeatureRow

KEYS = ["slip", "user_id"]
DAY_KEYS = ["user_id", "_day", "_mid", "_class", "_type"]
GAP_BITS = 21  # day gaps inside a window are < 2**21

# tie-break order of "latest row" per source (the attributes follow)
LAST_ORDER_KEYS = {
    "order": ("o_date", "o_id", "sku_id", "comment_create_tm", "score_level"),
    "comment": ("comment_create_tm", "o_date", "o_id", "sku_id", "score_level"),
    "action": ("a_date", "a_type", "sku_id", "a_num"),
}

VALUE_SQL = {"month_order": "month(o_date)", "day_order": "dayofmonth(o_date)", "day_comment": "dayofmonth(comment_create_tm)",
             "day": "dayofmonth(a_date)"}
TS_COLUMNS = ("o_date", "a_date", "comment_create_tm")
# values that follow from the day row alone
DAY_FLAGS = ("_promo", "_weekend")


def _value(col: str) -> str:
    return VALUE_SQL.get(col, col)


def _distinct_value(col: str) -> str:
    return X.micros(col) if col in TS_COLUMNS else f"CAST({_value(col)} AS BIGINT)"


def select_windows(spec: FeatureSpec, sel: str) -> list[int]:
    if sel == "all":
        return list(spec.windows)
    if sel == "recency":
        return [w for w in spec.windows if w != spec.recency_skip_window]
    if sel == "long":
        return [w for w in spec.windows if w == spec.long_window]
    raise ValueError(sel)


def _slices(spec: FeatureSpec, kind: str) -> list[str]:
    return ["all"] if kind == "1" else slice_names(spec, kind)


# ---- cells -----------------------------------------------------------------

def _n_types(src: str) -> int:
    return 3 if src == "action" else 1


def n_cells(spec: FeatureSpec, src: str) -> int:
    return len(spec.windows) * (len(spec.target_cates) + 1) * _n_types(src)


def cells(spec: FeatureSpec, src: str, w: int, s: str, t) -> list[int]:
    """Cell ids whose union is window ``w``, slice ``s`` and type ``t``."""
    wins = sorted(spec.windows)
    nc = len(spec.target_cates) + 1
    na = _n_types(src)
    targets = [str(x) for x in spec.target_cates]
    if s == "all":
        cls = list(range(nc))
    elif s == "_".join(targets):
        cls = list(range(len(targets)))
    elif s == "other":
        cls = [nc - 1]
    else:
        cls = [targets.index(s)]
    types = list(range(na)) if t is None else [{"look": 0, "star": 1}[t]]
    return [(b * nc + c) * na + a for b in range(wins.index(w) + 1) for c in cls for a in types]


def class_pred(spec: FeatureSpec, s: str) -> str:
    """A category slice as a predicate on the class number."""
    targets = [str(x) for x in spec.target_cates]
    if s == "all":
        return "true"
    if s == "_".join(targets):
        return f"_class < {len(targets)}"
    return f"_class = {len(targets) if s == 'other' else targets.index(s)}"


def type_pred(t) -> str:
    return "true" if t is None else f"_type = {({'look': 0, 'star': 1}[t])}"


def with_day_keys(df: DataFrame, src: str, spec: FeatureSpec) -> DataFrame:
    """The day of the timestamp, whether it is at midnight, the category class and the action type."""
    ts = SOURCE_TS[src]
    cclass = "CASE " + " ".join(f"WHEN cate = {int(c)} THEN {i}" for i, c in enumerate(spec.target_cates)) \
        + f" ELSE {len(spec.target_cates)} END"
    atype = (f"CASE WHEN a_type = {spec.look_type} THEN 0 WHEN a_type = {spec.star_type} THEN 1 ELSE 2 END"
             if src == "action" else "0")
    cols = {"_day": f"unix_date(to_date({ts}))", "_mid": f"{ts} = CAST(to_date({ts}) AS TIMESTAMP_NTZ)", "_class": cclass, "_type": atype}
    if src in ("order", "comment"):
        cols["_delay"] = X.day_gap("comment_create_tm", "o_date")
        cols["_poor"] = f"coalesce(score_level = {spec.poor_score}, false)"
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in cols.items()])


def day_to_slips(df: DataFrame, spec: FeatureSpec, anchors, widest: int) -> DataFrame:
    """Day rows copied to the slips whose closed window, compared at midnight, holds them.

    Adds slip, the anchor's day number ``_a``, the floored gap in days and the
    flags of the day: a timestamp after midnight is outside when its day is the
    window's last one, and its gap is one less.
    """
    held = []
    for s, a in anchors:
        row, n = f"array(named_struct('slip', {int(s)}, 'a', unix_date({X.lit_date(a)})))", f"unix_date({X.lit_date(a)})"
        held.append(f"if(_day >= {n} - {widest} AND (_day < {n} - 1 OR (_day = {n} - 1 AND _mid)), {row}, slice({row}, 1, 0))")
    # plain conditions, no lambda: they are compiled
    copied = df.selectExpr("*", f"concat({', '.join(held)}) AS _held").selectExpr(*df.columns, "explode(_held) AS _s")
    return copied.selectExpr(*df.columns, "_s.slip AS slip", "_s.a AS _a", "CAST(_s.a - _day - if(_mid, 0, 1) AS BIGINT) AS _gap",
                             f"{X.in_date_ranges('date_from_unix_date(_day)', spec.promo_days)} AS _promo",
                             "weekday(date_from_unix_date(_day)) IN (5, 6) AS _weekend")


# ---- compiled plan -----------------------------------------------------------

@dataclass
class Compiled:
    stats: dict = field(default_factory=dict)      # source -> {stat key: alias}; equal statistics share one
    struct: dict = field(default_factory=dict)     # source -> {(w, s, t): (name, attributes)} latest rows
    distinct: dict = field(default_factory=dict)   # source -> {sig: (name, DistinctRequest, w)}
    sels: dict = field(default_factory=dict)       # source -> {(w, s, t): selection id}
    outputs: list = field(default_factory=list)    # [(name, sql over pivot / helper columns)]
    _n: int = 0

    def sel(self, src: str, w: int, s: str, t) -> int:
        d = self.sels.setdefault(src, {})
        return d.setdefault((w, s, t), len(d))

    def _name(self) -> str:
        self._n += 1
        return f"_h{self._n}"

    def stat(self, src: str, key: tuple) -> str:
        d = self.stats.setdefault(src, {})
        if key not in d:
            form = (COMBINE[key[0]], slip_value(key))
            same = (a for k, a in d.items() if (COMBINE[k[0]], slip_value(k)) == form)
            d[key] = next(same, f"{src[0]}{len(d)}")
        return d[key]

    def latest(self, src: str, sel: tuple, attrs: tuple) -> str:
        d = self.struct.setdefault(src, {})
        if sel not in d:
            d[sel] = (self._name(), attrs)
        return d[sel][0]

    def distinct_count(self, source: str, w: int, col: str, pred: tuple, sig: tuple) -> str:
        """A reference into the packed distinct-count array of ``source``."""
        d = self.distinct.setdefault(source, {})
        key = (w, col) + sig
        if key not in d:
            name = self._name()
            d[key] = (name, DistinctRequest(name, col, _distinct_value(col), pred), w)
        return f"_d_{source}[{list(d).index(key)}]"


def day_stats(key: tuple) -> dict[str, str]:
    """The aggregates over fact rows that a statistic needs per day row, by name."""
    kind, col = key[0], key[1] if len(key) > 1 else None
    if kind == "rows" or col in ("_gap", "_day_of_ts", *TS_COLUMNS) or kind == "rowsif" and col in DAY_FLAGS:
        return {}
    if kind == "rowsif":
        return {f"if_{col}": f"count_if({col})"}
    fn = {"sumif": "sum", "maxenc": "max"}.get(kind, kind)
    sql = {"cnt": "count({})", "sum": "sum({})", "ssq": "sum(CAST({0} AS BIGINT) * CAST({0} AS BIGINT))", "min": "min({})", "max": "max({})"}[fn]
    return {f"{fn}_{col}": sql.format(_value(col))}


def slip_value(key: tuple) -> str:
    """A statistic of one day row in one slip, from its day aggregates."""
    kind, col = key[0], key[1] if len(key) > 1 else None
    if kind == "rows" or kind == "cnt" and col in ("_gap", *TS_COLUMNS):
        return "_n"
    if col == "_gap":
        return {"sum": "_n * _gap", "ssq": "_n * _gap * _gap", "min": "_gap", "max": "_gap"}[kind]
    if col == "_day_of_ts":
        return "_day"
    if kind == "rowsif" and col in DAY_FLAGS:
        return f"if({col}, _n, 0)"
    own = next(iter(day_stats(key)))
    if kind == "sumif":
        return f"if({key[2]}, {own}, NULL)"
    if kind == "maxenc":
        return f"CAST({own} AS BIGINT) * {1 << GAP_BITS} + _gap"
    return own


class FeatureCompiler:
    def __init__(self, spec: FeatureSpec):
        self.spec = spec
        self.c = Compiled()

    # one statistic of one selection: a single pivot column
    def _col(self, src, sel, key) -> str:
        at = f"CAST(array_position(_k_{src}, {self.c.sel(src, *sel)}) AS INT) - 1"
        return f"get(_s_{src}, {at}).{self.c.stat(src, key)}"

    def add_(self, src, sel, key) -> str:
        return f"coalesce({self._col(src, sel, key)}, 0)"

    def min_(self, src, sel, key) -> str:
        return self._col(src, sel, key)

    max_ = min_

    def _agg(self, a: str, src, ids, col: str) -> str:
        rows = self.add_(src, ids, ("rows",))
        if a == "count":
            return f"CASE WHEN {rows} > 0 THEN {self.add_(src, ids, ('cnt', col))} END"
        if a == "sum":
            return f"CASE WHEN {rows} > 0 THEN {self.add_(src, ids, ('sum', col))} END"
        if a == "min":
            return self.min_(src, ids, ("min", col))
        if a == "max":
            return self.max_(src, ids, ("max", col))
        n = self.add_(src, ids, ("cnt", col))
        s = self.add_(src, ids, ("sum", col))
        if a == "mean":
            return f"try_divide(CAST({s} AS DOUBLE), {n})"
        if a == "std":
            ss = self.add_(src, ids, ("ssq", col))
            num = f"(CAST({n} AS DECIMAL(38,0)) * {ss} - CAST({s} AS DECIMAL(38,0)) * {s})"
            # s * s <= n * ss, so below these bounds no long overflows and the decimals are not needed
            num = f"if({n} < {1 << 20} AND {ss} < {1 << 42}, CAST({n} * {ss} - {s} * {s} AS DOUBLE), CAST({num} AS DOUBLE))"
            return f"CASE WHEN {n} > 1 THEN sqrt({num} / (CAST({n} AS DOUBLE) * ({n} - 1))) END"
        raise ValueError(a)

    def _out(self, name: str, sql: str) -> str:
        self.c.outputs.append((name, sql))
        return name

    @staticmethod
    def _in_w(spec: FeatureSpec, w: int) -> str:
        # the day rows of the widest window are read; narrow each request
        return "" if w == spec.max_window else f"_day >= _a - {w}"

    def _row_pred(self, s: str, t) -> str:
        return X.and_(class_pred(self.spec, s), type_pred(t))

    # ---- compile one catalogue row -------------------------------------
    def add(self, row: FeatureRow) -> list[str]:
        spec, c = self.spec, self.c
        src = FAMILY_SOURCE[row.family]
        ts = SOURCE_TS[src]
        names = []
        for w in select_windows(spec, row.windows):
            prefix = f"{row.family}_{w}slip_"
            inw = self._in_w(spec, w)
            for t in row.types:
                for s in _slices(spec, row.slices):
                    ids = (w, s, t)
                    rows = self.add_(src, ids, ("rows",))
                    pred = self._row_pred(s, t)
                    name = prefix + row.pattern.format(agg="{agg}", attr="{attr}", col=row.col, s=s)
                    k = row.kind
                    if k in ("agg", "gap", "delay"):
                        col = {"agg": row.col, "gap": "_gap", "delay": "_delay"}[k]
                        for a in row.aggs:
                            names.append(self._out(name.format(agg=a), self._agg(a, src, ids, col)))
                    elif k == "nunique":
                        ref = c.distinct_count(src, w, row.col, (pred, inw), ("n", s, t))
                        names.append(self._out(name, f"CASE WHEN {rows} > 0 THEN coalesce({ref}, 0) END"))
                    elif k == "share_count":
                        num = self.add_(src, ids, ("cnt", row.col))
                        den = self.add_(src, (w, "all", t), ("cnt", row.col))
                        names.append(self._out(name, f"CASE WHEN {rows} > 0 THEN {X.ratio(num, den)} END"))
                    elif k == "share_nunique":
                        num = c.distinct_count(src, w, row.col, (pred, inw), ("n", s, t))
                        den = c.distinct_count(src, w, row.col, (self._row_pred("all", t), inw),
                                               ("n", "all", t))
                        names.append(self._out(name, f"CASE WHEN {rows} > 0 THEN "
                                                     f"{X.ratio(f'coalesce({num}, 0)', den)} END"))
                    elif k == "last":
                        st = c.latest(src, (w, s, t), row.attrs)
                        for a in row.attrs:
                            names.append(self._out(name.format(attr=a), f"{st}.v_{a}"))
                    elif k == "last_promo":
                        mx = self.max_(src, ids, ("max", "_day_of_ts"))
                        promo = X.in_date_ranges(f"date_from_unix_date({mx})", spec.promo_days)
                        names.append(self._out(name, f"CASE WHEN {mx} IS NOT NULL THEN CAST({promo} AS INT) END"))
                    elif k == "max_measure":
                        enc = self.max_(src, ids, ("maxenc", row.col))
                        gmax = self.max_(src, ids, ("max", "_gap"))
                        names.append(self._out(name, f"coalesce(pmod({enc}, {1 << GAP_BITS}), {gmax})"))
                    elif k == "weekend":
                        wk = self.add_(src, ids, ("rowsif", "_weekend"))
                        n = self.add_(src, ids, ("cnt", ts))
                        names.append(self._out(name, f"CASE WHEN {wk} > 0 THEN {X.ratio(wk, n)} END"))
                    elif k == "poor":
                        bad = self.add_(src, ids, ("rowsif", "_poor"))
                        n = self.add_(src, ids, ("cnt", row.col))
                        names.append(self._out(name, f"CASE WHEN {bad} > 0 THEN {X.ratio(bad, n)} END"))
                    elif k == "promo_nunique":
                        prow = self.add_(src, ids, ("rowsif", "_promo"))
                        num = c.distinct_count(src, w, row.col, (pred, "_promo", inw), ("np", s, t))
                        den = c.distinct_count(src, w, row.col, (pred, inw), ("n", s, t))
                        names.append(self._out(name, f"CASE WHEN {prow} > 0 THEN "
                                                     f"{X.ratio(f'coalesce({num}, 0)', den)} END"))
                    elif k == "promo_sum":
                        prow = self.add_(src, ids, ("rowsif", "_promo"))
                        num = self.add_(src, ids, ("sumif", row.col, "_promo"))
                        den = self.add_(src, ids, ("sum", row.col))
                        names.append(self._out(name, f"CASE WHEN {prow} > 0 THEN {X.ratio(num, den)} END"))
                    elif k == "conversion":
                        oids = (w, s, None)
                        orows = self.add_("order", oids, ("rows",))
                        od = c.distinct_count("order", w, "o_id", (class_pred(spec, s), inw),
                                              ("n", s, None))
                        asum = self.add_(src, ids, ("sum", "a_num"))
                        names.append(self._out(name, f"CASE WHEN {orows} > 0 AND {rows} > 0 THEN "
                                                     f"{X.capped_ratio(f'coalesce({od}, 0)', asum)} END"))
                    else:
                        raise ValueError(k)
        return names


def compile_rows(spec: FeatureSpec, rows) -> tuple[Compiled, list[str]]:
    fc = FeatureCompiler(spec)
    names = []
    for r in rows:
        names += fc.add(r)
    return fc.c, names


# how a statistic combines over the cells of a selection
COMBINE = {"rows": "sum", "cnt": "sum", "sum": "sum", "ssq": "sum", "rowsif": "sum", "sumif": "sum",
           "min": "min", "max": "max", "maxenc": "max"}


def _band(spec: FeatureSpec) -> str:
    wins = sorted(spec.windows)
    return "CASE " + " ".join(f"WHEN _day >= _a - {w} THEN {i}" for i, w in enumerate(wins[:-1])) + f" ELSE {len(wins) - 1} END"


def selection_table(facts: DataFrame, src: str, stats: dict, sels: dict, spec: FeatureSpec,
                    anchors) -> DataFrame:
    """Stages 1-3: day statistics, cell statistics, combined per selection,
    packed to one row per (slip, user_id)."""
    stats = {k: a for a, k in {a: k for k, a in stats.items()}.items()}
    own = {name: sql for key in stats for name, sql in day_stats(key).items()}
    days = _agg_sql(with_day_keys(facts, src, spec), DAY_KEYS, ["count(1) AS _n", *[f"{sql} AS {name}" for name, sql in own.items()]])
    cell = f"(({_band(spec)}) * {len(spec.target_cates) + 1} + _class) * {_n_types(src)} + _type"
    data = day_to_slips(days, spec, anchors, spec.max_window).selectExpr(*KEYS, f"{cell} AS _cell", *[f"{slip_value(k)} AS {a}" for k, a in stats.items()])
    per_cell = _agg_sql(data, KEYS + ["_cell"], [f"{COMBINE[k[0]]}({a}) AS {a}" for k, a in stats.items()])
    # cell id -> the selections it belongs to (a fixed, spec-sized lookup)
    member = [[] for _ in range(n_cells(spec, src))]
    for (w, s, t), sid in sels.items():
        for c in cells(spec, src, w, s, t):
            member[c].append(sid)
    lookup = "array(" + ", ".join(f"CAST(array({', '.join(map(str, m))}) AS ARRAY<INT>)" for m in member) + ")"
    aliases = [(a, COMBINE[key[0]]) for key, a in stats.items()]
    # repartitioned once on (slip, user_id): both aggregates below run on that
    # partitioning without another exchange
    per_sel = (per_cell.repartition(*KEYS)
               .selectExpr(*KEYS, f"explode(element_at({lookup}, _cell + 1)) AS _sel", *[a for a, _ in aliases])
               .groupBy(*KEYS, "_sel")
               .agg(*[F.expr(f"{fn}({a})").alias(a) for a, fn in aliases]))
    # the selections a user has (at most len(sels), fixed by the spec), in two arrays of one order
    fields = ", ".join(a for a, _ in aliases)
    return _agg_sql(per_sel, KEYS, [f"collect_list(_sel) AS _k_{src}", f"collect_list(struct({fields})) AS _s_{src}"])


def distinct_table(facts: DataFrame, src: str, reqs: dict, spec: FeatureSpec, anchors) -> DataFrame:
    """All distinct counts of a source, packed into one array per (slip, user_id)."""
    own = [r for _, r, _ in reqs.values()]
    days = long_rows(with_day_keys(facts, src, spec), own, DAY_KEYS).distinct()
    data = day_to_slips(days, spec, anchors, max(w for _, _, w in reqs.values()))
    packed = ", ".join(f"CAST({n} AS BIGINT)" for n, _, _ in reqs.values())
    return masked_counts(data, KEYS, own).selectExpr(*KEYS, f"array({packed}) AS _d_{src}")


def latest_table(facts: DataFrame, src: str, wanted: dict, spec: FeatureSpec, anchors) -> DataFrame:
    """The attributes of the latest row of each selection, as one struct each.

    The latest timestamp of a selection comes from the day rows by a hashed
    aggregate; only the fact rows at such a timestamp are compared as structs.
    """
    keyed = with_day_keys(facts, src, spec).withColumn("_at", F.expr(X.micros(SOURCE_TS[src])))
    days = keyed.groupBy(*DAY_KEYS).agg(F.max("_at").alias("_at"))
    preds = {i: X.and_(class_pred(spec, s), type_pred(t)) for i, (w, s, t) in enumerate(wanted)}
    inside = {i: X.and_(preds[i], f"_day >= _a - {w}") for i, (w, s, t) in enumerate(wanted)}
    tops = _agg_sql(day_to_slips(days, spec, anchors, max(w for w, _, _ in wanted)), KEYS, [f"max(CASE WHEN {p} THEN _at END) AS _m{i}" for i, p in inside.items()])
    tops = tops.selectExpr(*KEYS, "inline(array(" + ", ".join(f"named_struct('_req', {i}, '_at', _m{i})" for i in inside) + "))").where("_at IS NOT NULL")
    fits = " OR ".join(f"(_req = {i} AND {p})" for i, p in preds.items())
    rows = tops.join(keyed, ["user_id", "_at"]).where(fits)
    out = []
    for i, (name, attrs) in enumerate(wanted.values()):
        fields = ", ".join([f"'k_{x}', {x}" for x in LAST_ORDER_KEYS[src]] + [f"'v_{x}', {x}" for x in attrs])
        out.append(f"max(CASE WHEN _req = {i} THEN named_struct({fields}) END) AS {name}")
    return _agg_sql(rows, KEYS, out)


def run_compiled(c: Compiled, facts, spine: DataFrame, spec: FeatureSpec,
                 anchor: dt.date, slips=None, lead: list[str] | None = None) -> DataFrame:
    """Execute: every side joined onto the spine, then ``lead`` (SQL over the spine; its columns if not
    given) and the named outputs in one projection: every further step over so many columns costs planning.

    ``facts`` gives the stored facts of a source (``plans.facts.Facts``)."""
    anchors = spec.anchors(anchor, slips)
    facts.make(sorted({*c.stats, *c.struct, *c.distinct}), spec, anchors)
    sides = []
    for src, stats in sorted(c.stats.items()):
        sides.append(selection_table(facts.of(src, spec, anchors), src, stats, c.sels[src], spec, anchors))
    for src, wanted in sorted(c.struct.items()):
        sides.append(latest_table(facts.of(src, spec, anchors), src, wanted, spec, anchors))
    for src, reqs in sorted(c.distinct.items()):
        sides.append(distinct_table(facts.of(src, spec, anchors), src, reqs, spec, anchors))
    out = spine
    for side in sides:
        out = out.join(side, KEYS, "left")
    return out.selectExpr(*(spine.columns if lead is None else lead), *[f"{sql} AS `{n}`" for n, sql in c.outputs])


def build_features(facts, spine: DataFrame, spec: FeatureSpec, anchor: dt.date,
                   keys=None, slips=None) -> DataFrame:
    rows = CATALOGUE if keys is None else [r for k in keys for r in VARIANTS.get(k) or (BY_KEY[k],)]
    c, _ = compile_rows(spec, rows)
    return run_compiled(c, facts, spine, spec, anchor, slips)


def feature_names(spec: FeatureSpec, keys=None) -> list[str]:
    rows = CATALOGUE if keys is None else [BY_KEY[k] for k in keys]
    return compile_rows(spec, rows)[1]
