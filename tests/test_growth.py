"""The feature build stays compiled code over rows as wide as a user's own data, with the results of plain counting."""

import datetime as dt
import statistics

from pyspark.sql import functions as F

from buyhorizon.operators.calendar import sample_spine
from buyhorizon.operators.distinct import DistinctRequest, multi_distinct_counts
from buyhorizon.plans.facts import Facts
from buyhorizon.plans.features import build_features
from buyhorizon.sources.fixtures import Tables
from buyhorizon.spec import FIXTURE_SPEC as SPEC

A = SPEC.train_anchor
USER = "user_id long, age int, sex int, user_lv_cd int"
SKU = "sku_id long, price double, cate int, para_1 int, para_2 int, para_3 int"
ORDER = "user_id long, sku_id long, o_id long, o_date timestamp_ntz, o_area int, o_sku_num int"
COMMENT = "user_id long, o_id long, comment_create_tm timestamp_ntz, score_level int"
ACTION = "user_id long, sku_id long, a_date timestamp_ntz, a_num int, a_type int"


def day(n):
    return dt.datetime.combine(A - dt.timedelta(days=n), dt.time())


def tables(spark, orders=(), comments=(), actions=()):
    return Tables(spark.createDataFrame([(1, 2, 0, 3), (2, None, 1, 1)], USER), spark.createDataFrame([(1, 5.0, 30, 1, 2, 3), (2, 7.0, 1, 1, 2, 3)], SKU),
                  spark.createDataFrame(list(orders), ORDER), spark.createDataFrame(list(comments), COMMENT), spark.createDataFrame(list(actions), ACTION))


def features(spark, keys, **rows):
    t = tables(spark, **rows)
    return build_features(Facts(t), sample_spine(t.user.select("user_id"), SPEC, A, [0]), SPEC, A, keys=keys, slips=[0])


def test_the_build_has_no_interpreted_lambda_and_no_map(spark):
    df = features(spark, ["oc_recency", "oc_orders_nunique", "ac_look_volume", "cc_score"], orders=[(1, 1, 9, day(3), 4, 2)])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "map_from_entries" not in plan


def test_selections_are_found_where_a_user_has_only_some(spark):
    rows = [(1, 1, 9, day(3), 4, 2), (1, 2, 10, day(70), 4, 5), (1, 2, 10, day(170), 4, 7)]
    got = {r.user_id: r for r in features(spark, ["oc_quantity_sum"], orders=rows).collect()}
    assert [got[1][f"OC_{w}slip_o_sku_num_{s}_sum"] for w in (30, 60, 90, 180) for s in ("all", "30_101", "other")] == [2, 2, None, 2, 2, None, 7, 2, 5, 14, 2, 12]
    assert all(v is None for c, v in got[2].asDict().items() if c.startswith("OC_"))


def test_equal_statistics_are_kept_once(spark):
    from buyhorizon.plans.catalogue import CATALOGUE
    from buyhorizon.plans.features import COMBINE, compile_rows, slip_value
    for stats in compile_rows(SPEC, CATALOGUE)[0].stats.values():
        forms = {}
        for key, alias in stats.items():
            forms.setdefault((COMBINE[key[0]], slip_value(key)), set()).add(alias)
        assert all(len(a) == 1 for a in forms.values()) and len(forms) == len(set(stats.values()))


def test_spread_of_small_and_of_large_sums(spark):
    from buyhorizon.plans.features import FeatureCompiler
    for values in ([1, 2, 4], [7], [2**31 - 1, 1, 5, 2**30]):
        sums = (len(values), sum(values), sum(v * v for v in values))
        at = FeatureCompiler(SPEC)
        own = at._agg("std", "order", (180, "all", None), "o_sku_num")
        alias = {k[0]: a for k, a in at.c.stats["order"].items()}
        fields = ", ".join(f"'{alias[k]}', CAST({v} AS BIGINT)" for k, v in zip(("cnt", "sum", "ssq"), sums))
        got = spark.range(1).selectExpr("array(0) AS _k_order", f"array(named_struct({fields})) AS _s_order").select(F.expr(own)).first()[0]
        assert got is None if len(values) == 1 else abs(got / statistics.stdev(values) - 1) < 1e-12


def test_conditions_of_distinct_requests_are_taken_together(spark):
    df = spark.createDataFrame([(1, 10, 1, True), (1, 10, 2, False), (1, 11, 2, True), (1, None, 2, True), (2, 12, None, None)], "u long, v long, c int, p boolean")
    preds = {"all": (), "c": ("c = 2",), "p": ("p", ""), "cp": ("c = 2", "p"), "text": "c = 2 AND p"}
    got = {r.u: r for r in multi_distinct_counts(df, ["u"], [DistinctRequest(k, "v", "v", p) for k, p in preds.items()]).collect()}
    assert [got[1][k] for k in preds] == [2, 2, 2, 1, 1] and [got[2][k] for k in preds] == [1, 0, 0, 0, 0]


def test_a_day_of_added_facts_is_not_one_file_per_task(spark, tmp_path):
    from buyhorizon.plans.facts import DayFacts
    rows = [(u, 1 + u % 2, 100 * u + d, day(d), 4, 2) for u in range(1, 40) for d in range(1, 6)]
    t = tables(spark, orders=rows)
    t = Tables(t.user, t.sku, t.order.repartition(9), t.comment, t.action)
    made = DayFacts(t, str(tmp_path)).of("order", SPEC, [(0, A)])
    assert made.count() == len(rows)
    assert {len(list(p.glob("*.parquet"))) for p in (tmp_path / "order").glob("day=*")} == {1}


def test_several_tables_are_written_in_one_pass(spark, tmp_path):
    from buyhorizon.sources import io as IO
    df = spark.createDataFrame([("a", 0, 1), ("a", 2, 1), ("b", 0, 1)], "part string, slip int, user_id long")
    IO.sink_feature_table(df, str(tmp_path / "t"), by=("part", "slip"))
    assert sorted(map(tuple, IO.scan_feature_table(spark, str(tmp_path / "t/part=a")).collect())) == [(1, 0), (1, 2)]
    assert [tuple(r) for r in IO.scan_feature_table(spark, str(tmp_path / "t/part=b")).collect()] == [(1, 0)]
