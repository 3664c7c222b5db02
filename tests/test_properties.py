"""Properties of the feature table and the operators (SURVEY §5 (3))."""

import datetime as dt
import random

from pyspark.sql import functions as F

from buyhorizon.operators.distinct import DistinctRequest, multi_distinct_counts
from buyhorizon.plans.catalogue import CATALOGUE
from buyhorizon.plans.features import feature_names
from buyhorizon.plans.training import build_training_table
from buyhorizon.sources.fixtures import Tables, load_fixture_tables
from buyhorizon.spec import FIXTURE_SPEC as SPEC

SF = "/root/testdata/sf0.001"


def test_column_counts_match_the_catalogue(spark):
    for fam, n in (("OC", 290), ("CC", 122), ("AC", 332)):
        assert len(feature_names(SPEC, [r.key for r in CATALOGUE if r.family == fam])) == n


def test_multi_distinct_matches_count_distinct(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(1, 5), rnd.randint(1, 30), rnd.choice([None, 1, 2, 3])) for _ in range(600)]
    df = spark.createDataFrame(rows, "user_id long, v long, c int")
    preds = {"all": "true", "c1": "c = 1", "c23": "c IN (2, 3)"}
    reqs = [DistinctRequest(f"n_{k}", "v", "v", p) for k, p in preds.items()]
    got = {r["user_id"]: r.asDict() for r in multi_distinct_counts(df, ["user_id"], reqs).collect()}
    for k, p in preds.items():
        exp = {r["user_id"]: r["n"] for r in df.where(p).groupBy("user_id").agg(F.count_distinct("v").alias("n")).collect()}
        for u, n in exp.items():
            assert got[u][f"n_{k}"] == n


def test_training_table_properties(spark):
    t = load_fixture_tables(spark, SF)
    df = build_training_table(t, SPEC).cache()
    n_users = t.user.count()
    assert df.count() == n_users * len(SPEC.slips)
    assert df.select("slip", "user_id").distinct().count() == df.count()
    # all >= every slice, shares in [0, 1]
    bad = df.where(
        (F.col("OC_90slip_o_id_all_count") < F.col("OC_90slip_o_id_30_101_count"))
        | (F.col("OC_180slip_o_id_rate_count_other") > 1) | (F.col("OC_180slip_o_id_rate_count_other") < 0)
        | (F.col("AC_60slip_a_num_all_sum") < F.col("AC_60slip_a_num_30_101_sum"))).count()
    assert bad == 0


def test_rows_outside_window_change_nothing(spark):
    """Facts shifted just past the window bounds must not reach a feature."""
    t = load_fixture_tables(spark, SF)
    keys = ["oc_orders_count", "ac_volume", "cc_score"]
    base = build_training_table(t, SPEC, keys=keys)
    a = SPEC.train_anchor
    extra_o = t.order.limit(20).withColumn("o_date", F.lit(dt.datetime.combine(a, dt.time())).cast("timestamp_ntz")
                                           + F.expr("INTERVAL 40 DAYS"))
    extra_a = t.action.limit(20).withColumn("a_date", F.lit(dt.datetime.combine(a, dt.time(0, 0, 1))).cast("timestamp_ntz")
                                            - F.expr("INTERVAL 1 DAYS"))
    t2 = Tables(t.user, t.sku, t.order.unionByName(extra_o), t.comment, t.action.unionByName(extra_a))
    shifted = build_training_table(t2, SPEC, keys=keys)
    cols = [c for c in base.columns if c.startswith(("OC_", "AC_", "CC_"))]
    assert base.select(*cols).exceptAll(shifted.select(*cols)).count() == 0


def test_partition_count_does_not_change_results(spark):
    t = load_fixture_tables(spark, SF)
    keys = ["oc_orders_nunique", "ac_last_action", "oc_max_quantity_recency"]
    a = build_training_table(t, SPEC, keys=keys)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        t2 = Tables(t.user.repartition(5), t.sku, t.order.repartition(7), t.comment.repartition(2), t.action.repartition(6))
        b = build_training_table(t2, SPEC, keys=keys)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_selection_cells_are_exact_unions():
    """Each (window, slice, type) selection is exactly the cells whose band
    lies inside the window, whose class is in the slice and whose type
    matches; a wider window never loses a cell of a narrower one."""
    from buyhorizon.functions.slices import slice_names
    from buyhorizon.plans.features import cells, n_cells
    nc = len(SPEC.target_cates) + 1
    wins = sorted(SPEC.windows)
    for src, na in (("order", 1), ("action", 3)):
        assert n_cells(SPEC, src) == len(wins) * nc * na
        for s in slice_names(SPEC, "5"):
            for t in ([None] if na == 1 else [None, "look", "star"]):
                prev = set()
                for w in wins:
                    got = set(cells(SPEC, src, w, s, t))
                    assert len(got) == len(cells(SPEC, src, w, s, t)), "no cell twice"
                    for cell in got:
                        band, cls, typ = cell // (nc * na), (cell // na) % nc, cell % na
                        assert band <= wins.index(w)
                        assert t is None or typ == {"look": 0, "star": 1}[t]
                        if s == "other":
                            assert cls == nc - 1
                        elif s != "all" and "_" not in s:
                            assert cls == list(map(str, SPEC.target_cates)).index(s)
                    assert prev <= got
                    prev = got
