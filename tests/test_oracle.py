"""Registered queries against their DuckDB oracles on sf0.001 (a fast subset
per section; tools/check_oracle.py runs them all at sf0.01)."""

import sys

import duckdb
import pytest

sys.path.insert(0, ".")
from tools.check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = ["oc_orders_nunique", "oc_last_order", "oc_promo_share", "cc_poor_share", "cc_last_comment",
        "ac_look_conversion", "ac_max_action_recency", "join_slip_range", "label_first_day", "stratified_folds",
        "clean_users_total", "second_purchase", "rank_users", "score_total", "calendar_bins", "share_repurchase",
        "fn_day_diff", "scan_dated", "scan_dated_action", "build_inference_table", "agg_median", "ac_category_share",
        "oc_repurchase", "sink_submission", "scan_prediction", "metric_auc_exact", "slip_calendar", "oc_days_nunique", "ac_last_action"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as E
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, sdf.columns)[0] == digest(orows, ocols)[0]


def test_every_query_has_an_entry_and_entry_runs(spark):
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert len(df.columns) > 700
