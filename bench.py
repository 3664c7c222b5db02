"""Benchmark: headline jobs on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints ONE JSON line. Every job is executed in full with the ``noop`` sink
(no collect to the driver); times are wall seconds including planning.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    from buyhorizon import session
    from buyhorizon.session import build_session, drop_scratch
    spark = build_session(f"local[{cpus}]", app="buyhorizon-bench", shuffle_partitions=parts,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    from buyhorizon.plans import cleaning as CL
    from buyhorizon.plans import predict as PR
    from buyhorizon.plans import score as SC
    from buyhorizon.plans import training as TR
    from buyhorizon.plans.model import BoostParams
    from buyhorizon.sources.fixtures import load_fixture_tables
    from buyhorizon.spec import FIXTURE_SPEC as S

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    def features_one_slip():
        t = load_fixture_tables(spark, sf_dir)
        run(TR.build_table(t, S, S.train_anchor, [0], True))

    def training_table():
        t = load_fixture_tables(spark, sf_dir)
        run(TR.build_training_table(t, S))

    def inference_table():
        t = load_fixture_tables(spark, sf_dir)
        run(TR.build_inference_table(t, S))

    def user_cleaning():
        t = load_fixture_tables(spark, sf_dir)
        run(CL.clean_users_total(t, S))

    def scoring():
        t = load_fixture_tables(spark, sf_dir)
        top = SC.topk_users(SC.baseline_predictions(t, S, S.test_anchor), S, S.test_anchor)
        run(SC.score(top, SC.truth_first_order(t, S), S))

    # the model job runs on a table of its own size: its time is that of 3500 trees or more
    model_dir = os.environ.get("BENCH_MODEL_SF_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.01"))
    fresh = tempfile.mkdtemp(prefix="buyhorizon-bench-")
    session.store_root = lambda spark: fresh  # no fit of an earlier run is read

    def prediction_job():
        """Tables, models, ranked lists, files and the score read back."""
        t = load_fixture_tables(spark, model_dir)
        m = PR.matrices(t, S)
        run(PR.predict_submit_score(t, m, PR.fit_models(m, S, BoostParams()), S, f"bench_submit_{uuid.uuid4().hex}"))

    jobs = {"features_one_slip": features_one_slip, "training_table_4x4": training_table,
            "inference_table": inference_table, "user_cleaning": user_cleaning, "scoring": scoring}
    if os.path.isdir(model_dir) and os.environ.get("BENCH_MODEL", "1") != "0":
        jobs[f"prediction_job_{os.path.basename(model_dir)}"] = prediction_job
    # warm-up: JVM start, first code generation (not timed)
    user_cleaning()
    times = {}
    for name, fn in jobs.items():
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
        drop_scratch(spark)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "pipeline_wall_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "spark": spark.version, "cpus": cpus,
                      "shuffle_partitions": parts}))
    spark.stop()


if __name__ == "__main__":
    main()
