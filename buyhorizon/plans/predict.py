"""The prediction job end to end: tables, cleaning, both models, ranked lists, files, score."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import code_digest, kept, scratch_path, stored
from ..sources import io as IO
from ..sources.fixtures import Tables
from ..spec import FeatureSpec
from . import cleaning as CL
from . import score as SC
from . import training as TR
from .labels import label_names
from .model import Bins, BoostParams, StackedBaggedGBT


@dataclass
class Matrices:
    """The feature rows of the train, valid and test tables, and their binned form: slip, user_id, both labels, bins."""

    features: DataFrame
    columns: list[str]
    spec: FeatureSpec
    name: str | None
    made: dict[int, tuple[Bins, DataFrame]] = field(default_factory=dict)

    def _stored(self, what: str, make) -> DataFrame:
        return kept(self.features.sparkSession, f"{what}-{self.name}", make) if self.name else stored(make(), what)

    def binned(self, max_bin: int) -> tuple[Bins, DataFrame]:
        """Bins fitted on the train rows, and all parts' rows in them."""
        if max_bin not in self.made:
            spark = self.features.sparkSession
            edges = self._stored(f"edges-{max_bin}", lambda: spark.createDataFrame(
                list(enumerate(Bins(self.columns).fit(self.features.where("part = 'train'"), max_bin).edges)), "at int, edges array<double>"))
            bins = Bins(self.columns, [list(r.edges) for r in edges.orderBy("at").collect()])
            self.made[max_bin] = bins, self._stored(f"rows-{max_bin}", lambda: bins.binned(self.features, ["part", "slip", "user_id", *label_names(self.spec)]))
        return self.made[max_bin]

    def rows(self, part: str, max_bin: int = BoostParams().max_bin) -> DataFrame:
        return self.binned(max_bin)[1].where(F.col("part") == part).drop("part")


def matrices(t: Tables, spec: FeatureSpec, inputs: list[str] | None = None) -> Matrices:
    """Train and test without the cleaned users, valid with all of them: one build for all three, stored.

    ``inputs`` identifies the tables' files; with it the rows are kept for later sessions."""
    name = hashlib.sha256(repr((inputs, spec, code_digest())).encode()).hexdigest()[:32] if inputs else None
    parts = {"train": (spec.train_anchor, list(spec.slips), True), "valid": (spec.valid_anchor, [0], False), "test": (spec.test_anchor, [0], False)}

    def make() -> DataFrame:
        removed = CL.clean_users_total(t, spec).select("user_id").distinct().withColumn("_removed", F.lit(True))
        wanted = (F.col("part") == "valid") | F.col("_removed").isNull()
        return TR.build_tables(t, spec, parts, of_spine=lambda spine: spine.join(removed, "user_id", "left").where(wanted).drop("_removed"))

    features = kept(t.user.sparkSession, f"features-{name}", make) if name else stored(make(), "features")
    return Matrices(features, TR.feature_columns(features, spec), spec, name)


def fit_models(m: Matrices, spec: FeatureSpec, params: BoostParams) -> tuple[StackedBaggedGBT, StackedBaggedGBT]:
    """The count model on all rows (auc) and the first-day model on buyers (l2), side by side."""
    buy, day = label_names(spec)
    bins, train = m.binned(params.max_bin)[0], m.rows("train", params.max_bin)
    todo = [(StackedBaggedGBT(buy, bins, params, metric="auc"), train), (StackedBaggedGBT(day, bins, params, metric="l2"), train.where(F.col(day) < spec.no_buy_day))]
    with ThreadPool(2) as pool:
        count, first = pool.map(inheritable_thread_target(train.sparkSession)(lambda x: x[0].fit(x[1])), todo)
    return count, first


def predictions(rows: DataFrame, models: tuple[StackedBaggedGBT, StackedBaggedGBT], spec: FeatureSpec) -> DataFrame:
    """user_id with the predicted count and day."""
    buy, day = label_names(spec)
    count, first = models
    both = first.predict(count.predict(rows.drop(buy, day), buy), day)
    return both.select("user_id", buy, day)


def predict_submit_score(t: Tables, m: Matrices, models, spec: FeatureSpec, folder: str) -> DataFrame:
    """For valid and test: full ranked list and top-K file written, the score computed from the file read back."""
    spark, out = m.features.sparkSession, None
    for part, anchor in (("valid", spec.valid_anchor), ("test", spec.test_anchor)):
        ranked = stored(SC.ranked_predictions(predictions(m.rows(part), models, spec), spec, anchor), f"ranked-{part}")
        IO.sink_predictions(ranked, scratch_path(spark, f"{folder}/{part}-all"))
        path = scratch_path(spark, f"{folder}/{part}")
        IO.sink_submission(ranked, path, spec.top_k)
        end = anchor + dt.timedelta(days=spec.label_window)
        score = SC.score_submission(IO.scan_prediction(spark, path), SC.truth_first_order(t, spec, anchor, end)).withColumn("part", F.lit(part))
        out = score if out is None else out.unionByName(score)
    return out.select("part", "s1", "s2", "s")
