"""Stacked and bagged boosted trees (the reference's model), and its tuning grids.

* folds: exact stratified k folds from a distributed global rank over
  (label, hash) - consecutive positions cycle through folds, so each label
  class is split evenly with no per-label window;
* stacking: k fits at once, each predicts its held-out fold -> one out-of-fold
  meta-feature; the test meta-feature is the mean of the k models;
* bagging: n fits at once on seeded hash holdouts, predictions averaged;
* rounds: every fit stops on its own held-out rows (the fold, or the bag's holdout)
  once ``early_stopping_rounds`` rounds in a row have not lowered the least held-out
  error, and keeps the trees up to that least error (``plans.boost``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from ..operators.trees import BoostParams
from ..session import stored
from .boost import Bins, Fit, Fits, Model, best_round, edges_of, fit_groups, scored, with_bin

__all__ = ["Bins", "BoostParams", "Fit", "Model", "best_round", "fit_groups", "scored"]

#: Cells of equal width from which the bins of the meta-feature are made.
META_CELLS = 4096


def _hash_unit(seed: int) -> Column:
    """A deterministic pseudo-uniform value in [0, 1) per (slip, user_id, seed)."""
    h = F.substring(F.md5(F.concat_ws("|", F.col("slip").cast("string"), F.col("user_id").cast("string"),
                                      F.lit(str(seed)))), 1, 8)
    return F.conv(h, 16, 10).cast("double") / float(16 ** 8)


def holdout_split(df: DataFrame, test_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    u = _hash_unit(seed)
    flagged = df.withColumn("_u", u)
    return (flagged.where(F.col("_u") >= test_fraction).drop("_u"),
            flagged.where(F.col("_u") < test_fraction).drop("_u"))


def stratified_folds(df: DataFrame, label: str, k: int, seed: int = 1) -> DataFrame:
    """Adds ``fold`` in 0..k-1, balanced within every label value."""
    ranked = global_rank(df.withColumn("_u", _hash_unit(seed)), [F.col(label), F.col("_u"), "slip", "user_id"], "_pos")
    return ranked.withColumn("fold", (F.col("_pos") % k).cast("int")).drop("_u", "_pos")


def metric_auc(pred: DataFrame, label: str) -> float:
    binary = pred.withColumn("_bin", (F.col(label) > 0).cast("double"))
    return BinaryClassificationEvaluator(rawPredictionCol="prediction", labelCol="_bin",
                                         metricName="areaUnderROC", numBins=0).evaluate(binary)  # every distinct score is a point of the curve


def metric_l2(pred: DataFrame, label: str) -> float:
    return RegressionEvaluator(predictionCol="prediction", labelCol=label, metricName="mse").evaluate(pred)


def role(held: Column) -> Column:
    return F.when(held, 2).otherwise(1)


def meta_edges(df: DataFrame, column: str, max_bin: int) -> list[float]:
    """Bin edges of a computed column from exact counts of ``META_CELLS`` equal cells, so that they are the same in every run."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or low == high:
        return []
    width = (high - low) / META_CELLS
    cell = F.least(F.lit(META_CELLS - 1), F.floor((F.col(column) - low) / width)).cast("int")
    counts = {r.cell: r.n for r in df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = sorted(counts)
    return edges_of(np.array([low + (c + 1) * width for c in cells]), np.array([counts[c] for c in cells]), max_bin - 1)


@dataclass
class StackedBaggedGBT:
    """Rows have slip, user_id, the label and ``bins``. ``binary``: the label becomes count > 0, positives weigh
    ``scale_pos_weight``, and predictions are probabilities."""

    label: str
    bins: Bins
    params: BoostParams = field(default_factory=BoostParams)
    stacking_num: int = 5
    bagging_num: int = 3
    bagging_test_size: float = 0.33
    metric: str = "auc"
    binary: bool = False
    stack: Fits | None = None
    bags: Fits | None = None
    edges: list[float] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.params = replace(self.params, binary=self.binary)

    @property
    def stack_models(self) -> list[Model]:
        return list(self.stack.models.values()) if self.stack else []

    @property
    def bag_models(self) -> list[Model]:
        return list(self.bags.models.values()) if self.bags else []

    def _fits(self, held: list[tuple[str, Column]]) -> list[list[Fit]]:
        return [[Fit(name, self.params, F.col(self.label), role(h))] for name, h in held]

    def out_of_fold(self, train: DataFrame) -> DataFrame:
        """oof_stack_feature: adds ``fold`` and ``stack_pred``, made by the model that did not see the row."""
        rows = stored(stratified_folds(train, self.label, self.stacking_num), "folds")
        self.stack = fit_groups(rows, self.bins, self._fits([(f"fold-{f}", F.col("fold") == f) for f in range(self.stacking_num)]))
        return scored(rows, self.stack_models, "stack_pred", by="fold")

    def importances(self) -> DataFrame:
        """(fold, feature, importance, gain) of every stacking fit: the number of splits on a feature and their total gain,
        from the written node table; features without a split have 0."""
        spark = self.stack.spark
        names = spark.createDataFrame(list(enumerate(self.bins.columns)), "feature_id int, feature string")
        every = names.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(self.stacking_num - 1))))
        splits = self.stack.nodes().where("feature >= 0").groupBy(F.substring_index("fit", "-", -1).cast("int").alias("fold"), F.col("feature").alias("feature_id")).agg(
            F.count(F.lit(1)).alias("importance"), F.sum("gain").alias("gain"))
        return every.join(splits, ["fold", "feature_id"], "left").select("fold", "feature", F.coalesce("importance", F.lit(0)).cast("double").alias("importance"), F.coalesce("gain", F.lit(0.0)).alias("gain"))

    def stack_inference(self, test: DataFrame) -> DataFrame:
        """stack_inference_feature: mean of the k fold models on the test rows."""
        return scored(test, self.stack_models, "stack_pred")

    def _with_meta(self, df: DataFrame) -> DataFrame:
        return with_bin(df, "stack_pred", self.edges) if self.stacking_num > 1 else df

    def fit(self, train: DataFrame) -> StackedBaggedGBT:
        rows, bins = train, self.bins
        if self.stacking_num > 1:
            rows = stored(self.out_of_fold(train), "out-of-fold")
            self.edges = meta_edges(rows, "stack_pred", self.params.max_bin)
            bins = self.bins.with_column("stack_pred", self.edges)
        held = [_hash_unit(bn) < self.bagging_test_size for bn in range(self.bagging_num)]
        data = stored(self._with_meta(rows), "stacked")
        self.bags = fit_groups(data, bins, self._fits([(f"bag-{i}", h) for i, h in enumerate(held)]))
        measure = metric_auc if self.metric == "auc" else metric_l2
        self.scores = [measure(scored(data.where(h), [m], "prediction"), self.label) for h, m in zip(held, self.bag_models, strict=True)]
        return self

    def each_bag(self, test: DataFrame) -> DataFrame:
        """``test`` with ``bag_0``, ``bag_1``, ...: every bag's own prediction."""
        out = self._with_meta(self.stack_inference(test) if self.stacking_num > 1 else test)
        for i, m in enumerate(self.bag_models):
            out = scored(out, [m], f"bag_{i}")
        return out

    def predict(self, test: DataFrame, out: str) -> DataFrame:
        meta = self._with_meta(self.stack_inference(test) if self.stacking_num > 1 else test)
        return scored(meta, self.bag_models, out).drop("stack_pred").withColumn("bins", F.expr(f"substring(bins, 1, {len(self.bins.columns)})"))


def distinct_point(p: BoostParams) -> BoostParams:
    """The same fit under its plainest parameters: a depth bounds the leaves, and without a draw its share and frequency do not matter."""
    leaves = min(p.num_leaves, 2 ** p.max_depth) if p.max_depth > 0 else p.num_leaves
    bag = {"bagging_fraction": 1.0, "bagging_freq": 0} if p.bagging_freq <= 0 or p.bagging_fraction >= 1 else {}
    return replace(p, num_leaves=leaves, **bag)


def grid_search_cv(rows: DataFrame, bins: Bins, label: Column, params: BoostParams, points: list[dict], folds: int = 3) -> list[tuple[dict, float]]:
    """Mean held-out l2 (lower is better) of every point, by k-fold cross-validation, at the best round of the mean over the folds.

    Points that are the same fit under other parameters are fitted once; all points and folds run at once."""
    distinct = {distinct_point(replace(params, **p)): None for p in points}
    fold = F.floor(_hash_unit(params.seed) * folds)
    groups = [[Fit(f"point-{i}-{f}", p, label, role(fold == f)) for f in range(folds)] for i, p in enumerate(distinct)]
    found = fit_groups(rows, bins, groups)
    error = {p: found.errors[g[0].name][-1] for p, g in zip(distinct, groups, strict=True)}
    return [(p, float(error[distinct_point(replace(params, **p))])) for p in points]
