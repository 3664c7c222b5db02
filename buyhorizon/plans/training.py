"""Training and inference tables: spine + labels + the three families + one-hot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.calendar import sample_spine
from ..sources import io as IO
from ..sources.fixtures import Tables
from ..spec import FeatureSpec
from .catalogue import CATALOGUE, FAMILY_KEYS
from .facts import Facts
from .features import compile_rows, run_compiled
from .labels import attach_labels, label_names

ID_COLUMNS = ["user_id"]
USER_CODES = ["sex", "user_lv_cd", "age"]


def facts_of(t: Tables) -> Facts:
    return Facts(t)


def onehot_vocab(users: DataFrame, cols=USER_CODES, most: int = 1000) -> dict[str, list[int]]:
    """The codes each column has in the training users, in order; at most ``most`` distinct codes a column.

    Fitted once and used for every table of a run, so train and test agree."""
    vocab = {}
    for c in cols:
        codes = sorted(r[0] for r in users.select(c).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect())
        if len(codes) > most:
            raise ValueError(f"{c} has more than {most} codes: not a code column")
        vocab[c] = codes
    return vocab


def onehot_sql(vocab: dict[str, list[int]]) -> list[str]:
    """The dummies of a fitted vocabulary as SQL; a missing code gives 0 in every dummy."""
    return [f"coalesce(CAST({c} = {int(v)} AS INT), 0) AS {c}_{v}" for c, codes in vocab.items() for v in codes]


def onehot_users(df: DataFrame, vocab: dict[str, list[int]]) -> DataFrame:
    """Dummies over a fitted vocabulary; the original columns are dropped."""
    return df.selectExpr(*[f"`{c}`" for c in df.columns if c not in vocab], *onehot_sql(vocab))


def unknown_codes(df: DataFrame, vocab: dict[str, list[int]]) -> DataFrame:
    """Rows per column and code that the vocabulary lacks (their dummies are all 0)."""
    parts = [df.where(F.col(c).isNotNull() & ~F.col(c).isin(codes)).groupBy(F.lit(c).alias("column"), F.col(c).cast("long").alias("code")).agg(F.count(F.lit(1)).alias("rows"))
             for c, codes in vocab.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def nan_count(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Nulls per row over the feature columns (the true count): one flat array, not a chain of sums."""
    flags = ", ".join(f"`{c}` IS NULL" for c in feature_cols)
    return df.withColumn("NaNcount", F.expr(f"size(filter(array({flags}), x -> x))"))


def build_table(t: Tables, spec: FeatureSpec, anchor: dt.date | list[tuple[int, dt.date]], slips=None, is_training: bool = True,
                keys=None, onehot: bool = True) -> DataFrame:
    """One row per (slip, user): ids, labels, features, one-hot user codes."""
    slips = list(spec.slips if slips is None else slips)
    spine = sample_spine(t.user.select("user_id", *USER_CODES), spec, anchor, slips)
    spine = attach_labels(spine, t, spec, anchor, is_training, slips)
    rows = CATALOGUE if keys is None else [r for r in CATALOGUE if r.key in set(keys)]
    c, _ = compile_rows(spec, rows)
    lead = ["user_id", "slip", *label_names(spec), *(onehot_sql(onehot_vocab(t.user)) if onehot else USER_CODES)]
    return run_compiled(c, Facts(t), spine, spec, anchor, slips, lead)


def build_tables(t: Tables, spec: FeatureSpec, parts: dict[str, tuple[dt.date, list[int], bool]], keys=None,
                 of_spine: Callable[[DataFrame], DataFrame] = lambda spine: spine) -> DataFrame:
    """Several tables, each (anchor, slips, with labels), in one build: the facts of all their windows are joined,
    stored and grouped once. Adds ``part``; every table keeps its own slips. ``of_spine`` says which of the
    spine's rows (user_id, part, ...) are wanted, before any feature is made."""
    stride = 1 + max(max(slips) for _, slips, _ in parts.values())
    pairs = {name: [(i * stride + s, a) for s, a in spec.anchors(anchor, slips)] for i, (name, (anchor, slips, _)) in enumerate(parts.items())}
    labelled = [pair for name, (_, _, with_labels) in parts.items() if with_labels for pair in pairs[name]]
    every = [pair for own in pairs.values() for pair in own]
    spine = sample_spine(t.user.select("user_id", *USER_CODES), spec, every)
    if labelled:
        spine = attach_labels(spine, t, spec, labelled)
        known = F.col("slip").isin([s for s, _ in labelled])
        spine = spine.withColumns({c: F.when(known, F.col(c)).otherwise(-1) for c in label_names(spec)})
    else:
        spine = attach_labels(spine, t, spec, every, False)
    names = ", ".join(f"'{name}'" for name in parts)
    spine = of_spine(spine.drop("anchor").withColumn("part", F.expr(f"element_at(array({names}), CAST(slip DIV {stride} AS INT) + 1)")))
    c, _ = compile_rows(spec, CATALOGUE if keys is None else [r for r in CATALOGUE if r.key in set(keys)])
    lead = ["part", f"slip % {stride} AS slip", "user_id", *label_names(spec), *onehot_sql(onehot_vocab(t.user))]
    return run_compiled(c, Facts(t), spine, spec, every, lead=lead)


def build_training_table(t: Tables, spec: FeatureSpec, keys=None) -> DataFrame:
    return build_table(t, spec, spec.train_anchor, spec.slips, True, keys)


def build_inference_table(t: Tables, spec: FeatureSpec, keys=None, anchor: dt.date | None = None) -> DataFrame:
    return build_table(t, spec, anchor or spec.test_anchor, [0], False, keys)


def feature_columns(df: DataFrame, spec: FeatureSpec) -> list[str]:
    """select_feature_columns: everything but ids, labels, slip and last-time."""
    skip = set(ID_COLUMNS) | set(label_names(spec)) | {"slip", "anchor", "part", "Sample_30_101_LastTime"}
    return [c for c in df.columns if c not in skip]


def family_table(t: Tables, spec: FeatureSpec, family: str, anchor: dt.date | None = None, slips=(0,), facts: Facts | None = None) -> DataFrame:
    """features_orders / features_comments / features_actions for the given slips."""
    anchor = anchor or spec.train_anchor
    spine = sample_spine(t.user.select("user_id"), spec, anchor, list(slips))
    c, _ = compile_rows(spec, [r for r in CATALOGUE if r.key in set(FAMILY_KEYS[family])])
    return run_compiled(c, facts or Facts(t), spine, spec, anchor, list(slips), ["user_id", "slip"])


def stacked_one_by_one(t: Tables, spec: FeatureSpec, family: str, slips, facts: Facts) -> DataFrame:
    """A family's tables of several slips, each built when it is added; with ``DayFacts`` an added slip joins new days only."""
    parts = [family_table(t, spec, family, slips=[s], facts=facts) for s in slips]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bucketed_families(t: Tables, spec: FeatureSpec, folder: str, prefix: str, buckets: int, anchor: dt.date | None = None) -> DataFrame:
    """The three families of slip 0 as tables bucketed on user_id, joined to the bucketed spine without an exchange."""
    anchor = anchor or spec.train_anchor
    out = IO.sink_bucketed(t.user.select("user_id"), f"{prefix}_spine", f"{folder}/spine", buckets)
    for family in FAMILY_KEYS:
        made = family_table(t, spec, family, anchor).drop("slip")
        table = IO.sink_bucketed(made, f"{prefix}_{family.lower()}", f"{folder}/{family.lower()}", buckets)
        out = out.join(table, "user_id", "left")
    return out
